"""Interactive exploration: filter a panel, then headline numbers, boards and insights.

``last_known`` reduces the filtered panel to one row per entity; cache it when several of
the functions below are called on it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions import round_even
from panelkit.operators.cleaning import present
from panelkit.operators.latest import last_known, top_k

SNAPSHOT = (
    "region",
    "total_cases",
    "total_deaths",
    "people_vaccinated",
    "people_fully_vaccinated",
    "population",
    "case_fatality_rate",
    "cases_per_100k",
    "deaths_per_100k",
    "fully_vaccinated_rate",
)
# Columns of the row explorer; provenance columns are given by the caller.
SHOWN = (
    "country",
    "date",
    "new_cases",
    "total_cases",
    "new_deaths",
    "total_deaths",
    "case_fatality_rate",
    "cases_per_100k",
    "fully_vaccinated_rate",
)


def choices(df: DataFrame) -> DataFrame:
    """The values a filter can take: (region, country), known regions only."""
    return (
        df.where(F.col("region").isNotNull() & (F.trim("region") != ""))
        .where(F.col("country").isNotNull())
        .select("region", "country")
        .distinct()
    )


def filter_panel(
    df: DataFrame,
    start: Date | str | None = None,
    end: Date | str | None = None,
    regions: Sequence[str] | None = None,
    entities: Sequence[str] | None = None,
) -> DataFrame:
    """Rows in the inclusive date range, of the regions, and of the entities if any are named."""
    conditions: list[Column] = []
    if start is not None:
        conditions.append(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        conditions.append(F.col("date") <= F.lit(end).cast("date"))
    if regions is not None:
        conditions.append(F.col("region").isin(list(regions)))
    if entities:
        conditions.append(F.col("country").isin(list(entities)))
    for condition in conditions:
        df = df.where(condition)
    return df


def latest_per_entity(df: DataFrame, columns: Sequence[str] = SNAPSHOT) -> DataFrame:
    """Each column's last known value per entity."""
    return last_known(df, present(df, columns))


def kpis(latest: DataFrame) -> DataFrame:
    """One row of totals, overall fatality and coverage in percent, and the entity count."""
    totals = latest.agg(
        *[
            F.coalesce(F.sum(source), F.lit(0)).alias(name)
            for name, source in (
                ("cases", "total_cases"),
                ("deaths", "total_deaths"),
                ("vaccinated", "people_vaccinated"),
                ("fully_vaccinated", "people_fully_vaccinated"),
                ("population", "population"),
            )
        ],
        F.count("country").alias("entities"),
    )

    def pct(top: str, bottom: str) -> Column:
        share = F.try_divide(F.col(top), F.col(bottom)) * 100.0
        return F.when(F.col(bottom) > 0, share).otherwise(0.0)

    return totals.withColumns(
        {
            "fatality_pct": pct("deaths", "cases"),
            "coverage_pct": pct("fully_vaccinated", "population"),
        }
    )


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def daily_filtered(df: DataFrame) -> DataFrame:
    """Per date: total flows, and totals of the rolling means in their two decimals; 0 without any."""
    return df.where(F.col("date").isNotNull()).groupBy("date").agg(
        _total("new_cases").alias("new_cases"),
        _total("new_deaths").alias("new_deaths"),
        round_even(_total("7_day_cases_avg"), 2).alias("7_day_cases_avg"),
        round_even(_total("7_day_deaths_avg"), 2).alias("7_day_deaths_avg"),
    )


def leaderboard(
    latest: DataFrame,
    by: str,
    k: int = 10,
    min_cases: float | None = None,
    min_population: int | None = None,
) -> DataFrame:
    """Top ``k`` entities by a column, optionally only those large enough."""
    if min_cases is not None:
        latest = latest.where(F.col("total_cases") >= min_cases)
    if min_population is not None:
        latest = latest.where(F.col("population") >= min_population)
    return top_k(latest, by, k, ["country"])


def leaderboards(
    latest: DataFrame, k: int = 10, min_cases: float = 50_000, min_population: int = 500_000
) -> DataFrame:
    """The four standard boards as rows (board, country, value)."""
    large = F.col("population") >= min_population
    boards = {
        "total_cases": F.lit(True),
        "case_fatality_rate": F.col("total_cases") >= min_cases,
        "cases_per_100k": large,
        "deaths_per_100k": large,
    }
    entries = F.array(
        *[
            F.when(takes_part, F.struct(F.lit(by).alias("board"), F.col(by).cast("double").alias("value")))
            for by, takes_part in boards.items()
        ]
    )
    # the snapshot is computed once; the limit on the rank is applied before the shuffle
    ranked = Window.partitionBy("board").orderBy(F.desc_nulls_last("value"), "country")
    return (
        latest.select("country", F.inline(F.filter(entries, lambda e: e.isNotNull())))
        .withColumn("_place", F.row_number().over(ranked))
        .where(F.col("_place") <= k)
        .select("board", "country", "value")
    )


def coverage_scatter(
    latest: DataFrame, min_population: int = 2_000_000, min_cases: float = 25_000
) -> DataFrame:
    """Entities that enter the coverage against fatality plot."""
    return latest.where(
        (F.col("population") >= min_population) & (F.col("total_cases") >= min_cases)
    ).select(
        "country",
        "region",
        "fully_vaccinated_rate",
        "case_fatality_rate",
        "total_cases",
        "total_deaths",
    )


def explorer_tail(df: DataFrame, rows: int = 500, columns: Sequence[str] = SHOWN) -> DataFrame:
    """The last rows of the panel in (country, date) order, with those of the columns that it has."""
    shown = df.select(*present(df, columns))
    return shown.orderBy(F.col("country").desc(), F.col("date").desc()).limit(rows)


def insights(daily: DataFrame, latest: DataFrame, min_cases: float = 50_000) -> DataFrame:
    """Up to three sentences (topic, text) about the filtered panel."""

    topics = {"cases": "new_cases", "deaths": "new_deaths"}

    def best(metric: str) -> Column:
        # of equal peaks the earliest day
        return F.max_by(
            F.struct("date", F.col(metric).alias("value")),
            F.struct(F.col(metric), -F.unix_date("date")),
        )

    def sentence(topic: str) -> Column:
        peak = F.col(topic)
        text = F.format_string(
            f"Highest daily {topic}: %,d on %s",
            peak["value"].cast("long"),
            F.date_format(peak["date"], "MMMM dd, yyyy"),
        )
        return F.when(peak.isNotNull(), F.struct(F.lit(topic).alias("topic"), text.alias("text")))

    # both peaks from one pass over the days
    peaks = daily.agg(*[best(metric).alias(topic) for topic, metric in topics.items()]).select(
        F.inline(F.filter(F.array(*map(sentence, topics)), lambda s: s.isNotNull()))
    )

    leader = top_k(
        latest.where(F.col("total_cases") >= min_cases), "case_fatality_rate", 1, ["country"]
    ).select(
        F.lit("fatality").alias("topic"),
        F.format_string(
            "Highest case fatality: %s with %.2f%% (%,d deaths of %,d cases)",
            F.col("country"),
            F.col("case_fatality_rate"),
            F.col("total_deaths").cast("long"),
            F.col("total_cases").cast("long"),
        ).alias("text"),
    )
    return peaks.union(leader)

