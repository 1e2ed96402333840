"""The data sets behind the standard figures, ready to plot.

Top-n sets come from an aggregate per entity, so only n rows are broadcast. Windows without
a partition key run on daily totals: at most one row per calendar day. Rows without the key
of a group (entity, date) are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions import month_of, round_even
from panelkit.operators.latest import top_k
from panelkit.operators.series import detect_peaks

# Entities of the comparison figure.
COMPARED = ("United States", "India", "United Kingdom", "Germany", "Brazil", "France", "Japan")


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).alias(c)


def _per(df: DataFrame, key: str):
    return df.where(F.col(key).isNotNull()).groupBy(key)


def _full_mean(c: str, width: int) -> Column:
    """Trailing mean over daily totals; null until ``width`` rows are there."""
    rows = Window.partitionBy().orderBy("date").rowsBetween(-(width - 1), Window.currentRow)
    return F.when(F.count(c).over(rows) == width, F.avg(c).over(rows))


def last_value(c: str) -> Column:
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date")))


def daily_total(df: DataFrame, metric: str = "new_cases", width: int = 7) -> DataFrame:
    """Sum per date and its full trailing mean."""
    daily = _per(df, "date").agg(_total(metric))
    return daily.withColumn(f"{width}d_avg", _full_mean(metric, width))


def top_entities(df: DataFrame, counter: str = "total_cases", n: int = 15) -> DataFrame:
    """The ``n`` entities with the largest value of a counter, in ascending order."""
    best = top_k(_per(df, "country").agg(F.max(counter).alias(counter)), counter, n, ["country"])
    return best.orderBy(F.col(counter).asc(), F.col("country").desc())


def _rows_of_top(df: DataFrame, counter: str, n: int) -> DataFrame:
    chosen = F.broadcast(top_entities(df, counter, n).select("country"))  # n rows
    return df.join(chosen, "country", "left_semi")


def rolling_of_top(
    df: DataFrame,
    counter: str = "total_cases",
    smoothed: str = "7_day_cases_avg",
    n: int = 5,
) -> DataFrame:
    """Smoothed series of the ``n`` entities with the largest counter."""
    return _rows_of_top(df, counter, n).select("country", "date", smoothed)


def fatality_leaders(df: DataFrame, min_cases: float = 250_000, n: int = 15) -> DataFrame:
    """Highest last known case fatality among entities with enough cases."""
    per_entity = _per(df, "country").agg(
        F.max("total_cases").alias("total_cases"),
        F.max("total_deaths").alias("total_deaths"),
        last_value("case_fatality_rate").alias("case_fatality_rate"),
    )
    return top_k(
        per_entity.where(F.col("total_cases") >= min_cases), "case_fatality_rate", n, ["country"]
    )


def coverage_over_time(df: DataFrame, since: str = "2020-12-01") -> DataFrame:
    """Daily totals of people covered, and of the population they belong to."""
    return (
        df.where(F.col("date") >= F.lit(since).cast("date"))
        .groupBy("date")
        .agg(
            _total("people_vaccinated"),
            _total("people_fully_vaccinated"),
            _total("population"),
        )
    )


def per_capita_leaders(
    df: DataFrame, rate: str = "cases_per_100k", min_population: int = 1_000_000, n: int = 15
) -> DataFrame:
    """Highest per-capita rate among entities that are large enough."""
    return top_entities(df.where(F.col("population") >= min_population), rate, n)


def entity_comparison(
    df: DataFrame, entities: Sequence[str] = COMPARED, smoothed: str = "7_day_cases_avg"
) -> DataFrame:
    """Smoothed series of the named entities, in thousands."""
    return df.where(F.col("country").isin(list(entities))).select(
        "country", "date", (F.col(smoothed) / 1000.0).alias(f"{smoothed}_thousands")
    )


def region_trend(
    df: DataFrame,
    regions: Sequence[str] | None = None,
    metric: str = "new_cases",
    width: int = 14,
) -> DataFrame:
    """Date x region sums with gaps as 0, then the full trailing mean per region column.

    Without ``regions`` Spark finds the distinct values itself, in a job of its own, and refuses more
    than ``spark.sql.pivotMaxValues``; ``region_trend_rows`` needs neither.
    """
    known = df.where((F.col("region").isNotNull()) & (F.trim("region") != ""))
    grouped = _per(known, "date")
    pivot = grouped.pivot("region", list(regions)) if regions else grouped.pivot("region")
    wide = pivot.agg(F.sum(metric)).na.fill(0.0)
    names = [c for c in wide.columns if c != "date"]
    return wide.select("date", *[_full_mean(f"`{c}`", width).alias(c) for c in names])


def on_grid(sums: DataFrame, by: str, label: str, value: str) -> DataFrame:
    """Rows (``by``, label, value) for each pair of a value of ``by`` and a label that ``sums`` has; 0
    where a pair is missing. The labels travel as one row, so there must be few of them."""
    labels = sums.agg(F.array_sort(F.collect_set(label)).alias("_labels"))
    grid = sums.select(by).distinct().crossJoin(F.broadcast(labels))  # one row
    grid = grid.select(by, F.explode("_labels").alias(label))
    return grid.join(sums, [by, label], "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def region_trend_rows(df: DataFrame, metric: str = "new_cases", width: int = 14) -> DataFrame:
    """Long form of ``region_trend`` for all regions: (date, region, value)."""
    known = df.where(F.col("region").isNotNull() & (F.trim("region") != "") & F.col("date").isNotNull())
    sums = known.groupBy("date", "region").agg(F.sum(metric).cast("double").alias("value"))
    rows = Window.partitionBy("region").orderBy("date").rowsBetween(-(width - 1), Window.currentRow)
    mean = F.when(F.count("value").over(rows) == width, F.avg("value").over(rows))
    return on_grid(sums, "date", "region", "value").withColumn("value", mean)


def coverage_vs_cases(df: DataFrame, min_population: int = 2_000_000) -> DataFrame:
    """Per entity: highest coverage, cases per 100k and population, first region. Complete rows."""
    return (
        _per(df.where(F.col("population") >= min_population), "country")
        .agg(
            F.max("fully_vaccinated_rate").alias("fully_vaccinated_rate"),
            F.max("cases_per_100k").alias("cases_per_100k"),
            F.max("population").alias("population"),
            F.min_by("region", F.when(F.col("region").isNotNull(), F.col("date"))).alias("region"),
        )
        .dropna()
    )


def coverage_vs_fatality(
    df: DataFrame, min_population: int = 2_000_000, min_cases: float = 50_000
) -> DataFrame:
    """As ``coverage_vs_cases``, with the last known case fatality, for rows with enough cases."""
    large = (F.col("population") >= min_population) & (F.col("total_cases") >= min_cases)
    return (
        _per(df.where(large), "country")
        .agg(
            F.max("fully_vaccinated_rate").alias("fully_vaccinated_rate"),
            last_value("case_fatality_rate").alias("case_fatality_rate"),
            F.max("population").alias("population"),
            F.min_by("region", F.when(F.col("region").isNotNull(), F.col("date"))).alias("region"),
        )
        .dropna()
    )


def straight_line(
    points: DataFrame, x: str, y: str, more_than: int = 5, digits: int = 8
) -> DataFrame:
    """One row: least-squares slope and intercept and the number of points, or no row when
    there are not more than ``more_than`` points."""
    return points.agg(
        round_even(F.regr_slope(y, x), digits).alias("slope"),
        round_even(F.regr_intercept(y, x), digits).alias("intercept"),
        F.regr_count(y, x).alias("points"),
    ).where(F.col("points") > more_than)


def monthly_total(df: DataFrame, metric: str = "new_cases") -> DataFrame:
    """Sum per calendar month."""
    return _per(df.withColumn("month", month_of("date")), "month").agg(_total(metric))


def smoothed_total(df: DataFrame, metric: str = "new_cases", width: int = 14) -> DataFrame:
    """Daily total and its trailing mean from the first day on."""
    rows = Window.partitionBy().orderBy("date").rowsBetween(-(width - 1), Window.currentRow)
    daily = _per(df, "date").agg(_total(metric))
    return daily.withColumn("smoothed", F.avg(metric).over(rows))


def wave_timeline(
    df: DataFrame,
    metric: str = "new_cases",
    width: int = 14,
    distance: int = 60,
    prominence_factor: float = 0.2,
) -> DataFrame:
    """Peaks of the smoothed daily total."""
    return detect_peaks(
        smoothed_total(df, metric, width),
        "smoothed",
        distance=distance,
        prominence_factor=prominence_factor,
    )


def month_heatmap(
    df: DataFrame,
    metric: str = "new_cases",
    counter: str = "total_cases",
    n: int = 15,
    months: Sequence[str] | None = None,
) -> DataFrame:
    """Entity x month sums in millions for the top ``n`` entities, one column per month, gaps 0."""
    dated = df.where(F.col("date").isNotNull())
    monthly = _rows_of_top(dated, counter, n).withColumn("month", month_of("date"))
    grouped = monthly.groupBy("country")
    pivot = grouped.pivot("month", list(months)) if months else grouped.pivot("month")
    wide = pivot.agg(F.sum(metric)).na.fill(0.0)
    names = [c for c in wide.columns if c != "country"]
    return wide.select("country", *[(F.col(f"`{c}`") / 1e6).alias(c) for c in names])


def month_heatmap_rows(
    df: DataFrame, metric: str = "new_cases", counter: str = "total_cases", n: int = 15
) -> DataFrame:
    """Entity x month sums in millions for the top ``n`` entities as rows (country, month, millions),
    gaps 0."""
    dated = df.where(F.col("date").isNotNull())
    monthly = _rows_of_top(dated, counter, n).withColumn("month", month_of("date"))
    sums = monthly.groupBy("month", "country").agg((F.sum(metric) / 1e6).alias("millions"))
    return on_grid(sums, "month", "country", "millions").select("country", "month", "millions")


def heatmap_rows(wide: DataFrame) -> DataFrame:
    """Long form of ``month_heatmap``: (country, month, millions)."""
    months = [f"`{c}`" for c in wide.columns if c != "country"]
    return wide.unpivot("country", months, "month", "millions")


def all_charts(df: DataFrame) -> dict[str, DataFrame]:
    """The data set of every standard figure with its default parameters, and those of the lines in
    figures 14 and 17."""
    fatality = coverage_vs_fatality(df)
    return {
        "01_global_daily_cases": daily_total(df),
        "02_global_daily_deaths": daily_total(df, "new_deaths"),
        "03_rolling_cases": rolling_of_top(df),
        "04_rolling_deaths": rolling_of_top(df, "total_deaths", "7_day_deaths_avg"),
        "05_top_countries_cases": top_entities(df),
        "06_top_countries_deaths": top_entities(df, "total_deaths"),
        "07_cfr_comparison": fatality_leaders(df),
        "08_vaccination_coverage": coverage_over_time(df),
        "09_cases_per_100k": per_capita_leaders(df),
        "10_deaths_per_100k": per_capita_leaders(df, "deaths_per_100k"),
        "11_country_comparisons": entity_comparison(df),
        "12_regional_trends": region_trend_rows(df),
        "13_vaccination_vs_cases": coverage_vs_cases(df),
        "14_vaccination_vs_deaths": fatality,
        "14_vaccination_vs_deaths_line": straight_line(fatality, "fully_vaccinated_rate", "case_fatality_rate"),
        "15_monthly_cases": monthly_total(df),
        "16_monthly_deaths": monthly_total(df, "new_deaths"),
        "17_pandemic_waves": wave_timeline(df),
        "17_pandemic_waves_smoothed": smoothed_total(df),
        "18_cases_heatmap": month_heatmap(df),
    }
