"""The analytical query suite over the dimensional model.

Shape shared by all queries: reduce the fact to one row per entity, day or month first
(hash aggregates that combine before the shuffle), then join the dimensions. No fact row is
joined to a dimension where the reduced rows would do, so a dominant entity is never a hot
join key. Windows without a partition key only see calendar days or months.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions import month_of, ratio, round_half_up
from panelkit.operators.latest import latest_row, top_k
from panelkit.operators.ranking import global_ranks
from panelkit.plans.model import Model

# Entities named in the wave and the day-zero query.
WAVE_ENTITIES = ("United States", "India", "United Kingdom", "Brazil", "Germany")
DAY_ZERO_ENTITIES = ("United States", "India", "United Kingdom", "Germany", "Brazil", "Italy")
DAY_OFFSETS = (30, 60, 90, 180, 365, 730)


def pct(top: str, bottom: str, scale: float = 100.0, digits: int = 4) -> Column:
    """Rounded ``top * scale / bottom``; null when the denominator is 0 or null."""
    return round_half_up(ratio(F.col(top), F.col(bottom), scale), digits)


def _latest(m: Model) -> DataFrame:
    return latest_row(m.daily, ["total_cases", "total_deaths"])


def _latest_with_entity(m: Model) -> DataFrame:
    return _latest(m).join(m.countries, "country_id").join(m.regions, "region_id", "left")


def _latest_vaccination(m: Model, counter: str) -> DataFrame:
    return latest_row(
        m.vaccination.where(F.col(counter) > 0), ["people_vaccinated", "people_fully_vaccinated"]
    )


# --- integrity -------------------------------------------------------------------------


def duplicate_keys(m: Model) -> DataFrame:
    return (
        m.daily.groupBy("country_id", "date")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .where("record_count > 1")
    )


def negative_flows(m: Model) -> DataFrame:
    bad = m.daily.where((F.col("new_cases") < 0) | (F.col("new_deaths") < 0))
    return bad.join(m.countries, "country_id").select(
        "country_name", "date", "new_cases", "new_deaths"
    )


def orphans(m: Model) -> DataFrame:
    """Fact rows without an entity row. The ids are compared once each, not once per fact row."""
    lost = m.daily.select("country_id").distinct().join(m.countries, "country_id", "left_anti")
    return m.daily.join(lost, "country_id", "left_semi").select("record_id", "country_id", "date")


def nonmonotonic(m: Model, k: int = 50) -> DataFrame:
    """The largest falls of the case counter from one row to the next."""
    days = Window.partitionBy("country_id").orderBy("date")
    falls = (
        m.daily.select("country_id", "date", "total_cases")
        .withColumn("prev_total_cases", F.lag("total_cases").over(days))
        .withColumn("reporting_drop", F.col("total_cases") - F.col("prev_total_cases"))
        .where("reporting_drop < 0")
        .join(m.countries.select("country_id", "country_name"), "country_id")
        .select("country_name", "date", "total_cases", "prev_total_cases", "reporting_drop")
    )
    return top_k(falls, "reporting_drop", k, ["country_name", "date"], ascending=True)


def completeness(m: Model) -> DataFrame:
    """Per region: entities, fact rows and date range, entities without facts included."""
    per_entity = m.daily.groupBy("country_id").agg(
        F.count("record_id").alias("_rows"),
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
    )
    return (
        m.countries.join(m.regions, "region_id", "left")
        .join(per_entity, "country_id", "left")
        .groupBy(F.coalesce("region_name", F.lit("Unknown")).alias("region"))
        .agg(
            F.count(F.lit(1)).alias("countries_count"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_daily_records"),
            F.min("_first").alias("earliest_report"),
            F.max("_last").alias("latest_report"),
        )
        .orderBy(F.desc("total_daily_records"), "region")
    )


# --- totals over time ------------------------------------------------------------------


def daily_cases(m: Model) -> DataFrame:
    return (
        m.daily.groupBy("date")
        .agg(
            F.sum("new_cases").alias("global_daily_cases"),
            F.sum("total_cases").alias("global_cumulative_cases"),
        )
        .orderBy("date")
    )


def daily_deaths(m: Model) -> DataFrame:
    rate = pct("global_cumulative_deaths", "_cases")
    return (
        m.daily.groupBy("date")
        .agg(
            F.sum("new_deaths").alias("global_daily_deaths"),
            F.sum("total_deaths").alias("global_cumulative_deaths"),
            F.sum("total_cases").alias("_cases"),
        )
        .withColumn("global_case_fatality_rate", F.when(F.col("_cases") > 0, rate).otherwise(0.0))
        .drop("_cases")
        .orderBy("date")
    )


def _rolling_total(m: Model, flow: str, total: str, smoothed: str) -> DataFrame:
    week = Window.partitionBy().orderBy("date").rowsBetween(-6, Window.currentRow)
    return (
        m.daily.groupBy("date")
        .agg(F.sum(flow).alias(total))
        .withColumn(smoothed, round_half_up(F.avg(total).over(week), 2))
        .orderBy("date")
    )


def rolling_cases(m: Model) -> DataFrame:
    return _rolling_total(m, "new_cases", "daily_cases", "rolling_7day_global_cases")


def rolling_deaths(m: Model) -> DataFrame:
    return _rolling_total(m, "new_deaths", "daily_deaths", "rolling_7day_global_deaths")


def _monthly(m: Model, flow: str, total: str, peak: str) -> DataFrame:
    """Mean and maximum are over entity-day rows."""
    return (
        m.daily.groupBy(month_of("date").alias("year_month"))
        .agg(
            F.sum(flow).alias(total),
            round_half_up(F.avg(flow), 2).alias("daily_average_for_month"),
            F.max(flow).alias(peak),
        )
        .orderBy("year_month")
    )


def monthly_cases(m: Model) -> DataFrame:
    return _monthly(m, "new_cases", "monthly_new_cases", "peak_single_day_cases")


def monthly_deaths(m: Model) -> DataFrame:
    return _monthly(m, "new_deaths", "monthly_new_deaths", "peak_single_day_deaths")


def month_over_month(m: Model) -> DataFrame:
    months = Window.partitionBy().orderBy("year_month")

    def growth(total: str, prior: str) -> Column:
        change = F.try_divide((F.col(total) - F.col(prior)) * 100.0, F.col(prior))
        return round_half_up(F.when(F.col(prior) > 0, change), 2)

    return (
        m.daily.groupBy(month_of("date").alias("year_month"))
        .agg(F.sum("new_cases").alias("total_cases"), F.sum("new_deaths").alias("total_deaths"))
        .withColumns(
            {
                "prior_month_cases": F.lag("total_cases").over(months),
                "prior_month_deaths": F.lag("total_deaths").over(months),
            }
        )
        .select(
            "year_month",
            "total_cases",
            "prior_month_cases",
            growth("total_cases", "prior_month_cases").alias("mom_cases_growth_pct"),
            "total_deaths",
            "prior_month_deaths",
            growth("total_deaths", "prior_month_deaths").alias("mom_deaths_growth_pct"),
        )
        .orderBy("year_month")
    )


# --- entities --------------------------------------------------------------------------


def top_cases(m: Model, k: int = 20) -> DataFrame:
    return top_k(_latest_with_entity(m), "total_cases", k, ["country_name"]).select(
        "country_name", "iso_code", "region_name", "total_cases", "total_deaths", "population"
    )


def top_deaths(m: Model, k: int = 20) -> DataFrame:
    return top_k(_latest_with_entity(m), "total_deaths", k, ["country_name"]).select(
        "country_name",
        "iso_code",
        "region_name",
        "total_deaths",
        "total_cases",
        "population",
        pct("total_deaths", "total_cases").alias("cfr_percentage"),
    )


def top_fatality(m: Model, min_cases: float = 50_000, k: int = 25) -> DataFrame:
    rated = _latest_with_entity(m).where(F.col("total_cases") >= min_cases).select(
        "country_name",
        "region_name",
        "total_cases",
        "total_deaths",
        pct("total_deaths", "total_cases").alias("case_fatality_rate"),
    )
    return top_k(rated, "case_fatality_rate", k, ["country_name"])


def _per_100k(m: Model, counter: str, rate: str, min_population: int, k: int) -> DataFrame:
    rated = _latest_with_entity(m).where(F.col("population") >= min_population).select(
        "country_name",
        "region_name",
        "population",
        counter,
        pct(counter, "population", 100_000.0, 2).alias(rate),
    )
    return top_k(rated, rate, k, ["country_name"])


def cases_per_100k(m: Model, min_population: int = 500_000, k: int = 25) -> DataFrame:
    return _per_100k(m, "total_cases", "cases_per_100k", min_population, k)


def deaths_per_100k(m: Model, min_population: int = 500_000, k: int = 25) -> DataFrame:
    return _per_100k(m, "total_deaths", "deaths_per_100k", min_population, k)


def burden_rank(m: Model, min_population: int = 1_000_000, k: int = 30) -> DataFrame:
    """Dense ranks by cases and deaths, absolute and per head; the first ``k`` by cases."""
    per_head = {
        f"_{c}": ratio(F.col(f"total_{c}"), F.col("population"), 100_000.0)
        for c in ("cases", "deaths")
    }
    entities = (
        _latest(m)
        .join(m.countries, "country_id")
        .where(F.col("population") >= min_population)
        .select("country_id", "country_name", "total_cases", "total_deaths", "population")
        .withColumns(per_head)
    )
    ranked = global_ranks(
        entities,
        {
            "case_rank": ("total_cases", "dense"),
            "death_rank": ("total_deaths", "dense"),
            "case_per_capita_rank": ("_cases", "dense"),
            "death_per_capita_rank": ("_deaths", "dense"),
        },
        key="country_id",
    )
    first = top_k(ranked, "case_rank", k, ["country_name"], ascending=True)
    return first.drop("country_id", "population", "_cases", "_deaths")


def region_rank(m: Model) -> DataFrame:
    per_region = (
        _latest_with_entity(m)
        .groupBy(F.coalesce("region_name", F.lit("Unassigned")).alias("region"))
        .agg(
            F.count(F.lit(1)).alias("sovereign_states"),
            F.sum("population").alias("total_regional_population"),
            F.sum("total_cases").alias("total_regional_cases"),
            F.sum("total_deaths").alias("total_regional_deaths"),
        )
    )
    people = "total_regional_population"
    rated = per_region.withColumns(
        {
            "regional_cfr": pct("total_regional_deaths", "total_regional_cases"),
            "regional_cases_per_100k": pct("total_regional_cases", people, 100_000.0, 2),
            "regional_deaths_per_100k": pct("total_regional_deaths", people, 100_000.0, 2),
        }
    )
    ranks = {
        "regional_case_rank": ("total_regional_cases", "min"),
        "regional_death_rank": ("total_regional_deaths", "min"),
    }
    return global_ranks(rated, ranks, key="region").orderBy(F.desc("total_regional_cases"), "region")


# --- vaccination -----------------------------------------------------------------------


def vaccination_status(m: Model, min_population: int = 1_000_000, k: int = 30) -> DataFrame:
    rated = (
        _latest_vaccination(m, "people_vaccinated")
        .join(m.countries, "country_id")
        .where(F.col("population") >= min_population)
        .join(m.regions, "region_id", "left")
        .select(
            "country_name",
            "region_name",
            "population",
            "people_vaccinated",
            "people_fully_vaccinated",
            pct("people_vaccinated", "population", digits=2).alias("single_dose_coverage_pct"),
            pct("people_fully_vaccinated", "population", digits=2).alias("fully_vaccinated_pct"),
            F.col("date").alias("latest_data_reported"),
        )
    )
    return top_k(rated, "fully_vaccinated_pct", k, ["country_name"])


def vaccination_velocity(
    m: Model, min_population: int = 5_000_000, rows: int = 30, k: int = 25
) -> DataFrame:
    """Entity-days with the largest gain over the value ``rows`` rows before."""
    days = Window.partitionBy("country_id").orderBy("date")
    large = m.countries.where(F.col("population") >= min_population).select(
        "country_id", "country_name", "population"
    )
    gains = (
        m.vaccination.select("country_id", "date", "people_fully_vaccinated")
        .join(large, "country_id")
        .withColumn("_before", F.lag("people_fully_vaccinated", rows).over(days))
        .withColumn("monthly_fully_vax_growth", F.col("people_fully_vaccinated") - F.col("_before"))
        .where("monthly_fully_vax_growth > 0")
        .select(
            "country_name",
            F.col("date").alias("peak_acceleration_date"),
            "monthly_fully_vax_growth",
            pct("monthly_fully_vax_growth", "population", digits=2).alias(
                "population_pct_vaccinated_in_30days"
            ),
        )
    )
    return top_k(
        gains, "monthly_fully_vax_growth", k, ["country_name", "peak_acceleration_date"]
    )


def _latest_both(m: Model, min_population: int) -> DataFrame:
    return (
        _latest(m)
        .join(
            _latest_vaccination(m, "people_fully_vaccinated").drop("date", "people_vaccinated"),
            "country_id",
        )
        .join(m.countries, "country_id")
        .where(F.col("population") >= min_population)
    )


def vaccination_tiers(
    m: Model, min_population: int = 1_000_000, high: float = 70, medium: float = 40
) -> DataFrame:
    share = ratio(F.col("people_fully_vaccinated"), F.col("population"), 100.0)
    tier = (
        F.when(share >= high, F.lit(f"High Vax (>={high:g}%)"))
        .when(share >= medium, F.lit(f"Medium Vax ({medium:g}-{high - 1:g}%)"))
        .otherwise(F.lit(f"Low Vax (<{medium:g}%)"))
    )
    return (
        _latest_both(m, min_population)
        .groupBy(tier.alias("vaccination_tier"))
        .agg(
            F.count(F.lit(1)).alias("country_count"),
            F.sum("population").alias("total_population"),
            F.sum("total_cases").alias("total_cases"),
            F.sum("total_deaths").alias("total_deaths"),
        )
        .withColumns(
            {
                "group_case_fatality_rate": pct("total_deaths", "total_cases"),
                "group_cases_per_100k": pct("total_cases", "total_population", 100_000.0, 2),
                "group_deaths_per_100k": pct("total_deaths", "total_population", 100_000.0, 2),
            }
        )
        .orderBy("group_case_fatality_rate", "vaccination_tier")
    )


def vaccination_cross_section(m: Model, min_population: int = 5_000_000, k: int = 30) -> DataFrame:
    rated = (
        _latest_both(m, min_population)
        .join(m.regions, "region_id", "left")
        .select(
            "country_name",
            "region_name",
            "population",
            pct("people_fully_vaccinated", "population", digits=2).alias("fully_vaccinated_pct"),
            pct("total_deaths", "population", 100_000.0, 2).alias("deaths_per_100k"),
            pct("total_deaths", "total_cases").alias("case_fatality_rate"),
        )
    )
    return top_k(rated, "fully_vaccinated_pct", k, ["country_name"])


# --- waves and trajectories ------------------------------------------------------------


def _named(m: Model, entities: Sequence[str]) -> DataFrame:
    """Id and name of the listed entities: names are unique, so at most ``len(entities)`` rows."""
    listed = m.countries.where(F.col("country_name").isin(list(entities)))
    return F.broadcast(listed.select("country_id", "country_name"))


def wave_windows(
    m: Model,
    entities: Sequence[str] = WAVE_ENTITIES,
    floor: float = 5000,
    over_prior: float = 1.4,
    over_next: float = 1.2,
) -> DataFrame:
    """Entity-days whose week mean tops a floor, the two weeks before it and the two after.

    The rounded means are compared. All three frames share one partitioning and sort.
    """
    days = Window.partitionBy("country_id").orderBy("date")

    def mean(first: int, last: int) -> Column:
        return round_half_up(F.avg("new_cases").over(days.rowsBetween(first, last)), 2)

    smoothed = (
        m.daily.select("country_id", "date", "new_cases")
        .join(_named(m, entities), "country_id")
        .withColumns(
            {
                "peak_7day_average_cases": mean(-6, 0),
                "preceding_velocity": mean(-20, -7),
                "succeeding_velocity": mean(1, 14),
            }
        )
    )
    peak = F.col("peak_7day_average_cases")
    return (
        smoothed.where(
            (peak > floor)
            & (peak > F.col("preceding_velocity") * over_prior)
            & (peak > F.col("succeeding_velocity") * over_next)
        )
        .select(
            "country_name",
            F.col("date").alias("wave_peak_date"),
            peak,
            "preceding_velocity",
            "succeeding_velocity",
            round_half_up(peak - F.col("preceding_velocity"), 2).alias("surge_intensity"),
        )
        .orderBy("country_name", "wave_peak_date")
    )


def day_zero(
    m: Model,
    entities: Sequence[str] = DAY_ZERO_ENTITIES,
    threshold: float = 100,
    offsets: Sequence[int] = DAY_OFFSETS,
) -> DataFrame:
    """Counters at fixed numbers of days after each entity's counter reached a threshold."""
    rows = m.daily.select("country_id", "date", "total_cases", "total_deaths").join(
        _named(m, entities), "country_id"
    )
    starts = (
        rows.where(F.col("total_cases") >= threshold)
        .groupBy("country_id")
        .agg(F.min("date").alias("_start"))
    )
    age = F.datediff("date", "_start")
    return (
        rows.join(F.broadcast(starts), "country_id")  # one row per listed entity
        .where(age.isin(list(offsets)))
        .select(
            "country_name", age.alias("days_since_outbreak_start"), "total_cases", "total_deaths"
        )
        .orderBy("days_since_outbreak_start", F.desc("total_cases"), "country_name")
    )


# --- totals ----------------------------------------------------------------------------


def global_totals(m: Model) -> DataFrame:
    """Entity count, population summed once per fact row, and the largest counters.

    The per-row population sum is what the original query returns (the join repeats an entity
    for each of its days); it is computed as population x rows, without repeating anything.
    """
    per_entity = m.daily.groupBy("country_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max("total_cases").alias("_cases"),
        F.max("total_deaths").alias("_deaths"),
    )
    return m.countries.join(per_entity, "country_id").agg(
        F.count(F.lit(1)).alias("total_countries"),
        F.sum(F.col("population") * F.col("_rows")).alias("monitored_population"),
        F.max("_cases").alias("global_total_cases_approx"),
        F.max("_deaths").alias("global_total_deaths_approx"),
    )


def region_stress(m: Model) -> DataFrame:
    return (
        _latest(m)
        .join(m.countries, "country_id")
        .join(m.regions, "region_id")
        .groupBy("region_name")
        .agg(
            F.count(F.lit(1)).alias("country_count"),
            F.sum("total_cases").alias("_cases"),
            F.sum("total_deaths").alias("_deaths"),
        )
        .select(
            "region_name",
            "country_count",
            round_half_up(F.col("_cases") / 1e6, 2).alias("cases_millions"),
            round_half_up(F.col("_deaths") / 1e3, 2).alias("deaths_thousands"),
            pct("_deaths", "_cases", digits=3).alias("regional_cfr"),
        )
        .orderBy(F.desc("cases_millions"), "region_name")
    )


# Every query under its file and place in the SQL suite, and the two summary queries.
QUERIES: dict[str, Callable[[Model], DataFrame]] = {
    "data_quality_1": duplicate_keys,
    "data_quality_2": negative_flows,
    "data_quality_3": orphans,
    "data_quality_4": nonmonotonic,
    "data_quality_5": completeness,
    "global_1": daily_cases,
    "global_2": daily_deaths,
    "global_8": rolling_cases,
    "global_9": rolling_deaths,
    "global_11": monthly_cases,
    "global_12": monthly_deaths,
    "country_3": top_cases,
    "country_4": top_deaths,
    "country_5": top_fatality,
    "country_6": cases_per_100k,
    "country_7": deaths_per_100k,
    "country_13": burden_rank,
    "country_14": region_rank,
    "vaccination_10": vaccination_status,
    "vaccination_16": vaccination_velocity,
    "vaccination_17": vaccination_tiers,
    "vaccination_18": vaccination_cross_section,
    "advanced_15": month_over_month,
    "advanced_waves": wave_windows,
    "advanced_day_zero": day_zero,
    "summary_totals": global_totals,
    "summary_regions": region_stress,
}


def run_suite(m: Model) -> dict[str, DataFrame]:
    """All queries of the suite with their default parameters."""
    return {name: query(m) for name, query in QUERIES.items()}
