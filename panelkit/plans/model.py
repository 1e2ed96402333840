"""Dimensional model: regions, entities, entity statistics, two daily facts, metadata.

Ids are counters in the (country, date) order of the feature panel and come from bucketed positions,
so neither the entities nor the facts pass through one task. Fact rows are stored once with their
ids. Stored facts have a folder per year; a filter on ``year`` (see ``in_period``), or a join with a
filtered calendar, reads the folders it needs. Joins carry no broadcast hint: Spark broadcasts a
dimension when its measured size allows and sort-merges it otherwise.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields, replace
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.operators.latest import picked_rows
from panelkit.operators.ranking import number_rows, running_positions
from panelkit.session import materialise, new_path

# Table names that SQL text refers to.
VIEW_NAMES = {
    "regions": "regions",
    "countries": "countries",
    "population_stats": "population_stats",
    "daily": "daily_covid_stats",
    "vaccination": "vaccination_stats",
    "metadata": "pipeline_metadata",
}

# Fact and statistics columns (model column -> panel column).
DAILY_COLUMNS = {
    "new_cases": "new_cases",
    "total_cases": "total_cases",
    "new_deaths": "new_deaths",
    "total_deaths": "total_deaths",
    "case_fatality_rate": "case_fatality_rate",
    "cases_per_100k": "cases_per_100k",
    "deaths_per_100k": "deaths_per_100k",
    "rolling_7day_cases": "7_day_cases_avg",
    "rolling_7day_deaths": "7_day_deaths_avg",
}
VACCINATION_COLUMNS = {
    "total_vaccinations": "total_vaccinations",
    "people_vaccinated": "people_vaccinated",
    "people_fully_vaccinated": "people_fully_vaccinated",
    "new_vaccinations": "new_vaccinations",
    "vaccination_rate": "vaccination_rate",
    "fully_vaccinated_rate": "fully_vaccinated_rate",
}
STATISTICS = (
    "population_density",
    "median_age",
    "gdp_per_capita",
    "life_expectancy",
    "hospital_beds_per_thousand",
)


@dataclass(frozen=True)
class Model:
    regions: DataFrame
    countries: DataFrame
    population_stats: DataFrame
    daily: DataFrame
    vaccination: DataFrame
    metadata: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        named = {f.name: getattr(self, f.name) for f in fields(self)}
        return {k: v for k, v in named.items() if v is not None}

    def register(self, names: Mapping[str, str] = VIEW_NAMES) -> None:
        """Create the temporary views that SQL text refers to, and the function ``julianday`` for
        text that takes day differences with it."""
        for name, table in self.tables().items():
            table.createOrReplaceTempView(names[name])
        self.daily.sparkSession.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION julianday(d DATE) RETURNS DOUBLE "
            "RETURN unix_date(d) + 2440587.5D"
        )

    def save(self, buckets: int, names: Mapping[str, str] = VIEW_NAMES) -> Model:
        """The model as catalog tables in the shared folder, replacing earlier ones.

        Facts are bucketed by entity: windows and aggregates per entity on them need no shuffle.
        Use about one bucket per 256 MB of fact data.
        """
        saved = {}
        for name, table in self.tables().items():
            spark = table.sparkSession
            # bucket files hold whole buckets, so each is written by one task
            writer = table.write
            if name in ("daily", "vaccination"):
                writer = table.repartition(buckets, "country_id").write
                writer = writer.bucketBy(buckets, "country_id").sortBy("country_id", "date")
            path = new_path(spark, names[name])
            writer.mode("overwrite").saveAsTable(names[name], path=path, format="parquet")
            saved[name] = spark.table(names[name])
        return replace(self, **saved)

    def counts(self) -> DataFrame:
        """Rows per table."""
        result = None
        for name, table in self.tables().items():
            one = table.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"), "rows"
            )
            result = one if result is None else result.union(one)
        return result


def _entity_column(panel: DataFrame) -> str:
    return "country" if "country" in panel.columns else "location"


def _region_column(panel: DataFrame) -> str | None:
    return next((c for c in ("region", "continent") if c in panel.columns), None)


def build_regions(panel: DataFrame) -> DataFrame:
    """Distinct non-blank regions, numbered in order of first appearance."""
    region, entity = _region_column(panel), _entity_column(panel)
    if region is None:
        return panel.sparkSession.createDataFrame(
            [(1, "Global")], "region_id int, region_name string"
        )
    known = panel.where(F.col(region).isNotNull() & (F.trim(region) != ""))
    # min of text needs a sort-based aggregate, so a hash aggregate reduces the rows first
    first = (
        known.select(F.col(region).alias("region_name"), F.col(entity).alias("_entity"))
        .distinct()
        .groupBy("region_name")
        .agg(F.min("_entity").alias("_first"))
    )
    # U+0000 sorts before any character, so this key orders by entity, then region
    keyed = first.withColumn("_key", F.concat_ws("\u0000", "_first", "region_name"))
    return number_rows(keyed, "_key", "region_id").select("region_id", "region_name")


def _first_rows(panel: DataFrame) -> DataFrame:
    """One row per entity: the attributes of its earliest row."""
    entity, region = _entity_column(panel), _region_column(panel)
    optional = {
        "iso_code": "string",
        "population": "double",
        **{c: "double" for c in STATISTICS},
    }
    attributes = [
        (F.col(c) if c in panel.columns else F.lit(None)).cast(kind).alias(c)
        for c, kind in optional.items()
    ]
    name = F.col(region) if region else F.lit("Global")
    attributes.append(name.cast("string").alias("_region"))
    rows = panel.where(F.col(entity).isNotNull()).select(
        F.col(entity).alias("country_name"), F.col("date").cast("date").alias("_date"), *attributes
    )
    return picked_rows(rows, ["country_name"], "_date", last=False).drop("_date")


def _numbered_entities(panel: DataFrame) -> DataFrame:
    population = F.when(F.col("population") > 0, F.col("population").cast("long"))
    return number_rows(_first_rows(panel), "country_name", "country_id").withColumn(
        "population", population
    )


def _with_region_id(numbered: DataFrame, regions: DataFrame) -> DataFrame:
    return numbered.join(regions, F.col("_region") == F.col("region_name"), "left").select(
        "country_id",
        F.coalesce("iso_code", F.lit("")).alias("iso_code"),
        "country_name",
        "region_id",
        "population",
        "population_density",
        "median_age",
    )


def build_entities(panel: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """One row per entity with the attributes of its first row and its region id."""
    regions = build_regions(panel) if regions is None else regions
    return _with_region_id(_numbered_entities(panel), regions)


def build_entity_stats(panel: DataFrame) -> DataFrame:
    """Demographic extension of the entity dimension."""
    return _numbered_entities(panel).select("country_id", "population", *STATISTICS)


def _measure(rows: DataFrame, source: str, target: str) -> Column:
    value = F.col(source) if source in rows.columns else F.lit(0.0)
    return value.cast("double").alias(target)


def _numbered_rows(panel: DataFrame, countries: DataFrame) -> DataFrame:
    """Panel rows with entity id, year and a record id: 1, 2, ... in (country, date) order."""
    entity = _entity_column(panel)
    own = ("country_id", "country_name", "record_id", "year")
    days = panel.drop(*own).where(F.col("date").isNotNull())
    sizes = days.groupBy(entity).agg(F.count(F.lit(1)).alias("_rows"))
    named = sizes.join(
        countries.select("country_id", "country_name"), F.col(entity) == F.col("country_name")
    )
    starts = running_positions(named, "country_id", "_rows").select(
        "country_id", F.col("before").alias("_start"), F.col(entity).alias("_of")
    )
    in_entity = Window.partitionBy(entity).orderBy("date")  # same key as the join
    return days.join(starts, F.col(entity) == F.col("_of")).withColumns(
        {
            "record_id": (F.col("_start") + F.row_number().over(in_entity)).cast("long"),
            "year": F.year(F.col("date").cast("date")),
        }
    )


def _stored_rows(
    panel: DataFrame, countries: DataFrame, measures: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """The numbered rows, stored: all readers see the same ids, and none numbers the rows anew."""
    rows = _numbered_rows(panel, countries)
    sources = [c for c in measures if c in rows.columns]
    return materialise(rows.select("record_id", "country_id", "date", *sources, "year"), "facts", by)


def _fact(rows: DataFrame, columns: Mapping[str, str], *more: str) -> DataFrame:
    return rows.select(
        "record_id",
        "country_id",
        F.col("date").cast("date").alias("date"),
        *[_measure(rows, source, target) for target, source in columns.items()],
        *more,
    )


def in_period(fact: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of a stored fact from ``start`` to ``end``, both included; only folders of these years
    are read."""
    for bound, inside, year in (
        (start, lambda day: F.col("date") >= day, lambda y: F.col("year") >= y),
        (end, lambda day: F.col("date") <= day, lambda y: F.col("year") <= y),
    ):
        if bound is not None:
            day = F.lit(bound).cast("date")
            fact = fact.where(inside(day) & year(F.year(day)))
    return fact


def build_daily_fact(panel: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Daily flows, counters, rates and rolling means per entity id. Nulls stay null."""
    countries = build_entities(panel) if countries is None else countries
    return _fact(_stored_rows(panel, countries, [*DAILY_COLUMNS.values()]), DAILY_COLUMNS)


def build_vaccination_fact(panel: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Daily doses, people covered and coverage rates per entity id. Nulls stay null."""
    countries = build_entities(panel) if countries is None else countries
    return _fact(_stored_rows(panel, countries, [*VACCINATION_COLUMNS.values()]), VACCINATION_COLUMNS)


def build_metadata(spark: SparkSession, **values: str) -> DataFrame:
    """One audit row: id, the given text columns, and the creation time."""
    return spark.range(1).select(
        F.lit(1).alias("metadata_id"),
        *[F.lit(v).alias(k) for k, v in values.items()],
        F.current_timestamp().alias("created_at_utc"),
    )


def build_all(panel: DataFrame, metadata: Mapping[str, str] | None = None) -> Model:
    """The whole model from a feature panel.

    Dimensions and numbered fact rows are stored once, these with a folder per year; the two facts are
    projections of the same stored rows, so the ids and the join are computed once and scans stay
    column-pruned.
    """
    regions = materialise(build_regions(panel), "regions")
    numbered = materialise(_numbered_entities(panel), "entities")
    countries = materialise(_with_region_id(numbered, regions), "countries")
    measures = [*DAILY_COLUMNS.values(), *VACCINATION_COLUMNS.values()]
    rows = _stored_rows(panel, countries, measures, ["year"])
    model = Model(
        regions,
        countries,
        numbered.select("country_id", "population", *STATISTICS),
        _fact(rows, DAILY_COLUMNS, "year"),
        _fact(rows, VACCINATION_COLUMNS, "year"),
    )
    if metadata is None:
        return model
    return replace(model, metadata=build_metadata(panel.sparkSession, **metadata))


def split_statements(text: str) -> list[str]:
    """Statements of a SQL text: comment lines dropped, split at semicolons."""
    lines = [line for line in text.splitlines() if not line.lstrip().startswith("--")]
    return [s.strip() for s in "\n".join(lines).split(";") if s.strip()]


def run_query(spark: SparkSession, sql: str, params: Mapping[str, Any] | Sequence[Any] | None = None) -> DataFrame:
    """One SQL query over the registered views, with bound parameters."""
    return spark.sql(sql, args=params) if params else spark.sql(sql)


def run_sql_suite(spark: SparkSession, text: str) -> list[DataFrame]:
    """Results of all statements of a SQL text; a statement Spark rejects is skipped with a
    warning. Results are lazy, so a failure while running shows when a result is used."""
    results = []
    for number, statement in enumerate(split_statements(text), start=1):
        try:
            results.append(spark.sql(statement))
        except PySparkException as error:
            warnings.warn(f"statement {number} skipped: {error}", stacklevel=2)
    return results


def run_sql_file(spark: SparkSession, path: str) -> list[DataFrame]:
    """``run_sql_suite`` on a text file; the path may be any that Spark can read."""
    try:
        text = spark.read.text(path, wholetext=True).first()
    except PySparkException as error:
        raise FileNotFoundError(path) from error
    return run_sql_suite(spark, text["value"] if text else "")
