"""Quality gates: PASS / WARN / FAIL checks over a panel.

A report reads its panel once. Counts of nulls, dates and signs are observed while the rows go by;
both duplicate gates and the coverage come from the same rows, of which keys and digests alone are
shuffled, after each task has reduced the copies of a row. What reaches the driver is one row of
numbers, and the tables of the report are made of it.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import DATE_FORMATS, as_number, parse_date, round_even
from panelkit.operators.cleaning import present

CORE_COLUMNS = ("total_cases", "total_deaths", "population")


@dataclass(frozen=True)
class QualityReport:
    """``checks``: one row per gate; ``column_nulls``: one row per core column;
    ``summary``: one row with the overall status and totals."""

    checks: DataFrame
    column_nulls: DataFrame
    summary: DataFrame


def null_count(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def as_rows(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """Turn a one-row aggregate into rows (``name``, ``value``)."""
    return one_row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias(name), F.col(c).cast("long").alias(value))
                    for c in one_row.columns
                ]
            )
        )
    )


def _date_value(df: DataFrame, date: str, formats: Sequence[str]) -> Column:
    kind = df.schema[date].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(date).cast("date")
    return parse_date(date, formats)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of surplus rows over one per key. Null keys count as equal."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return per_key.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("surplus"))


def row_digests(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row. Nulls leave a hash as it is, so their places are hashed too."""
    columns = [F.col(c) for c in df.columns]
    missing = F.concat(F.lit(""), *[c.isNull().cast("int").cast("string") for c in columns])
    return [F.xxhash64(F.lit(seed), *columns, missing).alias(f"_digest_{seed}") for seed in (1, 2)]


def exact_duplicates(df: DataFrame) -> DataFrame:
    """One row: number of surplus rows over one per distinct row.

    Rows enter the grouping key as digests of fixed width, so long rows do not travel through the
    shuffle; copies are counted per task before it.
    """
    digests = df.select(*row_digests(df))
    return duplicate_keys(digests, digests.columns)


def duplicate_metrics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, surplus rows per key, surplus copies of whole rows, distinct values of the first key.

    Copies of a row share its key, so a key's rows are counted together with its distinct digests.
    Each task first sends one row per key and digest, so a key with most of the rows is divided by its
    digests; then counts alone are brought together by key.
    """
    digests = [F.col(c) for c in df.columns if c.startswith("_digest_")] or row_digests(df)
    rows = df.select(*keys, *digests)
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_distinct("_digest_1", "_digest_2").alias("_different")
    )
    per_entity = per_key.groupBy(keys[0]).agg(
        F.sum("_rows").alias("_all"),
        F.sum(F.col("_rows") - 1).alias("_keys"),
        F.sum(F.col("_rows") - F.col("_different")).alias("_copies"),
    )
    return per_entity.agg(
        F.coalesce(F.sum("_all"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_keys"), F.lit(0)).alias("duplicate_key"),
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("exact_duplicate"),
        F.count(keys[0]).alias("distinct_entities"),
    )


def metric_columns(
    df: DataFrame,
    entity: str | None = "country",
    date: str | None = "date",
    flows: Sequence[str] = ("new_cases", "new_deaths"),
    formats: Sequence[str] = DATE_FORMATS,
) -> list[Column]:
    """Named counts: rows, key nulls, unparseable dates, negatives, and the date range as day numbers.
    A missing column counts as missing in every row; a missing flow as 0."""
    everything = F.count(F.lit(1))
    parsed = _date_value(df, date, formats) if date else F.lit(None).cast("date")
    negatives = [
        (
            F.count_if(as_number(c) < 0) if c in df.columns else F.lit(0).cast("long")
        ).alias(f"negative_{i}")
        for i, c in enumerate(flows)
    ]
    return [
        everything.alias("total_records"),
        (null_count(entity) if entity else everything).alias("missing_entity"),
        (null_count(date) if date else everything).alias("missing_date"),
        F.count_if(parsed.isNull()).alias("invalid_date"),
        F.unix_date(F.min(parsed)).alias("min_day"),
        F.unix_date(F.max(parsed)).alias("max_day"),
        *negatives,
    ]


def panel_metrics(
    df: DataFrame,
    entity: str | None = "country",
    date: str | None = "date",
    flows: Sequence[str] = ("new_cases", "new_deaths"),
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """One row: ``metric_columns`` and the number of distinct entities."""
    distinct = (F.countDistinct(entity) if entity else F.lit(0)).alias("distinct_entities")
    return df.agg(*metric_columns(df, entity, date, flows, formats), distinct)


def _completeness(counts: DataFrame) -> DataFrame:
    """Percentage (two decimals) and health band of rows (column, null_count, rows)."""
    pct = F.try_divide(F.col("null_count"), F.col("rows")) * 100.0
    return counts.select(
        "column", "null_count", F.coalesce(round_even(pct, 2), F.lit(0.0)).alias("null_pct")
    ).withColumn(
        "health",
        F.when(F.col("null_pct") < 5, "Excellent")
        .when(F.col("null_pct") < 25, "Acceptable")
        .otherwise("Sparse"),
    )


def column_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count, percentage (two decimals) and health band per column."""
    counts = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                null_count(c).alias("null_count"),
                F.count(F.lit(1)).alias("rows"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    )
    return _completeness(counts.select(F.inline(F.array(*[f"c{i}" for i in range(len(columns))]))))


@dataclass(frozen=True)
class Metrics:
    """What a report needs to know of each row of a panel: observed while the rows are read, or while
    another job stores them, with ``df.observe(observation, *metrics.columns)``."""

    entity: str | None
    date: str | None
    core: tuple[str, ...]
    columns: tuple[Column, ...]


def report_metrics(
    df: DataFrame,
    entity: str = "country",
    date: str = "date",
    cases: str = "new_cases",
    deaths: str = "new_deaths",
    formats: Sequence[str] = DATE_FORMATS,
) -> Metrics:
    """The metrics of ``quality_report`` with the same arguments."""
    found = entity if entity in df.columns else ("location" if "location" in df.columns else None)
    day = date if date in df.columns else None
    core = tuple([c for c in (found, day) if c] + present(df, (cases, deaths, *CORE_COLUMNS)))
    nulls = [null_count(c).alias(f"null_{i}") for i, c in enumerate(core)]
    return Metrics(found, day, core, (*metric_columns(df, found, day, (cases, deaths), formats), *nulls))


# Gates (metric, name, condition, severity), in report order; None stands for the
# number of entities that is expected.
GATES = (
    ("missing_entity", "Missing Country Names", "Must be 0", "CRITICAL"),
    ("missing_date", "Missing Dates", "Must be 0", "CRITICAL"),
    ("invalid_date", "Invalid Date Formats", "Must be 0", "CRITICAL"),
    ("duplicate_key", "Duplicate Country-Date Records", "Must be 0", "HIGH"),
    ("exact_duplicate", "Exact Duplicate Rows", "Must be 0", "MEDIUM"),
    ("negative_0", "Negative New Cases", "Must be 0", "MEDIUM"),
    ("negative_1", "Negative New Deaths", "Must be 0", "MEDIUM"),
    ("distinct_entities", "Country Coverage", None, "MEDIUM"),
)


def quality_report(
    df: DataFrame,
    entity: str = "country",
    date: str = "date",
    cases: str = "new_cases",
    deaths: str = "new_deaths",
    min_entities: int = 150,
    formats: Sequence[str] = DATE_FORMATS,
    observed: Mapping[str, int] | None = None,
) -> QualityReport:
    """Eight gates with an overall status, plus per-column completeness.

    One job reads the panel once. ``observed`` are the values of ``report_metrics`` where an earlier
    job has observed them; then the job reads keys and row digests only.
    """
    spark, metrics = df.sparkSession, report_metrics(df, entity, date, cases, deaths, formats)
    watch = None if observed is not None else Observation()
    rows = df if watch is None else df.observe(watch, *metrics.columns)
    keys = [c for c in (metrics.entity, metrics.date) if c]
    if keys:
        found = duplicate_metrics(rows, keys).collect()[0].asDict()
        if len(keys) < 2:
            found["duplicate_key"] = 0  # there is no key to be duplicated
    else:
        digests = rows.select(*row_digests(df), F.lit(0).alias("_none"))
        found = duplicate_metrics(digests, ["_none"]).collect()[0].asDict()
        found["duplicate_key"] = 0
    if not found["rows"]:
        raise ValueError("the quality checks need at least one row")
    if metrics.entity is None:
        found["distinct_entities"] = 0
    found |= observed if watch is None else watch.get

    value = {name: int(found.get(name) or 0) for name, *_ in GATES}
    checks, statuses = [], {}
    for position, (source, name, condition, severity) in enumerate(GATES, start=1):
        holds = value[source] >= min_entities if condition is None else value[source] == 0
        status = "PASS" if holds else "FAIL" if severity in ("CRITICAL", "HIGH") else "WARN"
        statuses[source] = status
        condition = condition or f"Expected >= {min_entities}"
        checks.append((position, name, value[source], condition, status, severity))
    overall = max(statuses.values(), key=("PASS", "WARN", "FAIL").index)
    days = [None if found[name] is None else date_of(found[name]) for name in ("min_day", "max_day")]
    summary = (
        overall,
        found["total_records"],
        value["distinct_entities"],
        *days,
        value["exact_duplicate"],
        value["duplicate_key"],
        # a null date is counted as missing and as unparseable
        value["missing_entity"] + value["missing_date"] + value["invalid_date"],
    )
    nulls = [(c, found[f"null_{i}"], found["total_records"]) for i, c in enumerate(metrics.core)]
    return QualityReport(
        spark.createDataFrame(
            checks, "position int, name string, metric long, condition string, status string, severity string"
        ),
        _completeness(spark.createDataFrame(nulls, "column string, null_count long, rows long")),
        spark.createDataFrame(
            [summary],
            "overall_status string, total_records long, distinct_entities long, min_date date, max_date date, "
            "duplicate_records long, duplicate_keys long, invalid_records long",
        ),
    )


def date_of(day: int) -> datetime.date:
    return datetime.date(1970, 1, 1) + datetime.timedelta(days=day)
