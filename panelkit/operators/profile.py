"""Column contract and data-set profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.quality import column_nulls

# Columns a source must have.
REQUIRED_COLUMNS = (
    "iso_code",
    "continent",
    "location",
    "date",
    "total_cases",
    "new_cases",
    "total_deaths",
    "new_deaths",
    "population",
)


def validate_columns(
    source: DataFrame | Sequence[str],
    required: Sequence[str] = REQUIRED_COLUMNS,
    spark: SparkSession | None = None,
) -> DataFrame:
    """One row: PASS or FAIL, counts, and the missing and present columns in sorted order."""
    names = source.columns if isinstance(source, DataFrame) else list(source)
    spark = source.sparkSession if isinstance(source, DataFrame) else (
        spark or SparkSession.active()
    )
    missing = sorted(set(required) - set(names))
    found = sorted(set(required) & set(names))
    return spark.createDataFrame(
        [("FAIL" if missing else "PASS", len(set(names)), len(required), missing, found)],
        "status string, total_columns_found int, required_columns_count int, "
        "missing_columns array<string>, present_required_columns array<string>",
    )


def validate_feed(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """``validate_columns`` with the number of rows and of nulls in the present required columns.

    One pass that reads only these columns.
    """
    names = set(df.columns)
    missing, found = sorted(set(required) - names), sorted(set(required) & names)
    rows = F.count(F.lit(1))
    nulls = sum((rows - F.count(c) for c in found), F.lit(0).cast("long"))
    texts = "array<string>"
    return df.agg(rows.alias("row_count"), nulls.alias("null_count")).select(
        F.lit("FAIL" if missing else "PASS").alias("status"),
        F.lit(len(names)).alias("total_columns_found"),
        F.lit(len(required)).alias("required_columns_count"),
        F.array(*map(F.lit, missing)).cast(texts).alias("missing_columns"),
        F.array(*map(F.lit, found)).cast(texts).alias("present_required_columns"),
        "row_count",
        "null_count",
    )


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, row count, null count and percentage, most-null first
    when sorted by ``null_pct``. One pass over the data."""
    kinds = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, start=1)],
        "position int, column string, type string",
    )
    nulls = column_nulls(df, df.columns).drop("health")
    return kinds.join(nulls, "column").select(
        "position", "column", "type", "null_count", "null_pct"
    )


def row_count(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )
