"""Audit records: one row per read or write of a source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "source_name string, saved_path string, record_count long, column_count int, "
    "columns array<string>, file_size_bytes long, ingested_at_utc timestamp, "
    "notes map<string,string>"
)


def _append_record(
    spark: SparkSession,
    columns: list[str],
    rows: int,
    path: str,
    source: str,
    audit_path: str,
    notes: Mapping[str, str] | None,
) -> DataFrame:
    # only the file listing is read, not the content
    files = spark.read.format("binaryFile").load(path).select("length")
    pairs: list[Column] = [F.lit(x) for pair in (notes or {}).items() for x in pair]
    record = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).select(
        F.lit(source).alias("source_name"),
        F.lit(path).alias("saved_path"),
        F.lit(rows).cast("long").alias("record_count"),
        F.lit(len(columns)).alias("column_count"),
        F.array(*map(F.lit, columns)).alias("columns"),
        F.col("bytes").alias("file_size_bytes"),
        F.current_timestamp().alias("ingested_at_utc"),
        F.create_map(*pairs).cast("map<string,string>").alias("notes"),
    )
    record.write.mode("append").parquet(audit_path)
    return latest_audit(spark, audit_path).where(F.col("source_name") == source)


def write_with_audit(
    df: DataFrame,
    path: str,
    source: str,
    audit_path: str,
    format: str = "parquet",
    notes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write ``df`` and append a record of it to the audit table; returns that record.

    The rows are counted while they are written, not in a second pass. The bytes are those of
    the stored files.
    """
    counted = Observation()
    watched = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    watched.write.mode("overwrite").option("header", True).format(format).save(path)
    rows = counted.get["rows"]
    return _append_record(df.sparkSession, df.columns, rows, path, source, audit_path, notes)


def audit_source(
    df: DataFrame,
    path: str,
    source: str,
    audit_path: str,
    notes: Mapping[str, str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Append a record of data that is stored at ``path`` already and was read as ``df``.

    ``rows`` is their number where it is known, for instance observed by the job that used the data;
    otherwise the data is read again to count it.
    """
    rows = df.count() if rows is None else rows
    return _append_record(df.sparkSession, df.columns, rows, path, source, audit_path, notes)


def latest_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """The newest audit record of each source."""
    try:
        records = spark.read.schema(AUDIT_SCHEMA).parquet(audit_path)
    except AnalysisException as error:
        raise FileNotFoundError(audit_path) from error
    # map columns cannot be compared, but only the time is
    rest = [c for c in records.columns if c != "source_name"]
    newest = F.max_by(F.struct(*rest), F.col("ingested_at_utc")).alias("r")
    return records.groupBy("source_name").agg(newest).select("source_name", "r.*")
