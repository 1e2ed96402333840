"""Feature panel sink: Parquet and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelkit.sources.csv import write_csv


def write_feature_panel(df: DataFrame, path: str) -> DataFrame:
    """Write ``path/parquet`` (Snappy) and ``path/csv``; returns a scan of the Parquet table.

    The CSV is written from the stored Parquet, so the features are computed once.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/parquet")
    stored = spark.read.parquet(f"{path}/parquet")
    write_csv(stored, f"{path}/csv")
    return stored
