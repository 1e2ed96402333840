"""Helpers of the tests: session, DuckDB views, and an exact comparison of results."""

from __future__ import annotations

import datetime

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("panelkit-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "1000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("FATAL")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _cell(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and np.isnan(value)):
        return "null"
    if isinstance(value, (bool, np.bool_)):
        return str(bool(value))
    if isinstance(value, (int, float, np.integer, np.floating)):
        return f"{float(value):.9g}"
    if isinstance(value, (pd.Timestamp, datetime.datetime)):
        return value.isoformat()[:10] if value == value.normalize() else value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return str(value)


def canonical(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(_cell(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def difference(got: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """None when both hold the same columns and the same rows in any order."""
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    left, right = canonical(got), canonical(expected)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        return f"{len(different)} rows differ, first {different[0][0]} != {different[0][1]}"
    return None
