"""What the corpus operators share: word patterns, whole-text columns, stored intermediate tables."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the operators' contracts.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """Words between runs of ASCII white space, as an array."""
    return F.array_remove(F.split(text, SPACE), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else untouched (``lower`` also changes letters beyond ASCII)."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where the optimizer moves the expression."""
    return F.transform(F.array(value), use)[0]
