"""Latest row per entity and deterministic top-k."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_row(
    df: DataFrame, columns: Sequence[str], entity: str = "country_id", date: str = "date"
) -> DataFrame:
    """Columns of each entity's last date, one row per entity.

    One aggregate instead of a ``max(date)`` self-join. Every ``max_by`` of a number has a
    fixed-width buffer, so this runs as a hash aggregate that combines before the shuffle:
    one entity with most of the rows still sends one row per task.
    """
    return df.groupBy(entity).agg(
        F.max(date).alias(date), *[F.max_by(c, date).alias(c) for c in columns]
    )


def fixed_width(kind: T.DataType) -> bool:
    """Whether a hash aggregate can hold a value of this type in its buffer."""
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def picked_rows(df: DataFrame, keys: Sequence[str], date: str, last: bool = True) -> DataFrame:
    """One row per key, that of its last (or first) date, with all columns.

    Two steps. A hash aggregate finds the place of the row: its day and the hash of its values,
    packed into one number of fixed width. The few places then fetch the rows, so text is never
    held in an aggregate's buffer. Of several rows of that day the one with the largest
    (smallest) hash is taken; keys without any date have no row.
    """
    rest = [c for c in df.columns if c not in keys]
    day = F.unix_date(F.col(date).cast("date")).cast("decimal(10,0)")
    missing = F.concat(*[F.col(c).isNull().cast("string") for c in rest])  # nulls leave a hash as it is
    place = day * F.lit(Decimal(2**64)) + F.xxhash64(*rest, missing).cast("decimal(20,0)")
    placed = df.where(F.col(date).isNotNull()).withColumn("_place", place)
    best = placed.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(
        (F.max if last else F.min)("_place").alias("_best")
    )
    same = F.col("_place") == F.col("_best")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return placed.join(best, same).select(*df.columns).distinct()


def last_known(
    df: DataFrame, columns: Sequence[str], entity: str = "country", date: str = "date"
) -> DataFrame:
    """Each column's last non-null value per entity (columns may come from different dates).

    Values of fixed width come from one hash aggregate, which also finds the last date of each
    other column; the rows of these dates then fetch its value (the smallest, if a day has several).
    """
    df = df.where(F.col(entity).isNotNull())
    wide = [c for c in columns if not fixed_width(df.schema[c].dataType)]

    def dated(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col(date))

    known = df.groupBy(entity).agg(
        *[F.max_by(c, dated(c)).alias(c) for c in columns if c not in wide],
        *[F.max(dated(c)).alias(f"_date_{i}") for i, c in enumerate(wide)],
    )
    if not wide:
        return known.select(entity, *columns)
    dates = known.select(F.col(entity).alias("_entity"), *[f"_date_{i}" for i in range(len(wide))])
    at = [F.when(F.col(date) == F.col(f"_date_{i}"), F.col(c)) for i, c in enumerate(wide)]
    hits = df.select(entity, date, *wide).join(dates, F.col(entity) == F.col("_entity"))
    hits = hits.where(reduce(Column.__or__, [a.isNotNull() for a in at]))
    texts = hits.groupBy("_entity").agg(
        *[F.array_min(F.collect_set(a)).alias(c) for a, c in zip(at, wide)]
    )
    return known.join(texts, F.col(entity) == F.col("_entity"), "left").select(entity, *columns)


def top_k(
    df: DataFrame, by: str | Column, k: int, ties: Sequence[str], ascending: bool = False
) -> DataFrame:
    """First ``k`` rows by ``by``; ``ties`` make the choice repeatable. Runs as a bounded heap
    per task, never as a full sort."""
    by = F.col(by) if isinstance(by, str) else by
    head = by.asc_nulls_last() if ascending else by.desc_nulls_last()
    return df.orderBy(head, *[F.col(t).asc() for t in ties]).limit(k)
