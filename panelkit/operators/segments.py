"""Windows per entity in segments, for entities that are too large for one task.

A window partitioned by entity alone holds a whole entity in one task. Here the rows of an entity
are divided into segments of neighbouring days or rows, each a partition of its own:

* for trailing windows and lags, each segment also gets the last rows before it (its context), which
  are dropped after the window is computed;
* for fills, an aggregate gives each segment's first and last known values; a window over these few
  rows carries them from segment to segment.

The results are those of the plain windows. A panel must be unique by (entity, date).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

SEGMENT, CONTEXT = "_segment", "_context"


def day_segment(date: str, days: int) -> Column:
    return F.floor(F.unix_date(F.col(date).cast("date")) / F.lit(days)).cast("long")


def numbered_in_entity(df: DataFrame, entity: str, date: str, days: int) -> DataFrame:
    """Add ``_position``: the number of earlier rows of the entity, without a window over all of them.

    Rows are counted per segment of days; segments are offset by the counts of those before, and
    rows numbered inside theirs.
    """
    dated = df.withColumn(SEGMENT, day_segment(date, days))
    counts = dated.groupBy(entity, SEGMENT).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(entity).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(entity).alias("_entity"),
        F.col(SEGMENT).alias("_of"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
    )
    # rows without a date come first and are in no segment
    same = F.col(entity).eqNullSafe(F.col("_entity")) & F.col(SEGMENT).eqNullSafe(F.col("_of"))
    inside = Window.partitionBy(entity, SEGMENT).orderBy(date)
    return (
        dated.join(starts, same)
        .withColumn("_position", F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_entity", "_of", "_start", SEGMENT)
    )


def with_context(
    df: DataFrame, entity: str, date: str, length: int, context: int, by: str = "rows"
) -> DataFrame:
    """The rows with ``_segment``, and again with ``_context`` for the next segment those that lie at
    most ``context`` rows (or days) before it."""
    if length < max(context, 1):
        raise ValueError("a segment must be at least as long as the widest window")
    if by == "rows":
        placed = numbered_in_entity(df, entity, date, length)
        place = F.col("_position")
    else:
        placed, place = df, F.unix_date(F.col(date).cast("date")).cast("long")
    segment = F.floor(place / F.lit(length)).cast("long")
    needed = F.pmod(place, F.lit(length)) >= length - context
    copies = F.array(F.struct(segment.alias(SEGMENT), F.lit(False).alias(CONTEXT)))
    again = F.array(F.struct((segment + 1).alias(SEGMENT), F.lit(True).alias(CONTEXT)))
    everywhere = F.when(needed, F.concat(copies, again)).otherwise(copies)
    return placed.select("*", F.inline(everywhere)).drop("_position")


def windowed(
    df: DataFrame,
    entity: str,
    date: str,
    length: int,
    context: int,
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    by: str = "rows",
) -> DataFrame:
    """``df`` with columns over windows that look back ``context`` rows (or days) at most.

    ``columns`` gets the window of a segment, without order, and returns the columns.
    """
    spread = with_context(df, entity, date, length, context, by)
    computed = spread.withColumns(dict(columns(Window.partitionBy(entity, SEGMENT))))
    return computed.where(~F.col(CONTEXT)).drop(SEGMENT, CONTEXT)


def carried(
    df: DataFrame, entity: str, date: str, days: int, forward: Sequence[str], both: Sequence[str]
) -> DataFrame:
    """``df`` with the last known value so far of the columns ``forward``, and for those of ``both`` the
    first known one of the entity where none is known yet."""
    names = [*forward, *[c for c in both if c not in forward]]
    dated = df.withColumn(SEGMENT, day_segment(date, days))

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col(date))

    summary = dated.groupBy(entity, SEGMENT).agg(
        *[F.max_by(c, known(c)).alias(f"_last_{i}") for i, c in enumerate(names)],
        *[F.min_by(c, known(c)).alias(f"_first_{i}") for i, c in enumerate(names) if c in both],
    )
    in_order = Window.partitionBy(entity).orderBy(SEGMENT)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    given = summary.select(
        F.col(entity).alias("_entity"),
        F.col(SEGMENT).alias("_of"),
        *[F.last(f"_last_{i}", True).over(earlier).alias(f"_carried_{i}") for i in range(len(names))],
        *[F.first(f"_first_{i}", True).over(whole).alias(f"_known_{i}") for i, c in enumerate(names) if c in both],
    )
    same = F.col(entity).eqNullSafe(F.col("_entity")) & F.col(SEGMENT).eqNullSafe(F.col("_of"))
    so_far = Window.partitionBy(entity, SEGMENT).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {}
    for i, c in enumerate(names):
        ways = [F.last(c, True).over(so_far), F.col(f"_carried_{i}")]
        filled[c] = F.coalesce(*ways, *([F.col(f"_known_{i}")] if c in both else []))
    joined = dated.join(given, same).withColumns(filled)
    return joined.select(*df.columns)
