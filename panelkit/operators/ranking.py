"""Global order statistics without a single-task sort.

A window without ``partitionBy`` moves every row into one task. The operators here sort in
buckets and add the totals of the lower buckets as an offset:

1. the data is reduced to one row per distinct value (partial aggregation first);
2. these rows are dealt by range, so that a partition holds neighbouring values, and stored
   with the number of their partition: the bucket. Spark samples the ranges, and merges small
   partitions by their size, so the number of buckets follows the data;
3. each bucket is sorted on its own; the offsets are a table with a row per bucket.

There is one way for inputs of all sizes. ``by`` ranks several value sets held in one table,
told apart by a label column (such as the names of the columns that are ranked).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import materialise


def _direction(name: str, descending: bool) -> Column:
    return F.col(name).desc() if descending else F.col(name).asc()


def in_buckets(
    values: DataFrame, column: str, by: str | None = None, descending: bool = False
) -> DataFrame:
    """Stored rows with ``_bucket``: within a label, lower buckets hold earlier values."""
    labels = [F.col(by)] if by else []
    dealt = values.repartitionByRange(*labels, _direction(column, descending))
    return materialise(dealt.withColumn("_bucket", F.spark_partition_id()), "buckets")


def running_positions(
    values: DataFrame,
    column: str,
    weight: str | None = None,
    descending: bool = False,
    by: str | None = None,
    buckets_where: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Add ``position`` (number of earlier rows) and ``before`` (sum of their weights).

    ``values`` must hold each value of ``column`` once (per label). Null counts as the lowest
    value. A table that ``in_buckets`` has stored in the same order is used as it is.
    ``buckets_where`` gets the weight before a bucket and inside it; the rows of other buckets
    are dropped before the sort.
    """
    bucketed = values if "_bucket" in values.columns else in_buckets(values, column, by, descending)
    w = F.col(weight) if weight else F.lit(1).cast("long")
    labels = [by] if by else []
    earlier = (Window.unboundedPreceding, -1)
    # one row per bucket and label
    over_buckets = Window.partitionBy(*labels).orderBy("_bucket").rowsBetween(*earlier)
    offsets = (
        bucketed.groupBy(*labels, "_bucket")
        .agg(F.sum(w).alias("_w"), F.count(F.lit(1)).alias("_n"))
        .select(
            *labels,
            "_bucket",
            "_w",
            F.coalesce(F.sum("_w").over(over_buckets), F.lit(0)).alias("_w0"),
            F.coalesce(F.sum("_n").over(over_buckets), F.lit(0)).alias("_n0"),
        )
    )
    if buckets_where is not None:
        offsets = offsets.where(buckets_where(F.col("_w0"), F.col("_w")))
    offsets = offsets.drop("_w")
    in_bucket = (
        Window.partitionBy(*labels, "_bucket")
        .orderBy(_direction(column, descending))
        .rowsBetween(*earlier)
    )
    return (
        bucketed.join(offsets, [*labels, "_bucket"])
        .withColumns(
            {
                "position": F.col("_n0") + F.count(F.lit(1)).over(in_bucket),
                "before": F.col("_w0") + F.coalesce(F.sum(w).over(in_bucket), F.lit(0)),
            }
        )
        .drop("_bucket", "_w0", "_n0")
    )


def number_rows(df: DataFrame, key: str, out: str) -> DataFrame:
    """Consecutive ids 1, 2, ... in the order of the unique column ``key``."""
    placed = running_positions(df, key)
    return placed.withColumn(out, (F.col("position") + 1).cast("int")).drop("position", "before")


def global_ranks(
    df: DataFrame, ranks: Mapping[str, tuple[str, str]], key: str | None = None
) -> DataFrame:
    """Add descending ranks over all rows; ``ranks`` maps output -> (column, "dense" | "min").

    All columns are ranked in one table of (column, value): its distinct values are dealt by range
    once, and each row gets all of its ranks back together. Spark divides the rows of frequent
    values among tasks. ``key`` names a column that tells the rows apart and has no nulls; without
    one ``df`` is stored first, with a number for each row.
    """
    names = df.columns
    if key is None:
        key = "_row"
        df = materialise(df.withColumn(key, F.monotonically_increasing_id()), "ranked")
    by_type: dict[str, list[str]] = {}
    for column in dict.fromkeys(column for column, _ in ranks.values()):
        by_type.setdefault(df.schema[column].dataType.simpleString(), []).append(column)
    result = df
    for columns in by_type.values():  # values of one type fit into one column
        entries = df.select(
            F.col(key).alias("_of"),
            F.inline(F.array(*[F.struct(F.lit(c).alias("_label"), F.col(c).alias("_value")) for c in columns])),
        )
        counts = entries.groupBy("_label", "_value").agg(F.count(F.lit(1)).alias("_count"))
        placed = running_positions(counts, "_value", "_count", descending=True, by="_label")
        placed = placed.select(
            F.col("_label").alias("_ranked"), F.col("_value").alias("_at"), "position", "before"
        )
        same = (F.col("_label") == F.col("_ranked")) & F.col("_value").eqNullSafe(F.col("_at"))

        def rank(column: str, method: str):
            place = F.col("position" if method == "dense" else "before") + 1
            return F.max(F.when(F.col("_label") == column, place)).cast("int")

        found = entries.join(placed, same).groupBy("_of").agg(
            *[rank(c, method).alias(out) for out, (c, method) in ranks.items() if c in columns]
        )
        result = result.join(found, F.col(key) == F.col("_of")).drop("_of")
    return result.select(*names, *ranks)


def value_counts(values: DataFrame, column: str, by: str) -> DataFrame:
    """Stored table (label, value, ``_count``) of the non-null values, in buckets."""
    counts = (
        values.where(F.col(column).isNotNull())
        .groupBy(by, column)
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    return in_buckets(counts, column, by)


def exact_quantiles(
    counts: DataFrame, column: str, probabilities: Sequence[float], by: str
) -> DataFrame:
    """Linear-interpolation quantiles per label as rows (label, ``probability``, ``value``).

    Works on ``value_counts``; only the buckets that hold a wanted position are sorted. The
    totals of the labels are the only rows that the driver gets.
    """
    totals = {r[by]: r["n"] for r in counts.groupBy(by).agg(F.sum("_count").alias("n")).collect()}
    if not totals:
        return counts.select(by, F.lit(0.0).alias("probability"), F.lit(0.0).alias("value"))
    wanted = []
    for label, total in totals.items():
        for p in probabilities:
            exact = p * (total - 1)
            low = int(exact)
            wanted.append((label, float(p), low, min(low + 1, total - 1), float(exact - low)))
    # one row per label and probability
    targets = counts.sparkSession.createDataFrame(
        wanted, f"{by} string, probability double, low long, high long, fraction double"
    )
    needed = {
        label: sorted({q for w in wanted if w[0] == label for q in w[2:4]}) for label in totals
    }

    def held(start: Column, weight: Column) -> Column:
        """The needed positions among the ``weight`` positions from ``start`` on."""
        positions = F.create_map(
            *[x for k, v in needed.items() for x in (F.lit(k), F.lit(v).cast("array<long>"))]
        )[F.col(by)]
        return F.filter(positions, lambda at: (at >= start) & (at < start + weight))

    placed = running_positions(
        counts,
        column,
        "_count",
        by=by,
        buckets_where=lambda start, weight: F.size(held(start, weight)) > 0,
    )
    hits = placed.select(
        by,
        F.explode(held(F.col("before"), F.col("_count"))).alias("at"),
        F.col(column).cast("double").alias("_value"),
    )
    known = hits.groupBy(by).agg(
        F.map_from_entries(F.collect_list(F.struct("at", "_value"))).alias("_at")
    )
    low, high = F.col("_at")[F.col("low")], F.col("_at")[F.col("high")]
    return targets.join(known, by).select(
        by, "probability", (low + (high - low) * F.col("fraction")).alias("value")
    )
