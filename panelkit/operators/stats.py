"""Descriptive statistics and correlations."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import as_number, round_even
from panelkit.operators import ranking
from panelkit.operators.cleaning import present
from panelkit.session import materialise

# Columns that are described, and correlated, unless others are named.
DESCRIBED = (
    "new_cases",
    "new_deaths",
    "total_cases",
    "total_deaths",
    "case_fatality_rate",
    "cases_per_100k",
    "deaths_per_100k",
    "vaccination_rate",
    "fully_vaccinated_rate",
)
CORRELATED = (
    "cases_per_100k",
    "deaths_per_100k",
    "case_fatality_rate",
    "vaccination_rate",
    "fully_vaccinated_rate",
    "population_density",
    "median_age",
    "gdp_per_capita",
)
QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def describe_plus(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "distributed",
    accuracy: int = 10_000,
) -> DataFrame:
    """One row per numeric column: count, mean, sample deviation, quartiles, IQR, upper
    percentiles, extremes, population skewness and excess kurtosis, two decimals. Columns
    without any value are left out.

    ``method``: ``distributed`` finds exact quantiles in brackets, in two passes, for inputs of any
    size; ``exact`` and ``approx`` are one aggregate with the built-in percentiles (an exact one
    keeps every distinct value in one buffer).
    """
    if method not in ("exact", "approx", "distributed"):
        raise ValueError(f"unknown method {method!r}")
    columns = present(df, DESCRIBED) if columns is None else list(columns)
    numbers = df.select(*[as_number(c).alias(c) for c in columns])
    # one narrow row per value: each column is reduced in its own group, in parallel
    long = numbers.unpivot([], list(columns), "metric", "value").where("value is not null")
    moments = (
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std_dev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.skewness("value").alias("skewness"),
        F.kurtosis("value").alias("kurtosis"),
    )
    if method == "distributed":
        table = _describe_in_brackets(long, moments, accuracy)
    else:
        wanted = F.array(*map(F.lit, QUANTILES))
        quantiles = (
            F.percentile("value", wanted)
            if method == "exact"
            else F.percentile_approx("value", wanted, accuracy)
        )
        table = long.groupBy("metric").agg(*moments, quantiles.alias("q"))
    quantile = {p: F.col("q")[i] for i, p in enumerate(QUANTILES)}

    def r(c: Column | str) -> Column:
        return round_even(c, 2)

    return table.select(
        "metric",
        "count",
        r("mean").alias("mean"),
        r("std_dev").alias("std_dev"),
        r(quantile[0.5]).alias("median"),
        r(quantile[0.75] - quantile[0.25]).alias("iqr"),
        r("min").alias("min"),
        r(quantile[0.25]).alias("pct_25"),
        r(quantile[0.75]).alias("pct_75"),
        r(quantile[0.9]).alias("pct_90"),
        r(quantile[0.95]).alias("pct_95"),
        r(quantile[0.99]).alias("pct_99"),
        r("max").alias("max"),
        r("skewness").alias("skewness"),
        r("kurtosis").alias("kurtosis"),
    )


def _brackets(edges: Sequence[float]) -> list[float]:
    """Low and high edges of brackets, those that overlap made one, filled up with NaN."""
    merged: list[list[float]] = []
    for low, high in sorted(zip(edges[::2], edges[1::2])):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    flat = [edge for bracket in merged for edge in bracket]
    return flat + [math.nan] * (len(edges) - len(flat))


def _describe_in_brackets(long: DataFrame, moments: Sequence[Column], accuracy: int) -> DataFrame:
    """Moments and exact quantiles from two passes over rows (metric, value).

    The first pass gives the moments and, from bounded summaries, a bracket around each quantile: its
    rank is known to one part in ``accuracy``. The second counts the values between brackets, and
    each value inside one; only these are sorted (in ranges, see ``ranking``) to find the
    positions. A position just outside a bracket is the least or the largest value there.
    """
    spark, margin = long.sparkSession, 2 / accuracy
    around = [min(max(q + side, 0.0), 1.0) for q in QUANTILES for side in (-margin, margin)]
    edges = F.percentile_approx("value", F.array(*map(F.lit, around)), accuracy).alias("edges")
    rows = [r.asDict() for r in long.groupBy("metric").agg(*moments, edges).collect()]  # one per column
    measures = "count long, mean double, std_dev double, min double, max double, skewness double, kurtosis double"
    names = ["metric", *[part.split()[0] for part in measures.split(", ")]]
    table = spark.createDataFrame(
        [tuple(r[n] for n in names) for r in rows], f"metric string, {measures}"
    )
    bounds = [f"_edge_{i}" for i in range(len(around))]
    brackets = spark.createDataFrame(
        [(r["metric"], *_brackets(r["edges"])) for r in rows],
        ", ".join(["metric string", *[f"{b} double" for b in bounds]]),
    )
    value, cell = F.col("value"), F.lit(len(bounds))
    for i in reversed(range(len(bounds))):  # NaN is larger than any value
        cell = F.when(value <= F.col(bounds[i]) if i % 2 else value < F.col(bounds[i]), i).otherwise(cell)
    inside = F.col("_cell") % 2 == 1
    counts = (
        long.join(F.broadcast(brackets), "metric")  # one row per column
        .select("metric", "value", cell.alias("_cell"))
        .groupBy("metric", "_cell", F.when(inside, value).alias("_inside"))
        .agg(F.count(F.lit(1)).alias("_count"), F.min(value).alias("_least"), F.max(value).alias("_most"))
    )
    placed = ranking.running_positions(counts, "_least", "_count", by="metric")
    wanted = []
    for r in rows:
        for q in QUANTILES:
            exact = q * (r["count"] - 1)
            low = int(exact)
            wanted.append((r["metric"], q, low, min(low + 1, r["count"] - 1), exact - low))
    targets = spark.createDataFrame(wanted, "metric string, probability double, low long, high long, part double")

    def at(position: str) -> Column:
        here = (F.col(position) >= F.col("before")) & (F.col(position) < F.col("before") + F.col("_count"))
        found = F.when(F.col(position) == F.col("before"), F.col("_least")).otherwise(F.col("_most"))
        return F.max(F.when(here, found))

    low, high = at("low"), at("high")
    near = (F.col("high") >= F.col("before")) & (F.col("low") < F.col("before") + F.col("_count"))
    quantiles = (
        placed.join(F.broadcast(targets), "metric")  # one row per column and quantile
        .where(near)
        .groupBy("metric", "probability")
        .agg((low + (high - low) * F.first("part")).alias("_quantile"))
    )
    in_order = F.sort_array(F.collect_list(F.struct("probability", "_quantile")))
    return table.join(quantiles.groupBy("metric").agg(in_order["_quantile"].alias("q")), "metric")


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _both(x: str, y: str) -> str:
    return f"({_quoted(x)} IS NOT NULL AND {_quoted(y)} IS NOT NULL)"


def _pairs_to_matrix(one_row: DataFrame, columns: Sequence[str], digits: int) -> DataFrame:
    """Rows (x, y, r) for the whole matrix from a row with one column ``r_i_j`` per pair."""
    places = range(len(columns))
    cells = ", ".join(
        f"named_struct('i', {i}, 'j', {j}, 'r', r_{min(i, j)}_{max(i, j)})"
        for i in places
        for j in places
    )
    names = F.array(*map(F.lit, columns))
    clipped = F.greatest(F.least(F.col("r"), F.lit(1.0)), F.lit(-1.0))
    return one_row.selectExpr(f"inline(array({cells}))").select(
        names[F.col("i")].alias("x"),
        names[F.col("j")].alias("y"),
        F.when(F.col("r").isNotNull(), round_even(clipped, digits)).alias("r"),
    )


def corr_pearson(
    df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4
) -> DataFrame:
    """Correlation matrix as rows (x, y, r) over the rows where both sides are present.

    One aggregate for all pairs. ``r`` is null for a constant side (the built-in ``corr`` would
    raise there).
    """
    columns = present(df, CORRELATED) if columns is None else list(columns)
    numbers = df.select(*[as_number(c).alias(c) for c in columns])

    def pair(x: str, y: str) -> str:
        both = _both(x, y)
        spread_x = f"stddev_pop(CASE WHEN {both} THEN {_quoted(x)} END)"
        spread_y = f"stddev_pop(CASE WHEN {both} THEN {_quoted(y)} END)"
        return f"try_divide(covar_pop({_quoted(x)}, {_quoted(y)}), {spread_x} * {spread_y})"

    pairs = combinations_with_replacement(range(len(columns)), 2)
    wanted = [F.expr(f"{pair(columns[i], columns[j])} AS r_{i}_{j}") for i, j in pairs]
    return _pairs_to_matrix(numbers.agg(*wanted), columns, digits)


def corr_matrix(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Wide form of a correlation result: one row and one column per input column."""
    return long.groupBy("x").pivot("y", list(columns)).agg(F.first("r"))


def corr_spearman(
    df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4
) -> DataFrame:
    """Rank correlation matrix as rows (x, y, r): average ranks, taken per pair over the rows
    where both sides are present.

    Equal rows are first combined with a weight. A column needs one ranking, plus one more for
    each partner that is missing in rows where the column is present. The values of all rankings
    form one long table: it is counted, ranked (``ranking``), joined with its ranks and brought
    back to rows once, whatever the number of columns. Ranks are centred before the sums so that
    large ranks keep precision.
    """
    columns = present(df, CORRELATED) if columns is None else list(columns)
    numbers = df.select(*[as_number(c).alias(c) for c in columns])
    rows = numbers.groupBy(*columns).agg(F.count(F.lit(1)).alias("_weight"))
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "weighted-rows")
    pairs = list(combinations_with_replacement(range(len(columns)), 2))

    def both(i: int, j: int) -> str:
        return _both(columns[i], columns[j])

    # one row of numbers of rows per pair
    sizes = rows.agg(
        *[
            F.expr(f"coalesce(sum(CASE WHEN {both(i, j)} THEN _weight END), 0) AS n_{i}_{j}")
            for i, j in pairs
        ],
    ).first()

    def size(i: int, j: int) -> int:
        return sizes[f"n_{min(i, j)}_{max(i, j)}"]

    def rank_name(i: int, j: int) -> str:
        """Ranking of column i for a pair with column j."""
        return f"_rank_{i}" if size(i, j) == size(i, i) else f"_rank_{i}_{j}"

    masks = {
        rank_name(i, j): (columns[i], F.expr(both(i, j)))
        for a, b in pairs
        for i, j in ((a, b), (b, a))
    }
    ranked = _average_ranks(rows, masks)

    def pair(i: int, j: int) -> str:
        middle = (size(i, j) + 1) / 2
        x, y = f"({rank_name(i, j)} - {middle!r}D)", f"({rank_name(j, i)} - {middle!r}D)"

        def total(product: str) -> str:
            return f"sum(_weight * {product})"  # null where a side has no rank

        def over_both(z: str) -> str:
            return f"sum(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN _weight * {z} * {z} END)"

        spread = f"sqrt({over_both(x)}) * sqrt({over_both(y)})"
        return f"try_divide({total(f'{x} * {y}')}, {spread})"

    wanted = [F.expr(f"{pair(i, j)} AS r_{i}_{j}") for i, j in pairs]
    return _pairs_to_matrix(ranked.agg(*wanted), columns, digits)


def _average_ranks(rows: DataFrame, masks: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """``_weight`` and a column per ranking: its average rank, null outside its mask."""
    entries = [
        F.struct(F.lit(name).alias("_ranking"), F.when(mask, F.col(column)).alias("_value"))
        for name, (column, mask) in masks.items()
    ]
    long = rows.select("_row", "_weight", F.inline(F.array(*entries))).where("_value is not null")
    counts = long.groupBy("_ranking", "_value").agg(F.sum("_weight").alias("_n"))
    ranks = ranking.running_positions(counts, "_value", "_n", by="_ranking").select(
        "_ranking", "_value", (F.col("before") + (F.col("_n") + 1) / 2).alias("_rank")
    )
    return (
        long.join(ranks, ["_ranking", "_value"])
        .groupBy("_row")
        .agg(
            F.max("_weight").alias("_weight"),
            *[F.max(F.when(F.col("_ranking") == n, F.col("_rank"))).alias(n) for n in masks],
        )
    )
