"""Properties: brute-force agreement, and the same result for any partitioning."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelkit.operators import cleaning, features, quality, ranking, series, stats
from tests.support import canonical

DAY = dt.date(2020, 1, 1)


def random_panel(spark, seed=1, entities=5, days=60):
    rng = random.Random(seed)
    rows = [
        (
            f"e{e}",
            DAY + dt.timedelta(days=d),
            float(rng.randint(0, 9)) if rng.random() > 0.2 else None,
            float(rng.randint(0, 99)) if rng.random() > 0.2 else None,
        )
        for e in range(entities)
        for d in range(days)
        if rng.random() > 0.1
    ]
    return spark.createDataFrame(
        rows, "country string, date date, new_cases double, total_cases double"
    )


# --- peaks -----------------------------------------------------------------------------


def slow_peaks(values, distance, factor):
    """The definition, step by step."""
    n, tops, i = len(values), [], 1
    if n < distance:
        return []
    while i < n - 1:
        j = i
        while j + 1 < n and values[j + 1] == values[i]:
            j += 1
        if j < n - 1 and values[i - 1] < values[i] > values[j + 1]:
            tops.append((i + j) // 2)
        i = j + 1
    kept = []
    for p in sorted(tops, key=lambda p: (-values[p], -p)):
        if all(abs(p - k) >= distance for k in kept):
            kept.append(p)
    found = []
    for p in sorted(kept):
        low = p
        while low > 0 and values[low - 1] <= values[p]:
            low -= 1
        high = p
        while high < n - 1 and values[high + 1] <= values[p]:
            high += 1
        height = values[p] - max(min(values[low : p + 1]), min(values[p : high + 1]))
        if height >= factor * max(values):
            found.append((p, height))
    return found


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.integers(0, 6), min_size=0, max_size=60),
    st.integers(1, 12),
    st.sampled_from([0.0, 0.2, 0.5, 1.0]),
)
def test_waves_follow_the_definition(values, distance, factor):
    array = np.array(values, dtype=float)
    assert series.find_waves(array, distance, factor) == slow_peaks(values, distance, factor)


def test_flat_top_counts_once():
    assert list(series.local_maxima(np.array([1.0, 3, 3, 1]))) == [1]
    assert list(series.local_maxima(np.array([3.0, 3, 1, 3, 3]))) == []


def test_peaks_per_entity(spark):
    rows = [(e, DAY + dt.timedelta(days=i), v) for e, vs in
            {"a": [0, 5, 0, 9, 0], "b": [1, 1, 1, 1, 1], "c": [0, 2]}.items()
            for i, v in enumerate(map(float, vs))]
    df = spark.createDataFrame(rows, "country string, date date, v double")
    found = series.detect_peaks(df, "v", "country", distance=3, prominence_factor=0.1).collect()
    assert [(r["country"], r["wave_number"], r["peak_value"]) for r in found] == [("a", 1, 9.0)]
    assert found[0]["peak_date"] == DAY + dt.timedelta(days=3)


# --- order statistics ------------------------------------------------------------------


def long_tail(spark, n=4000, seed=3):
    """A third of all rows hold one value, the rest are spread out."""
    rng = random.Random(seed)
    rows = [(i, 7.0 if i % 3 == 0 else round(rng.gauss(0, 50), 2)) for i in range(n)]
    return spark.createDataFrame(rows + [(n, None)], "i int, v double").repartition(6)


@pytest.fixture(params=["true", "false"], ids=["merged", "many"])
def buckets(spark, request):
    """Small partitions merged into one bucket, or left as they are."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


def test_ranks_do_not_depend_on_the_buckets(spark, buckets):
    ranks = {"dense": ("v", "dense"), "least": ("v", "min")}
    ranked = ranking.global_ranks(long_tail(spark), ranks).toPandas()
    expected_dense = ranked["v"].rank(method="dense", ascending=False, na_option="bottom")
    expected_least = ranked["v"].rank(method="min", ascending=False, na_option="bottom")
    assert (ranked["dense"] == expected_dense).all() and (ranked["least"] == expected_least).all()


def test_quantiles_are_exact(spark, buckets):
    df = long_tail(spark).select(F.lit("m").alias("metric"), "v")
    counts = ranking.value_counts(df, "v", "metric")
    got = ranking.exact_quantiles(counts, "v", [0, 0.01, 0.25, 0.5, 0.9, 0.999, 1], "metric")
    data = df.toPandas()["v"].dropna()
    for row in got.collect():
        assert row["value"] == pytest.approx(data.quantile(row["probability"]), abs=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([("m", None)], "metric string, v double")
    counts = ranking.value_counts(empty, "v", "metric")
    assert ranking.exact_quantiles(counts, "v", [0.5], "metric").count() == 0
    assert stats.describe_plus(empty, ["v"], method="distributed").count() == 0


def test_row_numbers_are_consecutive_and_ordered(spark, buckets):
    names = [f"name {i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(n,) for n in names], ["name"]).repartition(5)
    got = ranking.number_rows(df, "name", "id").orderBy("name").collect()
    assert [r["id"] for r in got] == list(range(1, 3001))


def test_positions_of_other_types(spark, buckets):
    dates = spark.range(3000).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("d"))
    placed = ranking.running_positions(dates, "d").collect()
    assert all((r["d"] - DAY).days == r["position"] for r in placed)


def test_rank_correlation_equals_brute_force(spark, buckets):
    rng = random.Random(5)
    rows = [
        (
            float(rng.randint(0, 5)) if rng.random() > 0.2 else None,
            rng.gauss(0, 1) if rng.random() > 0.1 else None,
            float(i % 3 == 0),
        )
        for i in range(1000)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    got = {(r["x"], r["y"]): r["r"] for r in
           stats.corr_spearman(df, ["a", "b", "c"]).collect()}
    data = df.toPandas()
    for x in "abc":
        for y in "abc":
            pair = data[[x, y]].dropna() if x != y else data[[x]].dropna()
            expected = np.corrcoef(pair[x].rank(), pair[y].rank())[0, 1]
            assert got[x, y] == pytest.approx(expected, abs=1e-4)


def test_a_hot_value_in_a_rank_correlation(spark, buckets):
    df = long_tail(spark).select("v", F.col("i").cast("double").alias("i"))
    got = {(r["x"], r["y"]): r["r"] for r in stats.corr_spearman(df, ["v", "i"]).collect()}
    pair = df.toPandas().dropna()
    expected = np.corrcoef(pair["v"].rank(), pair["i"].rank())[0, 1]
    assert got["v", "i"] == pytest.approx(expected, abs=1e-4)


@pytest.mark.parametrize("method", ["exact", "distributed"])
def test_describe_methods_agree(spark, method, buckets):
    extra = {"empty": F.lit(None).cast("double"), "constant": F.lit(2.0)}
    df, columns = long_tail(spark).withColumns(extra), ["v", "empty", "constant"]
    got = stats.describe_plus(df, columns, method=method)
    reference = stats.describe_plus(df, columns, method="exact")
    assert canonical(got.toPandas()) == canonical(reference.toPandas())
    assert got.count() == 2, "columns without values are left out"


# --- panel operators -------------------------------------------------------------------


def test_window_of_one_is_the_input(spark):
    df = random_panel(spark)
    rolled = features.rolling_mean(df, targets=["new_cases"], windows=[1])
    assert rolled.where("not (new_cases <=> `1_day_cases_avg`)").count() == 0


def test_dedupe_is_idempotent(spark):
    df = random_panel(spark).union(random_panel(spark, seed=2))
    once = cleaning.dedupe_keep(df, ["country", "date"], ["total_cases"])
    twice = cleaning.dedupe_keep(once, ["country", "date"], ["total_cases"])
    assert canonical(once.toPandas()) == canonical(twice.toPandas())
    assert quality.duplicate_keys(once, ["country", "date"]).first()["surplus"] == 0


def test_exact_duplicates_count_copies(spark):
    rows = [("x" * 50, 1), ("x" * 50, 1), ("x" * 50, None), (None, None), (None, None), ("y", 1)]
    df = spark.createDataFrame(rows, "t string, n int").repartition(3)
    assert quality.exact_duplicates(df).first()["surplus"] == 2
    assert quality.exact_duplicates(df.limit(0)).first()["surplus"] == 0


@pytest.mark.parametrize("shuffles", [1, 3, 17])
def test_partitioning_does_not_matter(spark, shuffles):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = random_panel(spark)

    def result(frame):
        filled = cleaning.impute_panel(frame)
        return canonical(features.feature_panel(filled).toPandas())

    expected = result(df)
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    try:
        assert result(df.repartition(shuffles + 2)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
