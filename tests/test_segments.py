"""Windows in segments give what plain windows give, and spread a large entity over tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelkit.operators import cleaning, features, segments
from tests.support import canonical


@pytest.fixture(scope="module")
def panel(spark):
    """One entity with most rows, one with gaps of years, one short, one without a name."""
    day = F.col("id").cast("int")
    large = spark.range(3_000).select(F.lit("large").alias("country"), day.alias("day"))
    gaps = spark.range(60).select(F.lit("gaps").alias("country"), (day * 97).alias("day"))
    short = spark.range(3).select(F.lit("short").alias("country"), day.alias("day"))
    nameless = spark.range(40).select(F.lit(None).cast("string").alias("country"), (day * 2).alias("day"))
    rows = large.union(gaps).union(short).union(nameless)
    number = F.pmod(F.xxhash64("country", "day"), F.lit(100)).cast("double")
    known = F.pmod(F.xxhash64("day", "country"), F.lit(9)) < 4
    late = known & (F.col("day") > 500)
    return rows.select(
        "country",
        F.date_add(F.lit("2001-01-01").cast("date"), F.col("day")).alias("date"),
        F.when(known, number).alias("new_cases"),
        F.when(known, number + 1).alias("total_cases"),
        F.when(late, number + 2).alias("population"),
    ).repartition(7)


@pytest.mark.parametrize("segment", [30, 365, 10_000])
def test_segments_change_nothing(panel, segment):
    plain = cleaning.impute_panel(panel)
    filled = cleaning.impute_panel(panel, segment_days=segment)
    assert filled.columns == plain.columns
    assert canonical(filled.toPandas()) == canonical(plain.toPandas())
    for by in ("rows", "days"):
        means = features.rolling_mean(panel, by=by, segment=segment)
        assert canonical(means.toPandas()) == canonical(features.rolling_mean(panel, by=by).toPandas())
    grown = features.growth_rates(panel, metric="new_cases", segment=segment)
    assert canonical(grown.toPandas()) == canonical(features.growth_rates(panel, metric="new_cases").toPandas())


def test_segments_bound_what_a_task_holds(panel):
    for by, length in (("rows", 100), ("days", 100)):
        spread = segments.with_context(panel, "country", "date", length, 29, by)
        sizes = spread.groupBy("country", "_segment").count().agg(F.max("count")).first()[0]
        assert sizes <= length + 29
        assert spread.where("NOT _context").count() == panel.count()
    with pytest.raises(ValueError):
        segments.with_context(panel, "country", "date", 10, 29)


def test_feature_panel_in_segments(panel):
    plain = features.feature_panel(panel)
    assert canonical(features.feature_panel(panel, segment=200).toPandas()) == canonical(plain.toPandas())
