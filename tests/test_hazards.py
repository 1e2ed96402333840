"""One test per point where engines differ: order, nulls, rounding, division, ties."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelkit.functions import (
    as_number,
    coverage_pct,
    parse_date,
    per_capita,
    ratio,
    ratio_pct,
    round_even,
    round_half_up,
)
from panelkit.operators import charts, cleaning, explore, features, latest, quality, stats
from panelkit.plans import model, suite
from panelkit.plans.model import Model


def values(df, name="v", order="i"):
    return [r[name] for r in df.orderBy(order).collect()]


def panel(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_which_duplicate_is_last_needs_an_order(spark):
    df = panel(spark, [("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="order_by"):
        cleaning.dedupe_keep(df, ["k"])
    parts = panel(
        spark,
        [("United Kingdom", 500.0, 0), ("England", 300.0, 1), ("Wales", 40.0, 2)],
        "location string, new_cases double, seq int",
    )
    with_parts = cleaning.canonicalise_entity(parts)
    kept = cleaning.dedupe_keep(with_parts, ["location"], ["seq"])
    assert values(kept, "new_cases", "location") == [40.0]
    without = cleaning.canonicalise_entity(parts, include_parts=False)
    assert without.select("location").distinct().count() == 3


def test_equal_order_is_broken_by_the_other_columns(spark):
    rows = [("a", 1, x) for x in (3, 1, 2)]
    for parts in (1, 3, 7):
        df = panel(spark, rows, "k string, o int, v int").repartition(parts)
        assert cleaning.dedupe_keep(df, ["k"], ["o"]).first()["v"] == 3


def test_fill_stays_inside_the_entity(spark):
    rows = [
        ("a", 1, None, None),
        ("a", 2, 1.0, None),
        ("b", 1, None, None),
        ("c", 1, None, 7.0),
        ("c", 2, None, None),
    ]
    df = panel(spark, rows, "country string, date int, population double, median_age double")
    got = {(r["country"], r["date"]): r for r in cleaning.impute_panel(df).collect()}
    assert got["a", 1]["population"] == 1.0
    assert got["b", 1]["population"] is None and got["c", 1]["population"] is None
    assert got["a", 1]["median_age"] is None and got["c", 2]["median_age"] == 7.0


def test_missing_names_stay_missing(spark):
    df = panel(spark, [(None,), (" UK",)], "location string")
    assert sorted(map(str, values(cleaning.canonicalise_entity(df), "location", "location"))) == [
        "None",
        "United Kingdom",
    ]
    kept = cleaning.drop_aggregate_entities(
        panel(spark, [(None,), ("World",), ("Chad",)], "country string")
    )
    assert {r["country"] for r in kept.collect()} == {None, "Chad"}


def test_date_formats(spark):
    texts = ["01/02/2021", "20210101", "May 5, 2021", "2021-3-4", " 2021/06/07 ", "13/13/2021", "", None]
    df = panel(spark, list(enumerate(texts)), "i int, t string")
    assert values(df.select("i", parse_date("t").alias("v"))) == [
        dt.date(2021, 1, 2),
        dt.date(2021, 1, 1),
        dt.date(2021, 5, 5),
        dt.date(2021, 3, 4),
        dt.date(2021, 6, 7),
        None,
        None,
        None,
    ]


def test_other_date_formats(spark):
    df = panel(spark, [(1, "3.4.2021"), (2, "2021-04-03")], "i int, t string")
    parsed = df.select("i", parse_date("t", ["d.M.yyyy"]).alias("v"))
    assert values(parsed) == [dt.date(2021, 4, 3), None]


def test_null_date_counts_as_missing_and_as_unparseable(spark):
    df = panel(spark, [("a", None), ("a", "bad"), ("b", "2021-01-01")], "country string, date string")
    summary = quality.quality_report(df, min_entities=1).summary.first()
    assert summary["invalid_records"] == 1 + 2
    assert summary["min_date"] == dt.date(2021, 1, 1)


def test_zero_denominators_never_raise(spark):
    df = panel(
        spark,
        [(1, 5.0, 0.0), (2, 5.0, None), (3, 0.0, 0.0), (4, None, None), (5, 5.0, -1.0)],
        "i int, a double, b double",
    )
    for expression in (ratio_pct("a", "b"), per_capita("a", "b"), coverage_pct("a", "b")):
        assert values(df.select("i", expression.alias("v"))) == [0.0] * 5
    assert values(df.select("i", ratio(F.col("a"), F.col("b")).alias("v")))[:4] == [None] * 4
    growth = panel(
        spark, [("x", i, v) for i, v in enumerate([0.0, 5.0, None, 5.0, 10.0])],
        "country string, date int, new_cases double",
    )
    assert values(features.growth_rates(growth), "daily_growth_rate", "date") == [0, 0, 0, 0, 100.0]


def test_rounding_rules(spark):
    df = panel(spark, [(1, 0.125), (2, 0.375), (3, -0.125), (4, 2.5)], "i int, x double")
    assert values(df.select("i", round_even("x", 2).alias("v"))) == [0.12, 0.38, -0.12, 2.5]
    assert values(df.select("i", round_half_up("x", 2).alias("v"))) == [0.13, 0.38, -0.13, 2.5]


def test_nan_becomes_null(spark):
    df = panel(spark, [(1, math.nan), (2, 1.0), (3, None)], "i int, x double")
    assert values(df.select("i", as_number("x").alias("v"))) == [None, 1.0, None]
    described = stats.describe_plus(df, ["x"]).first()
    assert described["count"] == 1 and described["max"] == 1.0


def test_coverage_is_clipped(spark):
    df = panel(spark, [(1, 120.0, 100.0), (2, -5.0, 100.0)], "i int, a double, b double")
    assert values(df.select("i", coverage_pct("a", "b").alias("v"))) == [100.0, 0.0]


def test_windows_count_rows_or_days(spark):
    days = [dt.date(2021, 1, d) for d in (1, 2, 10)]
    df = panel(
        spark, [("a", d, float(i)) for i, d in enumerate(days)],
        "country string, date date, new_cases double",
    )
    by_rows = features.rolling_mean(df, targets=["new_cases"], windows=[2])
    by_days = features.rolling_mean(df, targets=["new_cases"], windows=[2], by="days")
    assert values(by_rows, "2_day_cases_avg", "date") == [0.0, 0.5, 1.5]
    assert values(by_days, "2_day_cases_avg", "date") == [0.0, 0.5, 2.0]


def test_null_sort_keys_come_last_and_ties_go_by_name(spark):
    rows = [("d", 1.0), ("a", None), ("c", 2.0), ("b", 2.0)]
    df = panel(spark, rows, "country string, v double")
    for parts in (1, 4):
        got = latest.top_k(df.repartition(parts), "v", 3, ["country"]).collect()
        assert [r["country"] for r in got] == ["b", "c", "d"]


def test_heatmap_holds_only_the_top_entities(spark):
    rows = [(c, dt.date(2021, m, 1), 1e6 * m, 10.0 * n) for n, c in enumerate("abc", 1) for m in (1, 2) if (c, m) != ("c", 2)]
    df = panel(spark, rows, "country string, date date, new_cases double, total_cases double")
    long = charts.heatmap_rows(charts.month_heatmap(df, n=2))
    assert {(r["country"], r["month"]): r["millions"] for r in long.collect()} == {
        ("b", "2021-01"): 1.0,
        ("b", "2021-02"): 2.0,
        ("c", "2021-01"): 1.0,
        ("c", "2021-02"): 0.0,
    }


def test_skewness_is_the_population_form(spark):
    df = panel(spark, [(float(x),) for x in (1, 2, 3, 10)], "x double")
    assert stats.describe_plus(df, ["x"]).first()["skewness"] == 1.02


def test_constant_column_has_no_correlation(spark):
    df = panel(spark, [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    for operator in (stats.corr_pearson, stats.corr_spearman):
        got = {(r["x"], r["y"]): r["r"] for r in operator(df, ["x", "y"]).collect()}
        assert got["x", "x"] == 1.0 and got["x", "y"] is None and got["y", "y"] is None


def test_last_known_takes_each_column_from_its_own_row(spark):
    df = panel(
        spark,
        [("a", 1, 5.0, 1.0), ("a", 2, None, 2.0), ("a", 3, 7.0, None), ("b", 1, None, 4.0)],
        "country string, date int, total_cases double, total_deaths double",
    )
    got = {r["country"]: r for r in explore.latest_per_entity(df).collect()}
    assert (got["a"]["total_cases"], got["a"]["total_deaths"]) == (7.0, 2.0)
    assert (got["b"]["total_cases"], got["b"]["total_deaths"]) == (None, 4.0)


def features_rows(spark):
    rows = [
        ("B", "X", dt.date(2021, 1, d), 1.0 * d, float(d), 3e6, 60.0 + d) for d in (1, 2, 3)
    ] + [("A", None, dt.date(2021, 1, d), 2.0 * d, 2.0 * d, -1.0, None) for d in (1, 2)]
    return panel(
        spark,
        rows,
        "country string, region string, date date, new_cases double, total_cases double, "
        "population double, people_fully_vaccinated double",
    ).withColumn("total_deaths", F.lit(0.0)).withColumn("7_day_cases_avg", F.col("new_cases"))


def test_model_of_a_panel_with_holes(spark):
    m = model.build_all(features_rows(spark), {"project_name": "tests"})
    countries = {r["country_name"]: r for r in m.countries.collect()}
    assert countries["A"]["country_id"] == 1 and countries["B"]["country_id"] == 2
    assert countries["A"]["population"] is None and countries["A"]["region_id"] is None
    assert countries["B"]["population"] == 3_000_000
    daily = m.daily.orderBy("record_id").collect()
    assert [r["country_id"] for r in daily] == [1, 1, 2, 2, 2]
    assert [r["date"] for r in daily[2:]] == sorted(r["date"] for r in daily[2:])
    assert daily[0]["record_id"] == model.DAYS + (daily[0]["date"] - dt.date(1, 1, 1)).days
    assert daily[4]["rolling_7day_cases"] == 3.0, "rolling means are loaded, not zero"
    vaccination = m.vaccination.orderBy("record_id").collect()
    assert vaccination[0]["people_fully_vaccinated"] is None, "unknown stays unknown"
    assert vaccination[0]["new_vaccinations"] == 0.0, "an absent column is 0"
    assert m.metadata.first()["project_name"] == "tests"
    assert {r["table"]: r["rows"] for r in m.counts().collect()}["daily"] == 5
    regions = {r["region"]: r["countries_count"] for r in suite.completeness(m).collect()}
    assert regions == {"X": 1, "Unknown": 1}
    assert {r["region"] for r in suite.region_rank(m).collect()} == {"X", "Unassigned"}
    assert [r["region_name"] for r in suite.region_stress(m).collect()] == ["X"]
    assert suite.vaccination_tiers(m).collect()[0]["vaccination_tier"] == "Low Vax (<40%)"


def test_model_without_regions(spark):
    m = model.build_all(features_rows(spark).drop("region"))
    assert [r["region_name"] for r in m.regions.collect()] == ["Global"]
    assert {r["region_id"] for r in m.countries.collect()} == {1}


def test_orphans_and_duplicates_are_found(spark):
    m = model.build_all(features_rows(spark))
    broken = Model(m.regions, m.countries.where("country_id = 1"), m.population_stats, m.daily.union(m.daily), m.vaccination)
    assert suite.orphans(broken).count() == 6
    assert suite.duplicate_keys(broken).count() == 5
    assert suite.duplicate_keys(m).count() == 0


def test_rows_without_a_key_form_no_group(spark):
    df = features_rows(spark).withColumn("people_vaccinated", F.lit(0.0))
    nameless = df.withColumn("country", F.lit(None).cast("string")).withColumn(
        "date", F.lit(None).cast("date")
    )
    both = df.union(nameless)
    for chart in (charts.top_entities, charts.daily_total, charts.monthly_total):
        assert chart(both).count() == chart(df).count()
    assert explore.latest_per_entity(both).count() == 2
    assert explore.kpis(explore.latest_per_entity(both)).first()["entities"] == 2


def test_dates_with_time_month_names_and_blanks(spark):
    texts = [
        "2021-01-02 00:00:00", "2021-01-02T10:00:00Z", "2021-1-2T10:00+02:00", "January 2, 2021",
        "2 Jan 2021", "2 January 2021", "\t2021-01-02\t", "2021-01-02 25:00:00", "2021-01-02x",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r["v"] for r in rows.select("i", parse_date("t").alias("v")).orderBy("i").collect()]
    assert [str(d) for d in got] == ["2021-01-02"] * 7 + ["None"] * 2


def test_only_decimal_text_is_a_number(spark):
    from panelkit.operators import cleaning

    texts = ["1d", "1.5f", "inf", "NaN", "", "1e3", " -2.5\t", ".5", "7."]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, new_x string")
    got = cleaning.coerce_numeric(rows, ["new_x"], "keep").orderBy("i").collect()
    assert [r["new_x"] for r in got] == [None] * 5 + [1000.0, -2.5, 0.5, 7.0]
