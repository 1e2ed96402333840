"""Small literal cases, one per behaviour."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelkit.functions import coverage_pct, per_capita, ratio_pct
from panelkit.operators import cleaning, features, quality


def column(df, name, order=None):
    return [r[name] for r in (df.orderBy(order) if order else df).collect()]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Country/Region", "New-Cases", " Total Deaths "])
    assert cleaning.snake_case_columns(df).columns == [
        "country_region",
        "new_cases",
        "total_deaths",
    ]


def test_column_name_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["New Cases", "new-cases"])
    with pytest.raises(ValueError, match="new_cases"):
        cleaning.snake_case_columns(df)


def test_aliases_and_white_space(spark):
    raw = ["US", "USA", "UK", "Great Britain", "Czechia", "South Korea", " France ", "\tFrance\n"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, location string")
    assert column(cleaning.canonicalise_entity(df), "location", "i") == [
        "United States",
        "United States",
        "United Kingdom",
        "United Kingdom",
        "Czech Republic",
        "South Korea",
        "France",
        "France",
    ]


def test_dates(spark):
    df = spark.createDataFrame(
        [("2021-01-01",), ("2021/05/15",), ("invalid_date",), ("2022-12-31",)], ["date"]
    )
    assert column(cleaning.parse_dates(df), "date", "date") == [
        dt.date(2021, 1, 1),
        dt.date(2021, 5, 15),
        dt.date(2022, 12, 31),
    ]
    assert cleaning.parse_dates(df, drop_invalid=False).count() == 4
    with pytest.raises(KeyError):
        cleaning.parse_dates(df, "day")


def test_keep_last(spark):
    df = spark.createDataFrame(
        [("India", "2021-01-01", 100, 0), ("India", "2021-01-01", 150, 1), ("India", "2021-01-02", 200, 2)],
        "location string, date string, new_cases int, seq int",
    )
    kept = cleaning.dedupe_keep(df, ["location", "date"], ["seq"])
    assert column(kept, "new_cases", "date") == [150, 200]
    first = cleaning.dedupe_keep(df, ["location", "date"], ["seq"], keep="first")
    assert column(first, "new_cases", "date") == [100, 200]


def test_negatives(spark):
    df = spark.createDataFrame(
        [(1, 100.0, -5.0), (2, -25.0, 10.0), (3, 50.0, 0.0)], ["i", "new_cases", "new_deaths"]
    )
    zero = cleaning.coerce_numeric(df)
    assert column(zero, "new_cases", "i") == [100.0, 0.0, 50.0]
    assert column(zero, "new_deaths", "i") == [0.0, 10.0, 0.0]
    assert column(cleaning.coerce_numeric(df, negatives="abs"), "new_cases", "i")[1] == 25.0
    assert column(cleaning.coerce_numeric(df, negatives="keep"), "new_cases", "i")[1] == -25.0


def test_attributes_are_coerced_but_not_clamped(spark):
    df = spark.createDataFrame([("-3", "x")], ["median_age", "population"])
    row = cleaning.coerce_numeric(df).first()
    assert row["median_age"] == -3.0 and row["population"] is None


def test_fill(spark):
    df = spark.createDataFrame(
        [
            ("Brazil", "2020-01-01", 10.0, 10.0),
            ("Brazil", "2020-01-02", None, None),
            ("Brazil", "2020-01-03", 30.0, 20.0),
        ],
        "location string, date string, total_cases double, new_cases double",
    )
    filled = cleaning.impute_panel(df)
    assert column(filled, "total_cases", "date") == [10.0, 10.0, 30.0]
    assert column(filled, "new_cases", "date") == [10.0, 0.0, 20.0]


def test_ratio(spark):
    df = spark.createDataFrame(
        [(1, 20.0, 1000.0), (2, 0.0, 0.0), (3, 50.0, 1000.0), (4, None, 500.0), (5, 10.0, 0.0), (6, None, 100.0)],
        "i int, deaths double, cases double",
    )
    rate = df.select("i", ratio_pct("deaths", "cases").alias("r"))
    assert column(rate, "r", "i") == [2.0, 0.0, 5.0, 0.0, 0.0, 0.0]


def test_per_capita_and_coverage(spark):
    df = spark.createDataFrame([(1, 5000, 10_000_000), (2, 0, 0)], "i int, n long, pop long")
    assert column(df.select("i", per_capita("n", "pop").alias("r")), "r", "i") == [50.0, 0.0]
    vaccinated = spark.createDataFrame([(1, 7_000_000, 10_000_000), (2, 0, 0)], "i int, n long, pop long")
    assert column(vaccinated.select("i", coverage_pct("n", "pop").alias("r")), "r", "i") == [70.0, 0.0]


def test_rolling_mean(spark):
    df = spark.createDataFrame(
        [("Germany", f"2021-01-0{i}", 10.0 * i) for i in range(1, 8)], ["country", "date", "new_cases"]
    )
    rolled = features.rolling_mean(df, targets=["new_cases"], windows=[7])
    assert column(rolled, "7_day_cases_avg", "date")[-1] == 40.0
    assert column(rolled, "7_day_cases_avg", "date")[:2] == [10.0, 15.0]
    assert features.rolling_name("total_cases", 7) == "7_day_total_cases_avg"


def test_growth(spark):
    df = spark.createDataFrame(
        [("Canada", "2021-01-01", 100.0), ("Canada", "2021-01-02", 150.0)],
        ["country", "date", "7_day_cases_avg"],
    )
    assert column(features.growth_rates(df), "daily_growth_rate", "date") == [0.0, 50.0]
    other = df.withColumnRenamed("7_day_cases_avg", "unrelated")
    assert features.growth_rates(other).columns == other.columns


def full_rows(n):
    return [(f"Country_{i}", "2021-01-01", 10.0, 1.0, 100.0, 5.0, 1_000_000) for i in range(n)]


NAMES = ["country", "date", "new_cases", "new_deaths", "total_cases", "total_deaths", "population"]


def test_gates_pass(spark):
    report = quality.quality_report(spark.createDataFrame(full_rows(160), NAMES), min_entities=150)
    summary = report.summary.first()
    assert summary["overall_status"] == "PASS"
    assert (summary["total_records"], summary["distinct_entities"]) == (160, 160)
    assert summary["duplicate_keys"] == 0
    assert {r["status"] for r in report.checks.collect()} == {"PASS"}
    assert {r["health"] for r in report.column_nulls.collect()} == {"Excellent"}


def test_gates_duplicate(spark):
    df = spark.createDataFrame(
        [("India", "2021-01-01", 100.0, 2.0), ("India", "2021-01-01", 100.0, 2.0)], NAMES[:4]
    )
    summary = quality.quality_report(df, min_entities=1).summary.first()
    assert summary["duplicate_keys"] == 1 and summary["duplicate_records"] == 1
    assert summary["overall_status"] == "FAIL"


def test_gates_negative(spark):
    df = spark.createDataFrame([("USA", "2021-01-01", -50.0, 0.0)], NAMES[:4])
    report = quality.quality_report(df, min_entities=1)
    status = {r["name"]: r["status"] for r in report.checks.collect()}
    assert status["Negative New Cases"] == "WARN" and status["Negative New Deaths"] == "PASS"
    assert report.summary.first()["overall_status"] == "WARN"


def test_gates_fall_back_to_location_or_to_all_missing(spark):
    df = spark.createDataFrame([("USA", "2021-01-01", 1.0)], ["location", "date", "new_cases"])
    assert quality.quality_report(df, min_entities=1).summary.first()["overall_status"] == "PASS"
    bare = spark.createDataFrame([(1.0,), (2.0,)], ["new_cases"])
    metrics = {r["name"]: r["metric"] for r in quality.quality_report(bare).checks.collect()}
    assert metrics["Missing Country Names"] == metrics["Missing Dates"] == 2
    assert metrics["Duplicate Country-Date Records"] == 0
    with pytest.raises(ValueError):
        quality.quality_report(df.where(F.lit(False)))
