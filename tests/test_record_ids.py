"""Record ids of the facts are counters over all rows, as the feed's order gives them."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from panelkit.plans import model, suite
from tests.test_hazards import features_rows

NUMBERED = [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 2, 2), (5, 2, 3)]  # id, entity, day


def ids(fact) -> list[tuple[int, int, int]]:
    return sorted((r["record_id"], r["country_id"], r["date"].day) for r in fact.collect())


@pytest.fixture(scope="module")
def rows(spark):
    undated = features_rows(spark).where("country = 'A'").withColumn("date", F.lit(None).cast("date"))
    return features_rows(spark).unionByName(undated)


def test_daily_fact_counts_its_rows(spark, rows):
    assert ids(model.build_daily_fact(rows)) == NUMBERED
    m = model.build_all(rows)
    assert ids(m.daily) == NUMBERED
    assert {r["year"] for r in m.daily.collect()} == {dt.date(2021, 1, 1).year}


def test_vaccination_fact_counts_its_rows(spark, rows):
    assert ids(model.build_vaccination_fact(rows)) == NUMBERED
    assert ids(model.build_all(rows).vaccination) == NUMBERED


def test_orphans_are_named_by_their_counters(spark, rows):
    m = model.build_all(rows)
    found = suite.orphans(replace(m, countries=m.countries.where("country_id = 1")))
    assert ids(found) == NUMBERED[2:]
