"""From a CSV file to query results."""

from __future__ import annotations

import datetime as dt

import pytest

from panelkit.plans import run
from panelkit.sources import latest_audit

HEADER = "iso_code,continent,location,date,total_cases,new_cases,total_deaths,new_deaths,population,people_vaccinated,people_fully_vaccinated"
SCHEMA = ", ".join(f"{c} string" for c in HEADER.split(","))


@pytest.fixture()
def feed(tmp_path):
    path = tmp_path / "feed.csv"
    lines = [HEADER]
    start = dt.date(2021, 1, 1)
    for code, region, name, people in (
        ("IND", "Asia", "India", 6_000_000),
        ("USA", "North America", "US", 8_000_000),
        ("OWID", "", "World", 14_000_000),
    ):
        for day in range(70):
            date = start + dt.timedelta(days=day)
            cases = 2000 * (day + 1)
            lines.append(f"{code},{region},{name},{date},{cases},2000,{cases // 50},40,{people},"
                         f"{day * 50_000},{day * 40_000}")  # fmt: skip
    # a correction later in the file
    lines.append("IND,Asia, India ,2021/01/01,7,7,0,-3,6000000,0,0")
    lines.append("IND,Asia,India,never,1,1,1,1,1,1,1")
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_run(spark, feed, tmp_path):
    done = run.run_all(
        spark, feed, str(tmp_path / "out"), SCHEMA, min_entities=2, stop_on_fail=True,
        provenance={"data_curator": "tests"}, metadata={"project_name": "tests"},
        audit_path=str(tmp_path / "audit"),
    )
    audit = latest_audit(spark, str(tmp_path / "audit")).first()
    assert (audit["record_count"], audit["column_count"]) == (212, 11)
    assert audit["notes"] == {"data_curator": "tests"}
    assert done.contract.first()["status"] == "PASS"
    assert done.report.summary.first()["overall_status"] == "PASS"
    assert done.features.count() == 140
    first = done.features.where("country = 'India' and date = '2021-01-01'").first()
    assert (first["new_cases"], first["new_deaths"]) == (7.0, 0.0), "last row of the file"
    assert first["data_curator"] == "tests"
    assert {r["country_name"] for r in done.model.countries.collect()} == {"India", "United States"}
    results = {name: df.collect() for name, df in done.suite.items()}
    assert len(results) == 27
    assert [r["country_name"] for r in results["country_3"]] == ["India", "United States"]
    assert results["country_13"][0]["case_per_capita_rank"] == 1
    assert {r["country_name"] for r in results["advanced_day_zero"]} == {"India", "United States"}
    assert results["vaccination_16"][0]["monthly_fully_vax_growth"] == 1_200_000.0
    charts = {name: df.collect() for name, df in done.charts.items()}
    assert len(charts) == 20 and len(charts["17_pandemic_waves_smoothed"]) == 70
    assert {r["region"] for r in charts["12_regional_trends"]} == {"Asia", "North America"}
    assert len(charts["01_global_daily_cases"]) == 70
    assert charts["18_cases_heatmap"][0]["2021-02"] == 0.056


def test_stop_on_fail(spark, feed, tmp_path, monkeypatch):
    whole = run.quality.duplicate_metrics
    monkeypatch.setattr(
        run.quality, "duplicate_metrics", lambda df, keys: whole(df, keys).selectExpr("*", "1L AS d").drop("duplicate_key").withColumnRenamed("d", "duplicate_key")
    )
    with pytest.raises(run.QualityFailure, match="Duplicate"):
        run.run_all(spark, feed, str(tmp_path / "out"), SCHEMA, min_entities=2, stop_on_fail=True)
