"""Sources and sinks."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from panelkit import sources, streaming
from panelkit.operators import profile
from panelkit.plans import model
from panelkit.session import materialise, new_path, shared_dir

SCHEMA = "country string, date date, n double"
ROWS = [("a", dt.date(2021, 1, 1), 1.0), ("b", dt.date(2021, 1, 2), None)]


@pytest.fixture()
def small(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_csv_round_trip(spark, small, tmp_path):
    path = str(tmp_path / "t")
    sources.write_csv(small, path)
    assert sorted(map(tuple, sources.read_csv(spark, path, SCHEMA).collect())) == ROWS
    inferred = sources.read_csv(spark, path, columns=["n"], types={"n": "int"})
    assert inferred.dtypes == [("n", "int")]


def test_gzip_round_trip(spark, small, tmp_path):
    path = str(tmp_path / "t")
    sources.write_csv(small, path, compression="gzip")
    read = sources.read_csv(spark, path, SCHEMA, repartition=3)
    assert read.rdd.getNumPartitions() == 3 and read.count() == 2


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.read_csv(spark, str(tmp_path / "none"), SCHEMA)
    with pytest.raises(FileNotFoundError):
        sources.latest_audit(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        model.run_sql_file(spark, str(tmp_path / "none.sql"))


def test_only_asked_columns_are_parsed(spark, small, tmp_path, capsys):
    path = str(tmp_path / "t")
    sources.write_csv(small, path)
    sources.read_csv(spark, path, SCHEMA, columns=["n"]).explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<n:double>" in plan


def test_parquet_is_preferred_to_csv(spark, small, tmp_path):
    csv, parquet = str(tmp_path / "c"), str(tmp_path / "p")
    sources.write_csv(small, csv)
    fallback = sources.read_parquet_or_csv(spark, parquet, csv, "country string, date string, n double")
    assert dict(fallback.dtypes)["date"] == "date" and fallback.count() == 2
    small.limit(1).write.parquet(parquet)
    assert sources.read_parquet_or_csv(spark, parquet, csv).count() == 1


def test_audit_keeps_the_latest_record_per_source(spark, small, tmp_path):
    audit = str(tmp_path / "audit")
    sources.write_with_audit(small.limit(1), str(tmp_path / "x"), "s", audit, "csv")
    record = sources.write_with_audit(
        small, str(tmp_path / "y"), "s", audit, "parquet", {"curator": "me"}
    ).first()
    assert (record["record_count"], record["column_count"]) == (2, 3)
    assert record["columns"] == ["country", "date", "n"] and record["file_size_bytes"] > 0
    assert record["notes"] == {"curator": "me"} and record["saved_path"].endswith("y")
    sources.write_with_audit(small, str(tmp_path / "z"), "other", audit)
    assert sources.latest_audit(spark, audit).count() == 2


def test_batches_are_bounded_and_resume(spark, small, tmp_path):
    path, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    small.repartition(2, "country").write.mode("append").option("header", True).csv(path)
    seen = []

    def handle(batch, number):
        seen.append((number, batch.count()))

    streaming.for_each_batch(streaming.csv_stream(spark, path, SCHEMA), handle, progress)
    assert sum(n for _, n in seen) == 2
    small.write.mode("append").option("header", True).csv(path)
    streaming.for_each_batch(streaming.csv_stream(spark, path, SCHEMA), handle, progress)
    assert sum(n for _, n in seen) == 4, "files of the first run are not read again"


def test_feature_panel_sink(spark, small, tmp_path):
    stored = sources.write_feature_panel(small, str(tmp_path / "f"))
    assert stored.count() == 2
    assert sources.read_csv(spark, str(tmp_path / "f/csv"), SCHEMA).count() == 2


def test_column_contract(spark):
    names = [c for c in profile.REQUIRED_COLUMNS if c != "population"]
    row = profile.validate_columns([*names, "x"], spark=spark).first()
    assert (row["status"], row["missing_columns"]) == ("FAIL", ["population"])
    assert row["total_columns_found"] == 9 and row["required_columns_count"] == 9
    complete = spark.createDataFrame([tuple("x" * 9)], list(profile.REQUIRED_COLUMNS))
    assert profile.validate_columns(complete).first()["status"] == "PASS"


def test_profile_of_an_empty_table(spark, small):
    rows = profile.profile(small.where(F.lit(False))).collect()
    assert {r["null_pct"] for r in rows} == {0.0} and len(rows) == 3


def test_sql_text_file(spark, small, tmp_path):
    small.createOrReplaceTempView("small_table")
    path = tmp_path / "q.sql"
    path.write_text("-- note; with a semicolon\nSELECT 1 AS one;\nSELECT nope FROM small_table;\n"
                    "SELECT count(*) AS n FROM small_table;\n\n;")  # fmt: skip
    with pytest.warns(UserWarning, match="statement 2"):
        results = model.run_sql_file(spark, str(path))
    assert [r.first()[0] for r in results] == [1, 2]


def test_stored_tables_live_in_the_shared_folder(spark, small):
    stored = materialise(small, "small")
    assert stored.inputFiles()[0].replace("file://", "").startswith(
        shared_dir(spark).replace("file:", "")
    )
    assert new_path(spark, "a") != new_path(spark, "a")


def test_a_cluster_needs_a_shared_folder(tmp_path):
    def fake(setting, master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf={"spark.checkpoint.dir": setting}, sparkContext=context)

    assert shared_dir(fake("hdfs://x/ck/", "yarn")) == "hdfs://x/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake(None, "yarn"))
