"""Stored tables of a block are removed at its end, but for those that are handed on."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from panelkit.session import keep, materialise, new_path, remove, scratch


def path_of(table) -> str:
    return table.inputFiles()[0].rsplit("/", 1)[0]


def test_tables_of_a_block_are_removed(spark):
    with scratch(spark):
        with scratch(spark):
            gone = path_of(materialise(spark.range(3), "inner"))
            kept = keep(materialise(spark.range(4), "kept"))
            later = path_of(kept)
        assert kept.count() == 4
        with pytest.raises(PySparkException):
            spark.read.parquet(gone).count()
        stays = keep(materialise(spark.range(5), "outer"))
    with pytest.raises(PySparkException):
        spark.read.parquet(later).count()
    assert stays.count() == 5, "kept by the outermost block"
    remove(spark, path_of(stays))
    remove(spark, new_path(spark, "never-written"))
