"""Corpus pipeline: quality rules, exact and near duplicates, source mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import stages
from panelkit.session import keep, materialise, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", stages.quality),
    ("exact_dedup", stages.exact),
    ("ngram_jaccard_join", stages.near),
    ("source_mixing", stages.mixing),
    ("best_fit_packing", stages.packed),
]

#: SQL cannot express hashed likelihood ratios, seeded draws and best-fit search; the tests
#: compare run() with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored and read again by the next.

    What a stage stores besides its result is removed when it is over, and its result when the next one
    has been stored.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark):
        for name, stage in STAGES:
            with scratch(spark):
                docs = keep(materialise(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        return keep(docs)
