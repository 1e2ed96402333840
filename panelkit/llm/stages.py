"""Stages of the corpus pipeline: each takes documents and returns those that go on.

Null texts count as empty: the quality rules reject them, the other stages keep or pack them as
texts without words. An empty table gives an empty table. Rows repeated with one id and text are
one document from the exact stage on. All columns are carried along, whatever their names, but for
the last stage, which returns places instead of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import exact_dedup, ngram_join, packing, quality_rules, source_mixing
from panelkit.llm.common import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    trusted = quality_rules.trusted_documents(table(spark, sf_dir, "labels"))
    return quality_rules.kept_documents(docs, trusted)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: sequences of five words, similarity 0.8."""
    return ngram_join.keep_one(docs, percent=80, n_words=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mixture of the sources takes; ``n_chars`` is that of the new text."""
    mixed = source_mixing.mixed_texts(docs, source_mixing.mix(docs), "doc_id", "text")
    return mixed.withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: shard, bin, and the room left in it."""
    return packing.pack(docs).drop("row").withColumnRenamed("id", "doc_id")
