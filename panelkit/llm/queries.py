"""The corpus operators applied to the whole test tables: one query per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (
    conversation_repair,
    exact_dedup,
    language_id,
    license_scan,
    ngram_join,
    packing,
    personal_data,
    quality_rules,
    resampling,
    source_mixing,
    suffix_dedup,
    token_counts,
    toxicity,
)
from panelkit.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.identify(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def op2_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
    )


def op3_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    found = personal_data.personal_spans(table(spark, sf, "documents"))
    kinds = [name for name, _ in personal_data.PATTERNS]
    names = F.array(*map(F.lit, [*kinds, "term"]))

    def joined(spans: Column) -> Column:
        as_text = F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        )
        return F.array_join(as_text, ",")

    base = F.filter("spans", lambda s: s["kind"] < len(kinds))
    counts = (
        F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{name}")
        for kind, name in enumerate(kinds)
    )
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return found.drop("spans", "kept").withColumnRenamed("id", "doc_id")


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.col("digest").alias("text_sha256"),
    )


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack(table(spark, sf, "documents"))
    return packed.drop("row").withColumnRenamed("id", "doc_id")


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    trusted = quality_rules.trusted_documents(table(spark, sf, "labels"))
    judged = quality_rules.quality_rules(table(spark, sf, "documents"), trusted)
    return judged.withColumnRenamed("id", "doc_id")


def op9_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixture = source_mixing.mix(table(spark, sf, "documents"))
    return mixture.documents().withColumnRenamed("id", "doc_id")


def op10_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    scanned = license_scan.license_scan(table(spark, sf, "documents"))
    return scanned.withColumnRenamed("id", "doc_id")


def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    found = conversation_repair.repair(conversation_repair.damaged(rows))
    found = conversation_repair.with_all(found, F.col("conv_id"), rows)
    return found.withColumnRenamed("conv", "conv_id")


def op12_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.assess(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


def op13_target_resampling(spark: SparkSession, sf: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return drawn.withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op")}
