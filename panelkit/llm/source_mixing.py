"""Mixing sources to target weights.

The words of a source's documents, in the order of a hash, form one stream that is cut into
blocks of ``BLOCK`` words. Each source has a target number of words, and so a number of slots in
the output. The output is divided into shards; for each shard the numbers of slots per source
are a multinomial draw from what the sources have left, so that the shards together meet the
targets. The slots of a source are numbered through all shards and mapped to its blocks by a
seeded pseudorandom permutation per pass; blocks and slots meet in a join on (source, block).

The driver holds one row per source, never anything per document; one task draws the shards, one after
the other. Slots and pieces of documents are made inside tasks, and Spark takes them for as small as the
rows they come from, so their join is told to merge: a broadcast would take them through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import once, whole_text, words
from panelkit.session import materialise

WEIGHTS = (5, 2, 1)  # fixed values: weights by rank of the source, repeating
TOTAL = 1.5  # fixed value: words of the mix per word of the input
REPEATS = 2  # fixed value: a source, a block, a document is used so often at most
BLOCK = 64
SLOTS_PER_SHARD = 4096
SHARDS = 2048  # at most; larger mixes have larger shards
BUCKET_WORDS = 1_000_000
BUCKETS = 65_536  # at most; larger sources have larger buckets
SEED = 20


def source_targets(sizes: list[int]) -> list[float]:
    """Target words of sources in their order: shares by weight, none above its limit."""
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    targets = [0.0] * len(sizes)
    left, open_ = TOTAL * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = {i for i in open_ if weights[i] * unit > REPEATS * sizes[i]}
        if not above:
            for i in open_:
                targets[i] = weights[i] * unit
            break
        for i in above:
            targets[i] = float(REPEATS * sizes[i])
        left -= sum(targets[i] for i in above)
        open_ -= above
    return targets


def shard_draws(slots: list[int], seed: int = SEED) -> Iterator[tuple[int, int, int, int]]:
    """(shard, source, first slot of the source, slots): multinomial draws until none are left."""
    generator = np.random.default_rng(seed)
    left, first = np.array(slots, dtype=np.int64), np.zeros(len(slots), dtype=np.int64)
    size = max(SLOTS_PER_SHARD, math.ceil(left.sum() / SHARDS))
    shard = 0
    while left.sum():
        drawn, want = np.zeros_like(left), min(size, int(left.sum()))
        while want:
            rest = left - drawn
            drawn += np.minimum(generator.multinomial(want, rest / rest.sum()), rest)
            want = min(size, int(left.sum())) - int(drawn.sum())
        yield from ((shard, int(s), int(first[s]), int(drawn[s])) for s in np.flatnonzero(drawn))
        first, left, shard = first + drawn, left - drawn, shard + 1


def permuted(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0..size-1 at ``numbers``: a Feistel network, walked into range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, 4, dtype=np.uint64)

    def walk(value: np.ndarray) -> np.ndarray:
        left, right = value >> np.uint64(half), value & low
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & low)
        return left << np.uint64(half) | right

    result = walk(numbers.astype(np.uint64))
    while (outside := result >= size).any():
        result[outside] = walk(result[outside])
    return result.astype(np.int64)


def n_words(column: str) -> Column:
    return F.size(words(whole_text(column))).cast("long")


@dataclass
class Mixture:
    """A drawn mixture; ``rows`` holds row, id, content, source number, size, offset in the stream."""

    rows: DataFrame
    sources: DataFrame
    draws: DataFrame
    seed: int

    @cached_property
    def slots(self) -> DataFrame:
        """shard, number (source), slot, pass, block: every slot of the output."""
        seed = self.seed

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    slot = np.arange(row["first"], row["first"] + row["slots"], dtype=np.int64)
                    turn = slot // row["blocks"]
                    block = np.empty_like(slot)
                    for t in np.unique(turn):
                        of_turn = turn == t
                        key = hash((seed, row["number"], int(t))) & 0xFFFFFFFF  # of integers: stable
                        block[of_turn] = permuted(slot[of_turn] % row["blocks"], row["blocks"], key)
                    n = len(slot)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": pa.array(np.full(n, row["shard"], dtype=np.int32)),
                            "number": pa.array(np.full(n, row["number"], dtype=np.int32)),
                            "slot": pa.array(slot),
                            "pass": pa.array(turn.astype(np.int32)),
                            "block": pa.array(block),
                        }
                    )

        blocks = self.sources.select("number", "blocks")
        spread = self.draws.join(blocks, "number").repartition("shard", "number")
        return spread.mapInArrow(
            placed, "shard int, number int, slot long, pass int, block long"
        )

    @cached_property
    def pieces(self) -> DataFrame:
        """row, number, block, first and end word in the document, of each part of a document in a block."""
        end = F.col("offset") + F.col("size")
        last = F.floor((end - 1) / F.lit(BLOCK))
        begin = F.col("block") * BLOCK
        return (
            self.rows.filter("size > 0")
            .select("row", "number", "offset", "size", F.explode(F.sequence(F.floor(F.col("offset") / BLOCK), last)).alias("block"))
            .select(
                "row",
                "number",
                "block",
                (F.greatest("offset", begin) - F.col("offset")).alias("first"),
                (F.least(end, begin + BLOCK) - F.col("offset")).alias("end"),
            )
        )

    @cached_property
    def placed(self) -> DataFrame:
        """The pieces with the shard, slot and pass of each use."""
        return self.pieces.hint("merge").join(self.slots, ["number", "block"])

    def documents(self) -> DataFrame:
        """id, size, source_size, target, taken of every row."""
        used = self.slots.groupBy("number", "block").agg(F.count(F.lit(1)).alias("uses"))
        taken = (
            self.pieces.hint("merge").join(used, ["number", "block"])
            .groupBy("row")
            .agg(F.sum((F.col("end") - F.col("first")) * F.col("uses")).alias("taken"))
        )
        totals = self.sources.select("number", "source_size", "target")
        return (
            self.rows.join(totals, "number")
            .join(taken, "row", "left")
            .select(
                "id",
                "size",
                "source_size",
                "target",
                F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
            )
        )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = SEED,
) -> Mixture:
    """Draw a mixture of all documents.

    A null source is a source of its own, the last; a null or empty text has no words and is
    never taken. Repeated rows count each for themselves. An empty table gives an empty mixture.
    Other columns are not read. The number of sources must fit on the driver. Reruns agree,
    however the input is divided into files and tasks.
    """
    spark = docs.sparkSession
    sized = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).cast("long").alias("id"),
            F.xxhash64(text_column).alias("content"),
            F.col(source_column).cast("string").alias("source"),
            n_words(text_column).alias("size"),
        ),
        "mixing-rows",
    )
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found = sorted(found, key=lambda row: (row["source"] is None, row["source"] or ""))
    sizes = [row["size"] for row in found]
    targets = source_targets(sizes)
    blocks = [max(1, math.ceil(size / BLOCK)) for size in sizes]
    slots = [
        min(REPEATS * n, round(target * n / size)) if size else 0
        for size, target, n in zip(sizes, targets, blocks)
    ]
    sources = spark.createDataFrame(
        [
            (i, row["source"], size, target, n)
            for i, (row, size, target, n) in enumerate(zip(found, sizes, targets, blocks))
        ],
        "number int, source string, source_size long, target double, blocks long",
    )
    drawn = spark.sparkContext.parallelize([slots], 1).flatMap(lambda left: shard_draws(left, seed))
    draws = spark.createDataFrame(drawn, "shard int, number int, first long, slots long")
    buckets = min(BUCKETS, max(1, sum(sizes) // BUCKET_WORDS))
    order = F.xxhash64("id", "content")
    numbered = (
        sized.join(
            sources.select("number", F.col("source").alias("__source")),
            F.col("source").eqNullSafe(F.col("__source")),
        )
        .drop("source", "__source")
        .withColumn("order", order)
        .withColumn("bucket", F.pmod("order", F.lit(buckets)))
    )
    in_bucket = Window.partitionBy("number", "bucket").orderBy("order", "id", "content", "row")
    before = Window.partitionBy("number").orderBy("bucket")
    starts = (
        numbered.groupBy("number", "bucket")
        .agg(F.sum("size").alias("words"))
        .select("number", "bucket", (F.sum("words").over(before) - F.col("words")).alias("start"))
    )
    rows = (
        numbered.join(starts, ["number", "bucket"])
        .withColumn("offset", F.col("start") + F.sum("size").over(in_bucket) - F.col("size"))
        .select("row", "id", "content", "number", "size", "offset")
    )
    return Mixture(materialise(rows, "mixing-streams"), sources, draws, seed)


def mixed_texts(docs: DataFrame, mixture: Mixture, id_column: str, text_column: str) -> DataFrame:
    """The documents with the texts that the mixture takes, a row for each pass over them.

    A document taken as a whole keeps its text; of one taken in part the row holds the taken
    words, in their order. Documents without words are not taken. Rows that share id and text must
    have been made one before; an empty table stays empty. Rows travel as one struct, so columns
    may have any names.
    """
    spans = (
        mixture.placed.join(mixture.rows.select("row", "id", "content", "size"), "row")
        .groupBy("row", "pass")
        .agg(
            F.first("id").alias("taken_id"),
            F.first("content").alias("taken_content"),
            F.sum(F.col("end") - F.col("first")).alias("taken"),
            F.first("size").alias("size"),
            F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans"),
        )
        .drop("row", "pass")
    )
    def part(found: Column) -> Column:
        cut = F.transform(
            "spans",
            lambda s: F.slice(found, (s["first"] + 1).cast("int"), (s["end"] - s["first"]).cast("int")),
        )
        return F.array_join(F.flatten(cut), " ")

    rows = docs.select(
        F.struct("*").alias("doc"),
        F.col(id_column).cast("long").alias("id"),
        F.xxhash64(text_column).alias("content"),
    )
    whole = F.col("doc").getField(text_column)
    text = F.when(F.col("taken") == F.col("size"), whole).otherwise(once(words(whole_text(whole)), part))
    joined = rows.join(
        spans, F.col("id").eqNullSafe(F.col("taken_id")) & (F.col("content") == F.col("taken_content"))
    )
    return joined.select(*((text if c == text_column else F.col("doc").getField(c)).alias(c) for c in docs.columns))
