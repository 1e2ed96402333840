"""Best-fit packing of documents into bins of fixed capacity, without conflicts in a bin.

Documents are dealt by hash to shards of bounded size, each of which is packed by itself, the
largest first. Bins are kept in the order of their free room and carry a bitmap of the sources
and one of the duplicate clusters that they hold. A document goes into the first bin, from the
tightest that has room on, with neither its source nor its cluster; without one it opens a bin.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import ascii_lower
from panelkit.llm.exact_dedup import normalised
from panelkit.llm.source_mixing import n_words
from panelkit.session import materialise

CAPACITY = 2048  # words
SHARD_WORDS = 2_000_000

PACKED = "row long, id long, source string, piece int, words long, shard long, bin long, free long"


def same_text(column: str) -> Column:
    """Cluster of a document: the same for texts that differ in case and white space only."""
    return F.xxhash64(ascii_lower(normalised(F.col(column))))


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> tuple[list[int], list[int]]:
    """Bin of each (size, source bit, cluster bit), and the free room of each bin.

    Sizes are at most ``capacity``; a bit is an integer with at most one bit set.
    """
    rooms: list[tuple[int, int]] = []
    sources: list[int] = []
    clusters: list[int] = []
    free: list[int] = []
    chosen = []
    for size, source, cluster in items:
        at = bisect_left(rooms, (size, -1))
        while at < len(rooms) and (
            sources[rooms[at][1]] & source or clusters[rooms[at][1]] & cluster
        ):
            at += 1
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            room, number = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
            free.append(capacity)
        sources[number] |= source
        clusters[number] |= cluster
        free[number] = room - size
        if room > size:
            insort(rooms, (room - size, number))
        chosen.append(number)
    return chosen, free


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """row, id, source, piece, words, shard, bin, free: one row per piece of a document.

    A document longer than a bin is cut into pieces that fill a bin each and a rest that is packed
    with others. No bin holds two documents of one source or one cluster (by default: of the same
    text). Null sources are one source. A null or empty text has no words and gives one piece of 0
    words without a bin. Repeated rows are packed each for itself and never together. ``free`` is
    the room left in the bin. An empty table gives no rows; other columns are not read.
    """
    sized = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).cast("long").alias("id"),
            F.col(source_column).cast("string").alias("source"),
            (same_text(text_column) if cluster is None else cluster).alias("cluster"),
            F.xxhash64(text_column).alias("content"),
            n_words(text_column).alias("size"),
        ),
        "packing-rows",
    )
    total = sized.agg(F.sum("size").alias("words")).first()["words"] or 0
    shards = max(1, math.ceil(total / shard_words))

    def packed(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=lambda r: (-(r["size"] % capacity), r["id"] is None, r["id"] or 0, r["content"]))
        numbers: dict[str | None, int] = {}
        seen: dict[int, int] = {}
        for r in rows:
            numbers.setdefault(r["source"], len(numbers))
            seen[r["cluster"]] = seen.get(r["cluster"], 0) + 1
        several = {c: 1 << i for i, c in enumerate(c for c, n in seen.items() if n > 1)}
        rests = [r for r in rows if r["size"] % capacity]
        items = [
            (r["size"] % capacity, 1 << numbers[r["source"]], several.get(r["cluster"], 0)) for r in rests
        ]
        chosen, free = best_fit(items, capacity)
        out = []

        def put(r: dict, piece: int, words: int, number: int | None, room: int | None) -> None:
            out.append((r["row"], r["id"], r["source"], piece, words, r["shard"], number, room))

        for r, number in zip(rests, chosen):
            put(r, r["size"] // capacity, r["size"] % capacity, number, free[number])
        opened = len(free)
        for r in rows:
            for piece in range(r["size"] // capacity):
                put(r, piece, capacity, opened, 0)
                opened += 1
            if not r["size"]:
                put(r, 0, 0, None, None)
        names = [field.split()[0] for field in PACKED.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
        columns = zip(*out) if out else [[]] * len(names)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    dealt = sized.withColumn("shard", F.pmod(F.xxhash64("id", "content"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(packed, PACKED)
