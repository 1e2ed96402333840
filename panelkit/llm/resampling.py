"""Importance resampling towards a target distribution, without sorting what is not drawn.

Every word and every pair of neighbouring words is a feature; its bucket is the CRC-32 of its
bytes modulo ``buckets``. The counts of all documents and of all target texts give each bucket a
gain, the log ratio of the two smoothed multinomials; a document's weight is the mean gain of its
features. Adding Gumbel noise that depends on the seed and the document alone turns the k highest
scores into a weighted draw without replacement.

The k-th score is found by a distributed quickselect. Each round takes random pivots among the
rows that may still hold it, counts exactly how many rows lie below, on and between them, and goes
on with the one interval that holds the k-th row. Keys are (score, id, tie-breaks, place), so no
two are equal and the cut is exact. Only the rows up to the cut are then sorted, in ranges.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.hashing import joined_bytes, steps
from panelkit.session import materialise

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
PIVOTS = 16  # random pivots of a round

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORD |= _WORD[_LOWER]
_STEP = 1 << 20  # bytes of text looked at together
_TABLED = 64  # longer words are hashed one by one


def _crc_table() -> np.ndarray:
    """The 256 remainders of the reflected polynomial of CRC-32."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1)
    return value


_CRC = _crc_table()


def _shift_tables() -> np.ndarray:
    """For each length, what each byte of a checksum becomes when so many bytes follow."""
    tables = np.zeros((_TABLED + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        tables[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for length in range(1, _TABLED + 1):
        before = tables[length - 1]
        tables[length] = _CRC[before & np.uint32(0xFF)] ^ (before >> np.uint32(8))
    return tables


_SHIFT = _shift_tables()


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of ASCII letters and digits and bytes beyond ASCII."""
    word = _WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.empty_like(word), np.empty_like(word)
    before[:1], before[1:] = False, word[:-1]
    after[-1:], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range, one byte of all short ranges at a time."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    begin, size = starts[order], lengths[order]
    values = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    long = int(np.count_nonzero(size > _TABLED))
    for at in range(int(size[long]) if long < len(size) else 0):
        active = slice(long, int(np.searchsorted(-size, -at, side="left")))
        byte = data[begin[active] + at]
        values[active] = _CRC[(values[active] ^ byte) & np.uint32(0xFF)] ^ (values[active] >> np.uint32(8))
    result = np.empty_like(values)
    result[order] = values ^ np.uint32(0xFFFFFFFF)
    for i in order[:long]:
        result[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return result


def shifted(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What checksums become when so many bytes, ``_TABLED`` at most, follow."""
    return np.bitwise_xor.reduce(
        [_SHIFT[lengths, k, (values >> np.uint32(8 * k)) & np.uint32(0xFF)] for k in range(4)]
    )


def crc32_followed(values: np.ndarray, following: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the joined bytes, from those of both parts and the length of the second one."""
    part = np.minimum(lengths, _TABLED)
    moved, rest = shifted(values, part), lengths - part
    while (more := np.flatnonzero(rest > 0)).size:
        part = np.minimum(rest[more], _TABLED)
        moved[more] = shifted(moved[more], part)
        rest[more] -= part
    return moved ^ following


def feature_buckets(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of each word and each pair of neighbours; words of each text."""
    data, offsets = joined_bytes(texts)
    data = _LOWER[data]
    starts, ends, owner = word_spans(data, offsets)
    single = crc32_of(data, starts, ends)
    n_words = np.bincount(owner, minlength=len(texts))
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    spaced = _CRC[(single[pair] ^ np.uint32(0xFFFFFFFF) ^ np.uint32(0x20)) & np.uint32(0xFF)]
    spaced ^= (single[pair] ^ np.uint32(0xFFFFFFFF)) >> np.uint32(8)
    double = crc32_followed(spaced ^ np.uint32(0xFFFFFFFF), single[pair + 1], (ends - starts)[pair + 1])
    return np.concatenate([single, double]) % np.uint32(buckets), np.concatenate([owner, owner[pair]]), n_words


def bucket_counts(texts: DataFrame, text_column: str, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in steps(batch, "text", _STEP):
                found, _, _ = feature_buckets(part.column("text"), buckets)
                sums += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["bucket", "n"])

    rows = texts.select(F.col(text_column).cast("string").alias("text")).mapInArrow(counted, "bucket long, n long")
    sums = np.zeros(buckets, dtype=np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        sums[row["bucket"]] = row["n"]
    return sums


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the two multinomials, each smoothed by one, floored."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def weighted(docs: DataFrame, gain: np.ndarray, id_column: str, text_column: str) -> DataFrame:
    """id, n_words, n_features, weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in steps(batch, "text", _STEP):
                found, owner, n_words = feature_buckets(part.column("text"), len(table))
                n = np.bincount(owner, minlength=part.num_rows)
                total = np.bincount(owner, table[found], part.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(n_words.astype(np.int64)),
                        pa.array(n.astype(np.int64)),
                        pa.array(np.where(n > 0, total // np.maximum(n, 1), 0)),
                    ],
                    names=["id", "n_words", "n_features", "weight"],
                )

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(scored, "id long, n_words long, n_features long, weight long")


def noise(ids: Column, seed: int) -> Column:
    """Thousandths of standard Gumbel noise, a function of seed and id; a null id is written empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def before(keys: Sequence[Column], values: Sequence) -> Column:
    """Whether the composite key of a row is smaller than that of the given values."""
    found = F.lit(False)
    for key, value in zip(reversed(keys), reversed(values)):
        found = (key < F.lit(value)) | ((key == F.lit(value)) & found)
    return found


def quickselect(rows: DataFrame, keys: Sequence[str], k: int, pivots: int = PIVOTS) -> tuple | None:
    """The k-th smallest composite key (1 for the first) of ``rows``, None where there is none.

    ``keys`` are integer columns without nulls that are unique together. One aggregate a round:
    it counts the rows between the pivots, those on a pivot apart from both sides, and draws
    the pivots of the next round from each interval. The driver gets counts and pivots only, at
    most (2 pivots + 1) times ``pivots`` rows.
    """
    if k < 1:
        return None
    columns = [F.col(key) for key in keys]
    low, high, chosen, done = None, None, [], 0  # the wanted key lies between low and high
    for turn in range(1_000):
        left = rows
        if low is not None:
            left = left.filter((columns[0] >= low[0]) & ~before(columns, low) & ~_same(columns, low))
        if high is not None:
            left = left.filter((columns[0] <= high[0]) & before(columns, high))
        # interval 2 i lies before pivot i, interval 2 i + 1 is pivot i
        interval = F.lit(2 * len(chosen))
        for i in reversed(range(len(chosen))):
            interval = F.when(before(columns, chosen[i]), F.lit(2 * i)).when(
                _same(columns, chosen[i]), F.lit(2 * i + 1)
            ).otherwise(interval)
        random = F.xxhash64(F.lit(turn), *columns)
        counted = (
            left.groupBy(interval.alias("interval"), F.pmod(random, F.lit(pivots)).alias("part"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(random.alias("random"), *keys)).alias("next"))
            .collect()
        )
        sizes, drawn = {}, {}
        for row in counted:
            sizes[row["interval"]] = sizes.get(row["interval"], 0) + row["n"]
            drawn.setdefault(row["interval"], set()).add(tuple(row["next"][key] for key in keys))
        for at in sorted(sizes):
            if done + sizes[at] >= k:
                break
            done += sizes[at]
        else:
            return None
        if at % 2:
            return chosen[at // 2]
        if at > 0:
            low = chosen[at // 2 - 1]
        if at // 2 < len(chosen):
            high = chosen[at // 2]
        chosen = sorted(drawn[at])
    raise RuntimeError("composite keys are not unique")


def _same(keys: Sequence[Column], values: Sequence) -> Column:
    found = F.lit(True)
    for key, value in zip(keys, values):
        found = found & (key == F.lit(value))
    return found


def ranked(winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``place`` and ``rank`` (1, 2, ...) of the rows in the order of ``keys``.

    Rows are dealt by range and sorted in their range; ranges are offset by the sizes of those before.
    """
    dealt = materialise(
        winners.select(*keys).repartitionByRange(*keys).withColumn("range", F.spark_partition_id()), "winners"
    )
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*keys))
    return dealt.join(F.broadcast(offsets), "range").select("place", (F.col("offset") + inside).alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """id, n_features, weight, score, rank of every row; ``rank`` is null where a row is not drawn.

    Of the rows with ``min_words`` words at least, ``percent`` per cent (floored) are drawn: those with
    the highest scores, ties to the smaller id. A null or empty text has no features and weight 0. Rows
    without an id take part after all others of their score, with the noise of an empty id. Of rows
    that share score and id, the one with more features, then the one stored first is drawn first. An
    empty table gives no rows; without target texts all gains come from the smoothing. Other columns
    are not read.
    """
    gain = gains(bucket_counts(docs, text_column, buckets), bucket_counts(target, text_column, buckets))
    found = weighted(docs, gain, id_column, text_column)
    score = F.col("weight") + noise(F.col("id"), seed)
    keys = {
        "falling": -score,
        "no_id": F.col("id").isNull().cast("int"),
        "known_id": F.coalesce("id", F.lit(0)),
        "fewer": -F.col("n_features"),
        "place": F.monotonically_increasing_id(),
    }
    scored = materialise(found.select("*", score.alias("score"), *(c.alias(name) for name, c in keys.items())), "scored")
    able = scored.filter(F.col("n_words") >= min_words).select(*keys)
    last = quickselect(able, list(keys), able.count() * percent // 100, pivots)
    columns = [F.col(key) for key in keys]
    if last is None:
        winners = able.limit(0)
    else:
        winners = able.filter((columns[0] <= last[0]) & (before(columns, last) | _same(columns, last)))
    return scored.join(ranked(winners, list(keys)), "place", "left").select(
        "id", "n_features", "weight", "score", F.col("rank").cast("long")
    )
