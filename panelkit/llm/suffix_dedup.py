"""Removal of repeated byte strings with suffix arrays.

A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a document
with a smaller id, or earlier in the same one.

Shards. Each stretch of ``SHARD`` bytes of documents gets a suffix array, by the refinement of
Larsson and Sadakane in array operations: suffixes are grouped by their first five bytes or so, and
groups with more than one member are sorted again by the group of the suffix h bytes on, h
doubling. The last step reaches ``length`` bytes exactly, so suffixes share a group just when their
common prefix has that many; all but the first of a group are repeats.

Between shards. Every string of ``length`` bytes has an anchor: the ``GRAM`` bytes in it with the
smallest hash, which equal strings share. Per anchor a shard sends one row: the hash of its bytes,
the hash of the neighbourhood (all strings with this anchor), and the place. Rows of all shards
are merged in the order of these hashes. Where an anchor has equal neighbourhoods only, all but
the first are repeats; where neighbourhoods differ, the bytes of one of each kind are fetched and
grouped by a suffix array of their own. An anchor with more than ``CROWDED`` neighbourhoods (a line
that many documents share amid different text) would outgrow a task: its strings are then keyed anew,
by the anchor together with the smallest grams before and after it, which equal strings share too, and
go the same way. Strings of keys that stay crowded are keyed by their own digests, and all but the
oldest per digest are repeats. A document longer than a
shard is cut into parts that overlap by ``length`` - 1 bytes, so that each string lies in one part;
the parts exchange anchors as shards do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import whole_text
from panelkit.llm.hashing import between, joined_bytes, mixed, prefix_hash, steps
from panelkit.session import materialise, materialise_counted

LENGTH = 100
SHARD = 3 << 19  # bytes; arrays of a shard take some hundred times as much
GRAM = 20
CROWDED = 4096  # neighbourhoods of one anchor that one task compares; each has under 200 bytes

#: kind 1: starts first..last of strings that are repeats; 2: the strings that start at first..last
#: must be compared with those of the other rows of the same key
FOUND = "kind int, key long, near long, row long, id long, first int, last int"
SPLIT = f"{FOUND}, bytes binary"
ANCHOR, REPEAT = 2, 1


def suffix_groups(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their first ``length`` bytes, and the group of each position.

    Two positions have one group if these bytes are equal; groups are numbered by the place of
    their first member in the order. Beyond its end the data counts as zeros.
    """
    n = len(data)
    kind = np.int32 if n < 1 << 31 else np.int64
    # bytes by their rank among those that occur, so that more of them fit into a number
    used = np.zeros(256, dtype=bool)
    used[data] = True
    used[0] = True
    rank = np.cumsum(used).astype(np.uint64) - np.uint64(1)
    width = max(1, int(rank[-1]).bit_length())
    bits = max(1, n.bit_length())
    step = min((64 - bits) // width, length)
    padded = np.zeros(n + step, dtype=np.uint64)
    padded[:n] = rank[data]
    head = padded[:n].copy()
    for i in range(1, step):
        head <<= np.uint64(width)
        head |= padded[i : n + i]
    # sorting values that carry their position is several times faster than sorting positions
    bits, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    head <<= bits
    head |= np.arange(n, dtype=np.uint64)
    head.sort()
    order = (head & mask).astype(kind)
    head >>= bits
    new = np.ones(n, dtype=bool)
    np.not_equal(head[1:], head[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    group = np.empty(n + 1, dtype=kind)
    group[order] = np.repeat(starts.astype(kind), np.diff(np.append(starts, n)))
    group[n] = -1
    done = step
    while done < length:
        # the last step overlaps the one before, so that groups agree on ``length`` bytes exactly
        apart = min(done, length - done)
        alone = new.copy()  # members of a group of one
        alone[:-1] &= new[1:]
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        members = order[places]
        own, beyond = group[members], group[np.minimum(members + kind(apart), kind(n))]
        if 3 * int(bits) <= 64:
            pair = own.astype(np.uint64) << bits
            pair |= (beyond + kind(1)).astype(np.uint64)
            pair <<= bits
            pair |= np.arange(len(own), dtype=np.uint64)
            pair.sort()
            members = members[(pair & mask).astype(kind)]
            pair >>= bits
            fresh = np.ones(len(members), dtype=bool)
            np.not_equal(pair[1:], pair[:-1], out=fresh[1:])
        else:
            by = np.lexsort((beyond, own))
            members, own, beyond = members[by], own[by], beyond[by]
            fresh = np.ones(len(members), dtype=bool)
            fresh[1:] = (own[1:] != own[:-1]) | (beyond[1:] != beyond[:-1])
        order[places] = members
        new[places] = fresh
        at = np.flatnonzero(fresh)
        group[members] = np.repeat(places[at].astype(kind), np.diff(np.append(at, len(members))))
        done += apart
    return order, group[:n]


def repeats(data: np.ndarray, valid: np.ndarray, age: np.ndarray, length: int) -> np.ndarray:
    """Which of the positions ``valid`` start a string that starts at another one of less ``age``."""
    if not len(valid):
        return np.zeros(0, dtype=bool)
    order, group = suffix_groups(data, length)
    ages = np.full(len(data), np.iinfo(np.int64).max)
    ages[valid] = age
    begin = np.flatnonzero(group[order] == np.arange(len(order)))  # a group is numbered by its place
    oldest = np.minimum.reduceat(ages[order], begin)
    number = np.zeros(len(data), dtype=np.int64)
    number[begin] = np.arange(len(begin))
    return age > oldest[number[group[valid]]]


_PLACE = np.uint64(32)  # bits of a position, below the hash of its gram


def ranked_grams(sums: np.ndarray) -> np.ndarray:
    """For each position the hash of the gram there above the position: the same order in all shards."""
    starts = np.arange(max(0, len(sums) - GRAM))
    low = mixed(between(sums, starts, starts + GRAM))
    return low >> _PLACE << _PLACE | starts.astype(np.uint64)


def place_of(gram: np.ndarray) -> np.ndarray:
    return (gram & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)


def anchors(sums: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """Position of the anchor of the string at each valid start: the first smallest gram hash."""
    low = ranked_grams(sums)
    if not len(low) or not len(valid):
        return np.zeros(0, dtype=np.int64)
    span, reach = length - GRAM + 1, 1
    while reach < span:  # smallest of ``reach`` neighbours, doubled
        more = min(reach, span - reach)
        low[:-more] = np.minimum(low[:-more], low[more:])
        reach += more
    return place_of(low[valid])


def smallest_between(levels: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The smallest gram at first..last, all ones where there is none; level k has the smallest of
    2**k neighbours."""
    found = np.full(len(first), np.iinfo(np.uint64).max, dtype=np.uint64)
    width = last - first + 1
    for k, level in enumerate(levels):
        now = np.flatnonzero((width >= 1 << k) & (width < 2 << k))
        found[now] = np.minimum(level[first[now]], level[last[now] - (1 << k) + 1])
    return found


def split_rows(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """The neighbourhoods of crowded anchors, cut where the smallest gram before or after changes."""
    data, offsets = joined_bytes(batch.column("bytes"))
    valid, owner = starts_of(offsets, length)
    sums = prefix_hash(data)
    anchor = anchors(sums, valid, length)
    levels = [ranked_grams(sums)]
    while 1 << len(levels) <= length:
        level, step = levels[-1], 1 << len(levels) - 1
        levels.append(np.concatenate([np.minimum(level[:-step], level[step:]), level[len(level) - step :]]))
    before = smallest_between(levels, valid, anchor - GRAM)
    after = smallest_between(levels, anchor + GRAM, valid + length - GRAM)
    key = batch.column("key").to_numpy().view(np.uint64)[owner]
    for gram, side in ((before, 1), (after, 2)):
        apart = np.where(gram == np.iinfo(np.uint64).max, 0, np.abs(place_of(gram) - anchor)).astype(np.uint64)
        key = mixed(key ^ mixed((gram >> _PLACE) * np.uint64(4) + np.uint64(side)) ^ apart)
    begin, end = runs(key ^ mixed(owner.astype(np.uint64)))
    own, first, last = owner[begin], valid[begin], valid[end - 1]
    base = batch.column("first").to_numpy()[own] - offsets[own]
    whole = data.tobytes()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(begin), ANCHOR, dtype=np.int32)),
            pa.array(key[begin].view(np.int64)),
            pa.array(mixed(between(sums, first, last + length) + (last - first).astype(np.uint64)).view(np.int64)),
            batch.column("row").take(pa.array(own)),
            batch.column("id").take(pa.array(own)),
            pa.array((first + base).astype(np.int32)),
            pa.array((last + base).astype(np.int32)),
            pa.array([whole[f : l + length] for f, l in zip(first.tolist(), last.tolist())], pa.binary()),
        ],
        names=[field.split()[0] for field in SPLIT.split(", ")],
    )


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return begin, np.append(begin[1:], len(values))


def starts_of(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a string of ``length`` bytes fits into its text, and the text of each."""
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - before[owner] + offsets[owner], owner


def shards(batch: pa.RecordBatch, length: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Slices of a batch with at most ``SHARD`` starts of strings, and where the first text's begins."""
    for part in steps(batch, "text", SHARD):
        text = part.column("text")[0].as_buffer()
        if len(part) > 1 or text is None or text.size < SHARD + length:
            yield part, 0
            continue
        at = part.schema.get_field_index("text")
        for base in range(0, text.size - length + 1, SHARD):
            piece = text.slice(base, min(SHARD + length - 1, text.size - base)).to_pybytes()
            yield part.set_column(at, "text", pa.array([piece], pa.large_binary())), base


def shard_rows(part: pa.RecordBatch, length: int, base: int = 0) -> pa.RecordBatch:
    """The local repeats and anchors of one shard.

    With a ``base`` it is a later part of one document, which begins there.
    """
    data, offsets = joined_bytes(part.column("text"))
    row = part.column("row").to_numpy()
    known = part.column("id")
    id_ = known.fill_null(0).to_numpy()
    by_age = np.lexsort((row, id_, known.is_null().to_numpy(zero_copy_only=False)))
    rank = np.empty(len(row), dtype=np.int64)
    rank[by_age] = np.arange(len(row))
    valid, owner = starts_of(offsets, length)
    again = repeats(data, valid, rank[owner] * (len(data) + 1) + valid, length)
    sums = prefix_hash(data)
    anchor = anchors(sums, valid, length)
    begin, end = runs(again * (len(row) + 1) + owner)
    local = again[begin]
    rows = [
        pd.DataFrame(
            {
                "kind": REPEAT,
                "key": mixed(row[owner[begin[local]]].astype(np.uint64)),
                "doc": owner[begin[local]],
                "first": valid[begin[local]],
                "last": valid[end[local] - 1],
            }
        ),
    ]
    begin, end = runs(anchor * 2 + (owner & 1))  # an anchor lies in one text
    fresh = np.add.reduceat(~again, begin) > 0 if len(begin) else np.zeros(0, dtype=bool)
    begin, end = begin[fresh], end[fresh]
    at, first, last = anchor[begin], valid[begin], valid[end - 1]
    shape = ((at - first) * 256 + (last - at)).astype(np.uint64)
    rows.append(
        pd.DataFrame(
            {
                "kind": ANCHOR,
                "key": mixed(between(sums, at, at + GRAM)),
                "near": mixed(between(sums, first, last + length) + mixed(shape)),
                "doc": owner[begin],
                "first": first,
                "last": last,
            }
        )
    )
    every = pd.concat(rows, ignore_index=True).fillna({"near": 0, "first": 0, "last": 0})
    doc = every["doc"].to_numpy()
    place = [every[c].to_numpy().astype(np.int64) - offsets[doc] + base for c in ("first", "last")]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(every["kind"].to_numpy().astype(np.int32)),
            pa.array(every["key"].to_numpy().astype(np.uint64).view(np.int64)),
            pa.array(every["near"].to_numpy().astype(np.uint64).view(np.int64)),
            pa.array(row[doc]),
            known.take(pa.array(doc)),
            pa.array(place[0].astype(np.int32)),
            pa.array(place[1].astype(np.int32)),
        ],
        names=[field.split()[0] for field in FOUND.split(", ")],
    )


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, neighbourhood and age: repeats, and one row of each kind to compare.

    Anchors that occur once are dropped. Only whether the key and the neighbourhood of the row
    before were the same is carried from batch to batch, and the row itself until it is known
    whether its key has another neighbourhood.
    """
    held: pa.Table | None = None
    met = False  # whether the held row's key had an earlier neighbourhood
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        kind, key, near = (table.column(c).to_numpy() for c in ("kind", "key", "near"))
        n = len(kind)
        anchor = kind == ANCHOR
        same_key = np.zeros(n, dtype=bool)
        same_key[1:] = (key[1:] == key[:-1]) & anchor[1:] & anchor[:-1]
        same_near = same_key.copy()
        same_near[1:] &= near[1:] == near[:-1]
        # one row per neighbourhood stands for it: where the key has another one, it is compared
        stands = anchor & ~same_near
        numbers = np.flatnonzero(stands)
        other = np.zeros(len(numbers), dtype=bool)
        if len(numbers):
            other[1:] = key[numbers[1:]] == key[numbers[:-1]]
            before = other.copy()
            before[0] = met and held is not None
            after = np.append(other[1:], False)
        out = np.where(anchor, -1, kind)
        out[same_near] = REPEAT
        if len(numbers):
            out[numbers[before | after]] = ANCHOR
        last = len(numbers) - 1
        keep = numbers[last] if len(numbers) else None
        if keep is not None:  # whether more neighbourhoods follow is not known yet
            met = bool(before[last])
            out[keep] = -1
            held = table.slice(keep, 1)
        else:
            held = None
        done = table.set_column(0, "kind", pa.array(out.astype(np.int32)))
        yield from done.filter(pa.array(out >= 0)).combine_chunks().to_batches()
    if held is not None and met:
        yield from held.to_batches()


def compare_variants(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeats among the neighbourhoods of each key; rows are sorted by key and age."""
    held: pd.DataFrame | None = None

    def repeated(frame: pd.DataFrame) -> pa.RecordBatch:
        data, offsets = joined_bytes(pa.array(frame["bytes"], pa.binary()))
        valid, owner = starts_of(offsets, length)
        key = pd.factorize(frame["key"])[0]
        order, group = suffix_groups(data, length)
        # strings of different keys differ in their anchors: equal ones stand under one key
        chosen = np.zeros(len(data), dtype=bool)
        chosen[valid] = True
        sorted_starts = order[chosen[order]]
        sorted_groups = group[sorted_starts]
        text_of = np.zeros(len(data), dtype=np.int64)
        text_of[valid] = owner
        # the oldest string of each group, looked up by the group's number
        oldest = np.minimum.reduceat(
            text_of[sorted_starts], np.searchsorted(sorted_groups, np.unique(sorted_groups))
        ) if len(valid) else np.zeros(0, np.int64)
        where = np.searchsorted(np.unique(sorted_groups), group[valid])
        again = oldest[where] < owner if len(valid) else np.zeros(0, dtype=bool)
        again &= key[oldest[where]] == key[owner] if len(valid) else again
        begin, end = runs(again * (len(frame) + 1) + owner)
        begin, end = begin[again[begin]], end[again[begin]]
        base = frame["first"].to_numpy()[owner[begin]] - offsets[owner[begin]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(frame["row"].to_numpy()[owner[begin]]),
                pa.array((valid[begin] + base).astype(np.int32)),
                pa.array((valid[end - 1] + base).astype(np.int32)),
            ],
            names=["row", "first", "last"],
        )

    for batch in batches:
        frame = batch.to_pandas()
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if len(frame):
            open_ = (frame["key"] == frame["key"].iloc[-1]).to_numpy()
            if (~open_).any():
                yield repeated(frame[~open_])
            held = frame[open_]
    if held is not None and len(held):
        yield repeated(held)


def crowded_repeats(cut: DataFrame, length: int) -> DataFrame:
    """row, first, last of each string of crowded anchors that an older one equals."""
    digest = F.substring(F.unhex(F.sha2(F.substring("bytes", F.col("i") + 1, F.lit(length)), 256)), 1, 16)
    strings = cut.withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length))
    ).select(
        digest.alias("digest"),
        F.struct(
            F.col("id").isNull().alias("unknown"), "id", "row", (F.col("first") + F.col("i")).alias("start")
        ).alias("age"),
    )
    oldest = (
        strings.groupBy("digest")
        .agg(F.min("age").alias("oldest"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
    return (
        strings.join(oldest, "digest")
        .filter((F.col("age.row") != F.col("oldest.row")) | (F.col("age.start") != F.col("oldest.start")))
        .select("age.row", F.col("age.start").alias("first"), F.col("age.start").alias("last"))
    )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    crowded: int = CROWDED,
) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end) and kept of every row.

    A null text counts as empty; texts shorter than ``length`` keep all bytes. Rows without an id
    are later than all others, rows with equal ids in the order of the input. An empty table gives
    no rows; other columns are not read. ``kept`` are the bytes that stay: a cut may fall into a
    character.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("id"),
        whole_text(text_column).alias("text"),
    )
    rows = materialise(texts, "suffix-texts")  # a number each, that stays

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in shards(batch, length):
                yield shard_rows(part, length, base)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "bytes", SHARD):
                yield split_rows(part, length)

    age = [F.col("id").isNull(), F.col("id"), F.col("row"), F.col("first")]

    def met(found: DataFrame, schema: str, name: str) -> DataFrame:
        dealt = found.repartition("key").sortWithinPartitions("key", "kind", "near", *age)
        return materialise(dealt.mapInArrow(merged, schema), name)

    def crowded_apart(variants: DataFrame, name: str) -> tuple[DataFrame, bool]:
        """``variants`` with ``many``, whether their key has too many of them; and whether one has."""
        counts = variants.groupBy("key").count().filter(F.col("count") > crowded)
        keys, n_keys = materialise_counted(counts.select(F.col("key").alias("crowded_key")), name)
        if not n_keys:
            return variants.withColumn("many", F.lit(False)), False
        joined = variants.join(keys, F.col("key") == F.col("crowded_key"), "left")
        return joined.withColumn("many", F.col("crowded_key").isNotNull()).drop("crowded_key"), True

    def compared(variants: DataFrame) -> DataFrame:
        dealt = variants.select("key", "row", "id", "first", "bytes").repartition("key")
        dealt = dealt.sortWithinPartitions("key", *age)
        return dealt.mapInArrow(lambda batches: compare_variants(batches, length), "row long, first int, last int")

    def repeated(found: DataFrame) -> DataFrame:
        return found.filter(F.col("kind") == REPEAT).select("row", "first", "last")

    found = met(rows.mapInArrow(sharded, FOUND), FOUND, "suffix-found")
    variants, some = crowded_apart(
        found.filter(F.col("kind") == ANCHOR).select("key", "row", "first", "last"), "suffix-crowded"
    )
    wanted = (
        variants.select(F.col("row").alias("row_of"), F.struct("key", "first", "last", "many").alias("place"))
        .groupBy("row_of")
        .agg(F.collect_list("place").alias("places"))
    )
    cut = (
        rows.join(wanted, F.col("row") == F.col("row_of"))
        .select("row", "id", F.encode("text", "UTF-8").alias("text"), F.explode("places").alias("place"))
        .select(
            "place.key",
            "place.many",
            "row",
            "id",
            "place.first",
            F.substring(
                "text", F.col("place.first") + 1, F.col("place.last") - F.col("place.first") + length
            ).alias("bytes"),
        )
    )
    if some:
        cut = materialise(cut, "suffix-variants")
    again = repeated(found).unionByName(compared(cut.filter(~F.col("many"))))
    if some:
        parts = met(cut.filter("many").mapInArrow(split, SPLIT), SPLIT, "suffix-split")
        left, more = crowded_apart(parts.filter(F.col("kind") == ANCHOR), "suffix-still-crowded")
        again = again.unionByName(repeated(parts)).unionByName(compared(left.filter(~F.col("many"))))
        if more:
            again = again.unionByName(crowded_repeats(left.filter("many"), length))
    marks = again.groupBy(F.col("row").alias("row_of")).agg(F.collect_list(F.struct("first", "last")).alias("marks"))
    return (
        rows.join(marks, F.col("row") == F.col("row_of"), "left")
        .select("id", "text", "marks")
        .mapInArrow(lambda batches: _without(batches, length), KEPT)
    )


KEPT = (
    "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<start:int,end:int>>, kept binary"
)


def _without(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The texts without the bytes that the marked strings cover."""
    for batch in (part for whole in batches for part in steps(whole, "text")):
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": [], "kept": []}
        for text, marks in zip(batch.column("text"), batch.column("marks")):
            data = text.as_buffer().to_pybytes()
            spans: list[list[int]] = []
            for mark in sorted((m["first"], m["last"]) for m in marks.as_py() or ()):
                start, end = mark[0], mark[1] + length
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([start, end])
            pieces, at = [], 0
            for start, end in spans:
                pieces.append(data[at:start])
                at = end
            kept = b"".join([*pieces, data[at:]])
            out["n_bytes"].append(len(data))
            out["n_removed"].append(len(data) - len(kept))
            out["n_spans"].append(len(spans))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["spans"].append([{"start": s, "end": e} for s, e in spans])
            out["kept"].append(kept)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
        columns = [pa.array(values, t) for values, t in zip(out.values(), types)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *out])
