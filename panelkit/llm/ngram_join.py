"""Near duplicates: an exact self-join on the Jaccard similarity of word n-gram sets.

Prefixes. Put the n-grams (tokens) of all sets in one order, rare ones first. Of two sets that
meet the threshold, the first common token stands among the first ``n - need + 1`` tokens of
either one, the first k common tokens among the first ``n - need + k``. Where the first common
token is rare, both sets index it as a single token. Else all common tokens are frequent, and
single tokens would bring together far too many sets: the prefix is extended by ``k - 1`` tokens,
which are dealt by hash to ``k - 1`` classes, so that two of k common tokens fall into one class,
and all pairs of a class are indexed. The number of classes follows the smaller set's size class;
a set indexes the pairs for each size class in which a partner can lie.

Frequent tokens are those with a sufficient share in some stretch of the input, found in one
pass over all documents; the table is bounded, and the classes only steer the work: which tokens
are called frequent does not change the result.

Verification. Sets that meet under a key are first compared by size and by parity sketches, whose
distance never exceeds that of the sets, so that no pair is lost. Small groups are compared where
they are: of keys with the same members one counts, groups with the same first member meet in one
task, each member's sketch comes there once, and only pairs that pass leave it. Crowded keys mostly come
from one large family of copies and bring the same sets together again and again, so sets that crowded
keys connect are compared once, as a family, in blocks; small groups leave the pairs of one family to
that. Of a family's members those whose sketch passes with another one's are looked up in full, and the
blocks link them at once: every pair that passes and is not connected inside the task yet is verified
there, so that only a spanning forest of links leaves it. Verified are the full sets. Documents with equal
sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import SHINGLE_WORDS, whole_text
from panelkit.llm.components import components
from panelkit.llm.hashing import MIXERS, mixed, shingles, steps
from panelkit.session import materialise

PERCENT = 85
STRETCH = 1 << 22  # tokens counted together
SHARE = 1 << 19  # a token is frequent from one in so many tokens of a stretch
LEAST = 6  # and from so many occurrences
FREQUENT = 1 << 17  # frequent tokens at most: 1 MB of hashes
CLASS_WIDTH = 12  # size class divided by this: number of token classes
SMALL = 64  # members of a group whose pairs are compared outright
UNIT = 256  # small groups with the same first member that are compared together
ENTRIES = 1 << 18  # memberships in small groups whose pairs are held at once
BLOCK = 8192  # members of a family compared in one task
FAMILY = 16 * BLOCK  # larger families are compared key by key
TOKENS = 1 << 22  # tokens of sets that one set is compared with at once

SETS = "row long, id long, content long, n long, h1 long, h2 long, keys array<long>, sketch binary"
PAIRS = "a long, b long"
MEMBERS = "group long, i int, j int, block int, node long, n long, sketch binary"
MEMBER_TYPES = pa.schema(
    [("group", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("block", pa.int32())]
    + [("node", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())]
)
GROUP = ["group", "i", "j"]
PLACE = ["least", "part"]


def need(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-n * percent // 100)


def smallest_linked(percent: int) -> int:
    """Sets below this size link with equal sets only: one token apart is already too far."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


def frequent_tokens(docs: DataFrame, text_column: str, n_words: int) -> np.ndarray:
    """Hashes of the frequent tokens, the rarest first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def frequent() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            kept = counts >= max(LEAST, size // SHARE)
            return pa.RecordBatch.from_pydict(
                {"token": tokens[kept].view(np.int64), "n": counts[kept].astype(np.int64)}
            )

        for batch in batches:
            for part in steps(batch, "text"):
                held.append(shingles(part.column("text"), n_words)[1])
                size += len(held[-1])
                if size >= STRETCH:
                    yield frequent()
                    held, size = [], 0
        if size:
            yield frequent()

    counts = docs.select(F.col(text_column).alias("text")).mapInArrow(counted, "token long, n long")
    top = counts.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(FREQUENT)
    rows = top.toPandas()
    return rows.sort_values(["n", "token"])["token"].to_numpy(dtype=np.int64).view(np.uint64)


def sketch_bits(n: int) -> int:
    return max(64, 1 << int(2 * n - 1).bit_length())


def index_keys(tokens: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """Single tokens and token pairs under which a set is indexed.

    ``tokens`` are the set's hashes in order, ``rank`` their place among the frequent tokens or -1.
    """
    n = len(tokens)
    if n < smallest_linked(percent):
        return np.zeros(0, np.uint64)
    prefix = n - int(need(np.int64(n), percent)) + 1
    rare = tokens[rank < 0]
    if len(rare) >= prefix:
        return rare[:prefix]
    often = tokens[rank >= 0][np.argsort(rank[rank >= 0])]
    keys = [rare]
    least = int(need(np.int64(n), percent))
    for size_class in {least.bit_length() - 1, n.bit_length() - 1}:
        classes = max(1, (1 << size_class) // CLASS_WIDTH)
        reached = often[: max(0, prefix + classes - len(rare))]
        group = (reached >> np.uint64(40)) % np.uint64(classes)
        order = np.lexsort((reached, group))
        reached, group = reached[order], group[order]
        for apart in range(1, len(reached)):
            same = group[apart:] == group[:-apart]
            if not same.any():
                break
            first, second = reached[:-apart][same], reached[apart:][same]
            keys.append(mixed(first * MIXERS[8] + second * MIXERS[9] + np.uint64(size_class)))
    return np.unique(np.concatenate(keys))


def set_table(docs: DataFrame, id_column: str, text_column: str, percent: int, n_words: int) -> DataFrame:
    """One stored row per document: size and fingerprint of its set, index keys, parity sketch."""
    spark = docs.sparkSession
    frequent = frequent_tokens(docs, text_column, n_words)
    shared = spark.sparkContext.broadcast(frequent)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_hash = np.argsort(shared.value)
        known = shared.value[by_hash]
        for batch in batches:
            for part in steps(batch, "text"):
                owner, tokens = shingles(part.column("text"), n_words)
                at = np.minimum(np.searchsorted(known, tokens), max(0, len(known) - 1))
                hit = known[at] == tokens if len(known) else np.zeros(len(tokens), dtype=bool)
                rank = np.where(hit, by_hash[at] if len(known) else 0, -1)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                other = mixed(tokens + MIXERS[10])
                out = {"n": [], "h1": [], "h2": [], "keys": [], "sketch": []}
                for begin, end in zip(ends[:-1], ends[1:]):
                    own = tokens[begin:end]
                    bits = np.zeros(sketch_bits(max(1, len(own))), dtype=np.uint8)
                    np.bitwise_xor.at(bits, own & np.uint64(len(bits) - 1), 1)
                    out["n"].append(end - begin)
                    out["h1"].append(own.sum(dtype=np.uint64).astype(np.int64))
                    out["h2"].append(other[begin:end].sum(dtype=np.uint64).astype(np.int64))
                    out["keys"].append(index_keys(own, rank[begin:end], percent).view(np.int64))
                    out["sketch"].append(np.packbits(bits).tobytes())
                columns = [part.column(c) for c in ("row", "id", "content")]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                columns += [pa.array(v, t) for v, t in zip(out.values(), types)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "content", *out])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("id"),
        F.xxhash64(whole_text(text_column)).alias("content"),
        F.col(text_column).alias("text"),
    )
    return materialise(rows.mapInArrow(described, SETS), "ngram-sets")


class Sketches:
    """Sizes and parity sketches of some sets, to tell which pairs may meet the threshold."""

    def __init__(self, n: np.ndarray, sketches: list[bytes], percent: int):
        self.n, self.percent = n, percent
        self.words = np.array([len(s) // 8 for s in sketches], dtype=np.int64)
        self.bits, self.place = {}, {}
        for width in np.unique(self.words):
            # sizes that can link are less than a factor of two apart, and so are their sketches
            members = np.flatnonzero((self.words == width) | (self.words == 2 * width))
            bits = np.empty((len(members), width), dtype=np.uint64)
            for size in (width, 2 * width):
                own = np.flatnonzero(self.words[members] == size)
                wide = np.frombuffer(b"".join(sketches[members[i]] for i in own), dtype=np.uint64)
                folded = wide.reshape(len(own), size // width, width)
                bits[own] = np.bitwise_xor.reduce(folded, axis=1)
            self.place[width] = np.zeros(len(n), dtype=np.int64)
            self.place[width][members] = np.arange(len(members))
            self.bits[width] = bits

    def survive(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which of the pairs of members (left, right) pass."""
        n, percent = self.n, self.percent
        low, high = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
        fits = np.flatnonzero(100 * low >= percent * high)
        passed = np.zeros(len(left), dtype=bool)
        narrow = np.minimum(self.words[left[fits]], self.words[right[fits]])
        for width in np.unique(narrow):
            chosen, bits, place = fits[narrow == width], self.bits[width], self.place[width]
            for at in range(0, len(chosen), 1 << 16):
                some = chosen[at : at + (1 << 16)]
                x, y = left[some], right[some]
                apart = np.bitwise_count(bits[place[x]] ^ bits[place[y]]).sum(axis=1, dtype=np.int64)
                total = n[x] + n[y]
                # intersection = (total - distance) / 2, union = (total + distance) / 2
                passed[some] = 100 * (total - apart) >= percent * (total + apart)
        return passed


def partners(group: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """The rows that a row of a group is to be compared with: each pair of its two blocks, or its one, once."""
    block = group["block"].to_numpy()
    first, second = group["i"].iloc[0], group["j"].iloc[0]
    columns = np.flatnonzero(block == second)
    for row in np.flatnonzero(block == first):
        yield row, columns[columns > row] if first == second else columns


def near_rows(group: pd.DataFrame, percent: int) -> np.ndarray:
    """Which rows of a group may link with another one of it."""
    sketches = Sketches(group["n"].to_numpy(), list(group["sketch"]), percent)
    near = np.zeros(len(group), dtype=bool)
    for row, others in partners(group):
        others = others[~near[others]] if near[row] else others
        passed = others[sketches.survive(np.full(len(others), row), others)]
        near[passed] = True
        near[row] |= len(passed) > 0
    return near


def linked_rows(group: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links of a group's nodes, by their full sets: a spanning forest of all links between its blocks."""
    node, n = group["node"].to_numpy(), group["n"].to_numpy()
    sketches = Sketches(n, list(group["sketch"]), percent)
    known, tokens = np.unique(np.frombuffer(b"".join(group["tokens"]), dtype=np.uint64), return_inverse=True)
    tokens = tokens.astype(np.int32)
    ends = np.cumsum(n)
    held, label = np.zeros(len(known), dtype=bool), np.arange(len(node))
    pairs = []
    for row, others in partners(group):
        others = others[label[others] != label[row]]
        others = others[sketches.survive(np.full(len(others), row), others)]
        if not len(others):
            continue
        own = tokens[ends[row] - n[row] : ends[row]]
        held[own] = True
        for some in np.array_split(others, 1 + n[others].sum() // TOKENS):
            sets = np.concatenate([tokens[ends[x] - n[x] : ends[x]] for x in some])
            common = np.add.reduceat(held[sets].astype(np.int64), np.cumsum(n[some]) - n[some])
            found = some[100 * common >= percent * (n[row] + n[some] - common)]
            found = found[label[found] != label[row]]
            labels, one = np.unique(label[found], return_index=True)
            pairs += [(node[row], node[x]) for x in found[one]]
            label[np.isin(label, labels)] = label[row]
        held[own] = False
    return pairs


def likely_pairs(frame: pd.DataFrame, percent: int) -> np.ndarray:
    """Pairs that share a small group and may link, but for those of one family.

    ``frame`` has whole units, the members of each with the ``groups`` they are in; a set outside of
    families has -1 for its family.
    """
    node, n, family = (frame[c].to_numpy() for c in ("node", "n", "family"))
    held = list(frame["groups"])
    member = np.repeat(np.arange(len(node)), [len(g) for g in held])
    group, unit = np.concatenate(held), frame["unit"].to_numpy()[member]
    order = np.lexsort((member, group, unit))
    member, group, unit = member[order], group[order], unit[order]
    met = [np.zeros(0, np.int64)]
    for apart in range(1, len(member)):
        same = (group[apart:] == group[:-apart]) & (unit[apart:] == unit[:-apart])
        if not same.any():
            break
        x, y = member[:-apart][same], member[apart:][same]
        others = (family[x] != family[y]) | (family[x] < 0)
        met.append(np.unique(x[others] * len(node) + y[others]))
    left, right = np.divmod(np.unique(np.concatenate(met)), len(node))
    passed = Sketches(n, list(frame["sketch"]), percent).survive(left, right)
    pairs = np.stack([node[left[passed]], node[right[passed]]], axis=1)
    return np.unique(np.sort(pairs, axis=1), axis=0)


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of sorted rows in which no group is divided between two of them."""
    held = None
    for batch in batches:
        frame = batch.to_pandas()
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        last = (frame[by] == frame[by].iloc[-1]).all(axis=1).to_numpy() if len(frame) else []
        if len(frame):
            yield frame[~last]
            held = frame[last]
    if held is not None:
        yield held


def _as_pairs(pairs) -> pa.RecordBatch:
    pairs = np.asarray(pairs, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_pydict({"a": pairs[:, 0], "b": pairs[:, 1]})


def full_sets(
    docs: DataFrame, nodes: DataFrame, wanted: DataFrame, id_column: str, text_column: str, n_words: int
) -> DataFrame:
    """node, tokens of the ``wanted`` nodes, stored: their texts are looked up and hashed again."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                owner, tokens = shingles(part.column("text"), n_words)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                sets = [tokens[b:e].tobytes() for b, e in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(sets, pa.binary())], names=["node", "tokens"]
                )

    places = nodes.join(wanted, "node", "left_semi").select(
        "node", F.col("id").alias("node_id"), F.col("content").alias("node_content")
    )
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.xxhash64(whole_text(text_column)).alias("content"),
        F.col(text_column).alias("text"),
    )
    same = F.col("id").eqNullSafe(F.col("node_id")) & (F.col("content") == F.col("node_content"))
    texts = rows.join(places, same).select("node", "text")
    sets = texts.mapInArrow(hashed, "node long, tokens binary").dropDuplicates(["node"])
    return materialise(sets, "ngram-full-sets")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link: the sets come to the pairs."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("left"), batch.column("right"))
            found = [
                linked(*(np.frombuffer(side.as_buffer(), dtype=np.uint64) for side in pair), percent)
                for pair in both
            ]
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    with_left = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("left")), "a")
    with_both = with_left.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("right")), "b")
    return with_both.select("a", "b", "left", "right").mapInArrow(compared, PAIRS)


def linked_members(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the members of families: a set comes once to each pair of its family's blocks."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in _whole_groups(batches, GROUP):
            for _, group in frame.groupby(GROUP, sort=False):
                yield _as_pairs(linked_rows(group, percent))

    held = near.join(sets, "node").repartition(*GROUP).sortWithinPartitions(*GROUP, "node")
    return held.mapInArrow(compared, PAIRS)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = PERCENT,
    n_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """id, n (set size), component (smallest id reachable by links), first, content of every row.

    A text is the set of its distinct sequences of ``n_words`` words, or its whole sequence where
    it has fewer words. Two sets link when 100 times the size of their intersection reaches
    ``percent`` times that of their union. Texts that are null, empty or without words have an
    empty set and link with nothing. Equal sets link, so repeated rows do. A row without an id
    takes part, its component is named after the others' ids (null if there are none). An empty
    table gives no rows; other columns are not read. ``first`` marks one row of each component, that
    with the smallest id; ``content`` is a hash of the text.
    """
    rows = set_table(docs, id_column, text_column, percent, n_words)
    first = F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
    reps = rows.filter("n > 0").groupBy("h1", "h2", "n").agg(first).select(
        "h1", "h2", "n", F.col("first.row").alias("node"), F.col("first.id").alias("rep_id")
    )
    reps = materialise(reps, "ngram-nodes")
    nodes = materialise(
        rows.drop("sketch", "h1", "h2")
        .withColumnRenamed("row", "node")
        .join(reps.select("node"), "node", "left_semi"),
        "ngram-node-keys",
    )
    entries = nodes.select("node", "n", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = materialise(entries.join(shared, "key"), "ngram-groups")
    sketches = rows.select(F.col("row").alias("node"), "sketch")
    found = linked_components(docs, nodes, met, sketches, id_column, text_column, percent, n_words)
    named = found.join(reps.select("node", "rep_id"), "node")
    first = F.min(F.struct(F.col("rep_id").isNull(), "rep_id", "node")).alias("first")
    labels = named.join(named.groupBy("component").agg(first), "component").select("node", "first")
    members = rows.select("row", "id", "content", "h1", "h2", "n")
    labelled = members.join(reps, ["h1", "h2", "n"], "left").join(labels, "node", "left")
    alone = F.col("n") == 0
    return labelled.select(
        "id",
        "n",
        F.when(alone, F.col("id"))
        .otherwise(F.when(F.col("first").isNull(), F.col("rep_id")).otherwise(F.col("first.rep_id")))
        .alias("component"),
        (alone | (F.col("row") == F.coalesce("first.node", "node"))).alias("first"),
        "content",
    )


def family_members(met: DataFrame) -> DataFrame:
    """node, family, size: the sets that crowded keys connect, stored."""
    crowded = met.filter(F.col("members") > SMALL).select("key", "node")
    ties = crowded.join(crowded.groupBy("key").agg(F.min("node").alias("low")), "key")
    family = components(ties.select(F.col("low").alias("a"), F.col("node").alias("b")))
    family = family.withColumnRenamed("component", "family")
    sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    return materialise(family.join(sizes, "family"), "ngram-families")


def families(met: DataFrame, members: DataFrame, sketches: DataFrame) -> DataFrame:
    """group, i, j, block, node, n, sketch: the members of families by pairs of blocks."""
    crowded = met.filter(F.col("members") > SMALL).select("key", "node", "n", "members")
    whole = members.filter(F.col("size") <= FAMILY).select("node", F.col("family").alias("group"), "size")
    whole = whole.join(crowded.select("node", "n").distinct(), "node")
    by_key = crowded.join(members.filter(F.col("size") > FAMILY).select("node"), "node", "left_semi")
    groups = whole.select("group", "node", "n", "size").unionByName(
        by_key.select(F.col("key").alias("group"), "node", "n", F.col("members").alias("size"))
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    return (
        groups.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .join(sketches, "node")
        .select(
            "group",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "node",
            "n",
            "sketch",
        )
    )


def small_groups(met: DataFrame, own: DataFrame, sketches: DataFrame) -> DataFrame:
    """least, part, node, n, family, groups, sketch: members of small groups, by units of them.

    Keys with the same members are one group, groups within one family none. A unit has groups with
    the same least node, ``UNIT`` of them or about that. What comes to it is one sketch for each set
    that shares a key with that node.
    """
    few = met.filter(F.col("members") <= SMALL).join(own, "node", "left")
    family = F.coalesce("family", F.lit(-1))
    lists = few.groupBy("key").agg(
        F.sort_array(F.collect_list("node")).alias("nodes"),
        F.min(family).alias("low"),
        F.max(family).alias("high"),
    )
    groups = lists.filter("low < 0 OR low < high").select("nodes").distinct()
    groups = materialise(groups.withColumn("least", F.col("nodes")[0]), "ngram-small")
    parts = groups.groupBy("least").agg(F.ceil(F.count(F.lit(1)) / UNIT).cast("int").alias("parts"))
    place = F.xxhash64("nodes")
    members = (
        groups.join(parts, "least")
        .select("least", F.pmod(place, "parts").cast("int").alias("part"), place.alias("place"), F.explode("nodes").alias("node"))
        .groupBy(*PLACE, "node")
        .agg(F.collect_list("place").alias("groups"))
    )
    return members.join(sketches, "node").join(own.withColumnRenamed("node", "of_family"), F.col("node") == F.col("of_family"), "left").select(
        *PLACE, "node", "n", family.alias("family"), "groups", "sketch"
    )


def linked_components(
    docs: DataFrame,
    nodes: DataFrame,
    met: DataFrame,
    sketches: DataFrame,
    id_column: str,
    text_column: str,
    percent: int,
    n_words: int,
) -> DataFrame:
    """node, component of whatever is linked, by all links of small groups and a forest of those of families."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in _whole_groups(batches, PLACE):
            if not len(frame):
                continue
            changes = (frame[PLACE] != frame[PLACE].shift()).any(axis=1).to_numpy()
            unit = np.cumsum(changes) - 1
            entries = frame["groups"].map(len).to_numpy()
            before = (np.cumsum(entries) - entries)[changes][unit]  # the same for a whole unit
            for _, some in frame.assign(unit=unit).groupby(before // ENTRIES, sort=False):
                yield _as_pairs(likely_pairs(some, percent))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in _whole_groups(batches, GROUP):
            for _, group in frame.groupby(GROUP, sort=False):
                rows = group[near_rows(group, percent)]
                yield pa.RecordBatch.from_pandas(rows, schema=MEMBER_TYPES, preserve_index=False)

    members = family_members(met)
    own = members.filter(F.col("size") <= FAMILY).select("node", "family")
    sized = sketches.join(nodes.select("node", "n"), "node")
    small = small_groups(met, own, sized)
    pairs = small.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(listed, PAIRS).distinct()
    pairs = materialise(pairs, "ngram-pairs")
    crowded = families(met, members, sketches).repartition(*GROUP).sortWithinPartitions(*GROUP, "node")
    crowded = materialise(crowded.mapInArrow(near, MEMBERS), "ngram-crowded")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowded.select("node"))
    sets = full_sets(docs, nodes, wanted, id_column, text_column, n_words)
    links = linked_pairs(pairs, sets, percent).unionByName(linked_members(crowded, sets, percent))
    return components(links)


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents that stay: one row of each component, with the smallest id, and its columns.

    A null text counts as empty; rows without words are linked with nothing and all stay, and an
    empty table stays empty. Of rows that share id and text the first by their other columns stay
    (columns that have no order, such as maps, are not looked at). Rows travel as one struct, so
    columns may have any names.
    """
    stays = (
        near_duplicates(docs, id_column, text_column, **options)
        .filter("first")
        .groupBy(F.col("id").alias("kept_id"), F.col("content").alias("kept_content"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    ordered = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_column).cast("long").alias("id"),
        F.xxhash64(whole_text(text_column)).alias("content"),
    )
    met = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("content") == F.col("kept_content"))
    alike = Window.partitionBy("id", "content").orderBy(*(F.col("row").getField(c) for c in ordered))
    kept = rows.join(stays, met).withColumn("n", F.row_number().over(alike))
    return kept.filter("n <= copies").select("row.*")
