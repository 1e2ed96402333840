"""Quality rules: counts of words, symbols and repetition, and an n-gram likelihood ratio.

Every word and every pair of neighbouring words is hashed into one of ``buckets`` cells. The
cells of all documents give the raw multinomial, the cells of the trusted documents the target
one. A document's score is the mean, over its n-grams, of the log ratio of the two smoothed
probabilities; documents below the threshold are rejected. The table of weights has a fixed
number of cells and travels as a literal, so scoring needs no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import once, whole_text, words

SYMBOLS = "#*$%&|<>"  # fixed value
MIN_WORDS = 50  # fixed value
BUCKETS = 10_000
TRUSTED = 20_000  # documents that the target multinomial is learned from, at most
SCANNED = 32  # so many repeated windows are looked up one by one, more by sorting
THRESHOLD = -0.05  # mean log ratio per n-gram


def repeated_words(hashes: Column) -> Column:
    """Words in three-word windows found at least twice, from the array of word hashes.

    Windows with an equal one are found by sorting; each of them covers its three words, less
    what the next such window covers too.
    """
    windows = F.when(
        F.size(hashes) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 3),
            lambda i: F.xxhash64(hashes[i], hashes[i + 1], hashes[i + 2]),
        ),
    )

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.size(places) - 1),
            F.lit(0).cast("long"),
            lambda total, i: total
            + F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - places[i], F.lit(3))),
        )

    def few(w: Column, twice: Column) -> Column:
        everywhere = F.sequence(F.lit(0), F.size(w) - 1)
        return F.filter(everywhere, lambda i: F.array_contains(twice, w[i]))

    def many(w: Column) -> Column:
        by_content = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("at"))))
        found = once(
            by_content,
            lambda s: F.filter(
                s,
                lambda x, i: F.coalesce(x["w"] == F.get(s, i - 1)["w"], F.lit(False))
                | F.coalesce(x["w"] == F.get(s, i + 1)["w"], F.lit(False)),
            ),
        )
        return F.sort_array(F.transform(found, lambda x: x["at"]))

    def count(w: Column) -> Column:
        twice = once(
            F.sort_array(w), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i + 1)))
        )
        return once(
            twice,
            lambda t: F.when(F.size(t) == 0, F.lit(0).cast("long"))
            .when(F.size(t) <= SCANNED, once(few(w, t), covered))
            .otherwise(once(many(w), covered)),
        )

    return once(windows, count)


def cells(hashes: Column, buckets: int) -> Column:
    """The cells of all words, and of all pairs of neighbouring words."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(hashes) - 1),
        lambda i: F.pmod(F.xxhash64(hashes[i - 1], hashes[i]), F.lit(buckets)),
    )
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)))
    return F.when(F.size(hashes) >= 2, F.concat(single, pairs)).otherwise(single)


def word_hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def judgement(text: Column, ratio: Column, buckets: int, threshold: float) -> Column:
    """Struct of the base counts, the score, and both verdicts."""

    def judged(found: Column, hashes: Column) -> Column:
        symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
        counts = F.struct(
            F.size(hashes).cast("long").alias("n_words"),
            F.length(F.array_join(found, "")).cast("long").alias("word_chars"),
            F.when(text.rlike(f"[{SYMBOLS}]"), symbols).otherwise(0).cast("long").alias("n_symbols"),
            duplicate_lines(text).cast("long").alias("n_dup_lines"),
            F.coalesce(repeated_words(hashes), F.lit(0)).cast("long").alias("n_repeat_words"),
            once(cells(hashes, buckets), mean_ratio).alias("score"),
        )
        return once(counts, verdict)

    def mean_ratio(found: Column) -> Column:
        total = F.aggregate(found, F.lit(0.0), lambda sum_, cell: sum_ + ratio[cell.cast("int")])
        return F.when(F.size(found) > 0, total / F.size(found)).otherwise(0.0)

    def verdict(c: Column) -> Column:
        failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")
        return F.struct(
            *(c[name].alias(name) for name in names),
            failed.alias("base_failed"),
            (~failed & (c["score"] >= threshold)).alias("kept"),
        )

    return once(words(text), lambda w: once(word_hashes(w), lambda h: judged(w, h)))


def weights(
    docs: DataFrame, trusted: DataFrame, id_column: str, text_column: str, buckets: int
) -> list[float]:
    """Log ratio of target to raw probability of each cell, both smoothed by one count."""
    ids = trusted.select(F.col(id_column).alias("__id"), F.lit(1).alias("trusted")).distinct()
    rows = docs.select(F.col(id_column).alias("__id"), whole_text(text_column).alias("text"))
    found = rows.join(F.broadcast(ids), "__id", "left").select(
        F.coalesce("trusted", F.lit(0)).alias("trusted"),
        # outer: for a plain explode the optimizer would compute all cells twice
        F.explode_outer(once(word_hashes(words(F.col("text"))), lambda h: cells(h, buckets))).alias("cell"),
    )
    counts = found.groupBy("cell").agg(
        F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target")
    )
    raw, target = [1] * buckets, [1] * buckets
    for row in counts.collect():  # one row per cell
        if row["cell"] is not None:
            raw[row["cell"]] += row["raw"]
            target[row["cell"]] += row["target"]
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [round(math.log(t / r) + shift, 9) for t, r in zip(target, raw)]


def trusted_documents(labels: DataFrame, id_column: str = "doc_id", limit: int = TRUSTED) -> DataFrame:
    """At most ``limit`` documents of good quality, the first by hash: the bounded labelled sample."""
    ids = labels.filter("quality = 1").select(id_column).distinct()
    return ids.orderBy(F.xxhash64(id_column), id_column).limit(limit)


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """id, base counts, base_failed, score and kept of every document.

    ``trusted`` must be bounded (see ``trusted_documents``); without a trusted document the ratio
    is that of the smoothing alone. A null or empty text has no words, score 0, and fails the
    base rules. Rows without an id, and repeated rows, are judged like others; other columns are
    not read.
    """
    return with_judgement(docs, trusted, id_column, text_column, buckets, threshold).select(
        F.col(id_column).alias("id"), "__judged.*"
    )


def with_judgement(
    docs: DataFrame,
    trusted: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents with the struct ``__judged``: the counts, ``score`` and ``kept``."""
    table = weights(docs, trusted, id_column, text_column, buckets)
    ratio = F.from_json(F.lit(str(table)), "array<double>")
    return docs.withColumn(
        "__judged", once(whole_text(text_column), lambda t: judgement(t, ratio, buckets, threshold))
    )


def kept_documents(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that pass the rules, with all their columns, which may have any names.

    A null or empty text fails the base rules; repeated rows are judged alike; an empty table stays empty.
    """
    ratio = F.from_json(F.lit(str(weights(docs, trusted, id_column, text_column, BUCKETS))), "array<double>")
    judged = once(whole_text(text_column), lambda t: judgement(t, ratio, BUCKETS, THRESHOLD))
    rows = docs.select(F.struct("*").alias("row"), judged.alias("judged"))
    return rows.filter("judged.kept").select("row.*")
