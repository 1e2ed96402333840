"""License scans: phrases in a row, and an exact set-similarity join with license templates.

A text belongs to a template when at least ``containment`` of the template's distinct words stand
in one window of its words, wherever lines break. A window is as wide as the template with so many
foreign words that the template still makes up ``containment`` of it. The word sequence is cut into
blocks that overlap so far that every window lies in one of them. Words of the templates are
ordered by their frequency in the whole corpus, rare ones first. A window that holds ``need`` of a
template's ``size`` words holds one of its first ``size - need + 1``: only these are indexed. A
block that shares an indexed word is kept when it has enough template words at all (length) and
enough can still follow the shared ones (position), and only then is the overlap counted in each
of its windows. No window that meets the threshold is lost.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import ascii_lower, once, whole_text

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value: what stands between words

#: Phrases and the labels they stand for.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Short notices as people write them; parameters of the scan.
TEMPLATES = (
    ("released under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without restriction",
        "mit",
    ),
    ("licensed under the apache license version 2", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution noncommercial license", "cc-by-nc"),
    ("licensed under a creative commons attribution sharealike license", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2"),
    ("this work is licensed under the gnu lesser general public license", "lgpl"),
    ("this work is licensed under the gnu affero general public license", "agpl"),
    ("subject to the terms of the mozilla public license version 2", "mpl-2"),
    (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "bsd",
    ),
)
CONTAINMENT = 0.8


def scan_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BREAKS), "")


def phrase_places(words: Column, phrase: str) -> Column:
    """Word numbers at which the phrase's words stand in a row."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        hit = words[i] == parts[0]
        for k, part in enumerate(parts[1:], 1):
            hit = hit & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return hit

    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
    everywhere = F.lit(True)
    for part in set(parts):
        everywhere = everywhere & F.array_contains(words, part)
    return F.when(everywhere, starts).otherwise(F.array().cast("array<int>"))


def phrases_found(words: Column, phrases: Sequence[tuple[str, str]]) -> Column:
    """Struct of n_words, n_base, first_word, last_word, base (labels)."""

    def summary(hits: Column) -> Column:
        places = F.flatten(hits)
        labels = F.array(*(F.when(F.size(hits[i]) > 0, label) for i, (_, label) in enumerate(phrases)))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.size(places).cast("long").alias("n_base"),
            F.array_min(places).cast("long").alias("first_word"),
            F.array_max(places).cast("long").alias("last_word"),
            F.sort_array(F.array_distinct(F.array_compact(labels))).alias("base"),
        )

    return once(F.array(*(phrase_places(words, phrase) for phrase, _ in phrases)), summary)


def _literal(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values))


def word_order(docs: DataFrame, text_column: str, vocabulary: Sequence[str]) -> list[str]:
    """The templates' words, those in the fewest documents first (one row per word is fetched)."""
    held = F.array_intersect(scan_words(whole_text(text_column)), _literal(vocabulary))
    counts = docs.select(F.explode_outer(held).alias("word")).groupBy("word").count()
    seen = {row["word"]: row["count"] for row in counts.collect()}
    return sorted(vocabulary, key=lambda word: (seen.get(word, 0), word))


def license_scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    ``score`` is the highest containment of a template that meets the threshold, 1 with a phrase,
    else 0. A null text counts as empty: no words, no labels. Repeated rows are scanned each for
    itself; an empty table gives no rows; other columns are not read. ``phrases`` and
    ``templates`` are short lists of the caller.
    """
    spark = docs.sparkSession
    sets = [sorted(set(words.split())) for words, _ in templates]
    order = word_order(docs, text_column, sorted(set().union(*sets)))
    rank = {word: i for i, word in enumerate(order)}
    index = []
    widths = [math.ceil(len(words.split()) / containment - 1e-9) for words, _ in templates]
    widest = max(widths, default=1)
    for number, (members, width, (_, label)) in enumerate(zip(sets, widths, templates)):
        members = sorted(members, key=rank.__getitem__)
        need = math.ceil(containment * len(members) - 1e-9)
        for at, word in enumerate(members[: len(members) - need + 1]):
            index.append((word, number, label, at, len(members), need, width, members))
    indexed = spark.createDataFrame(
        index,
        "word string, template int, label string, at int, size int, need int, width int, "
        "members array<string>",
    )
    starters = _literal(sorted({row[0] for row in index}, key=rank.__getitem__))

    def blocks(words: Column) -> Column:
        """Overlapping pieces of the words: each window of at most ``widest`` words is in one."""
        starts = F.sequence(F.lit(1), F.size(words), F.lit(widest))
        pieces = F.transform(starts, lambda i: F.slice(words, i, 2 * widest - 1))
        return F.filter(pieces, lambda piece: F.arrays_overlap(piece, starters))

    def most_held(words: Column) -> Column:
        """The most words of the template in one of the block's windows."""

        def held_from(i: Column) -> Column:
            return F.size(F.array_intersect(F.slice(words, i, F.col("width")), "members"))

        return F.array_max(F.transform(F.sequence(F.lit(1), F.size(words)), held_from))

    text = F.col("text")
    scanned = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("id"),
        whole_text(text_column).alias("text"),
    ).select(
        "row",
        "id",
        once(
            scan_words(text),
            lambda w: F.struct(
                phrases_found(w, phrases).alias("found"),
                F.when(F.arrays_overlap(w, starters), blocks(w)).alias("blocks"),
            ),
        ).alias("scan"),
    )
    held = scanned.select(
        "row", "id", "scan.found", F.explode_outer("scan.blocks").alias("words")
    ).withColumn("block", F.array_intersect(_literal(order), "words"))
    held = held.select("*", F.posexplode_outer("block").alias("place", "word"))
    before = F.least("at", "place")
    after = F.least(F.col("size") - F.col("at"), F.size("block") - F.col("place"))
    matched = held.join(F.broadcast(indexed), "word", "left")
    candidate = (F.size("block") >= F.col("need")) & (before + after >= F.col("need"))
    overlap = F.when(candidate, most_held(F.col("words")))
    share = once(overlap, lambda held: F.when(held >= F.col("need"), held / F.col("size")))
    per_row = (
        matched.select("row", "id", "found", "label", share.alias("share"))
        .groupBy("row")
        .agg(
            F.first("id").alias("id"),
            F.first("found").alias("found"),
            F.collect_set(F.when(F.col("share").isNotNull(), F.col("label"))).alias("more"),
            F.max("share").alias("share"),
        )
    )
    return per_row.select(
        "id",
        "found.n_words",
        "found.n_base",
        "found.first_word",
        "found.last_word",
        F.array_join("found.base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("found.base", "more")), ",").alias("labels"),
        F.when(F.col("found.n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
