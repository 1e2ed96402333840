"""Conversation repair, toxicity and resampling against brute-force versions, and on odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelkit.llm import conversation_repair, resampling, toxicity

FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CLASHING = "conv place id score weight rank key text_of part number range toxic_of chosen".split()


def cheapest(kinds):
    """(cost, audit) by trying all edits: each row kept, reroled or deleted, up to two insertions a gap."""
    legal = re.compile("(s?(ua)+)?$")
    found = []
    for inserted in itertools.product(["", "u", "a", "ua", "au"], repeat=len(kinds) + 1):
        choices = [
            [("D", "", 2)]
            + ([] if k[1] == "-" else [("K", k[0], 0)] + [("R", r, 1) for r in "ua"])
            for k in kinds
        ]
        for edits in itertools.product(*choices):
            roles = inserted[0] + "".join(e[1] + more for e, more in zip(edits, inserted[1:]))
            if legal.match(roles):
                audit = "I" * len(inserted[0]) + "".join(e[0] + "I" * len(m) for e, m in zip(edits, inserted[1:]))
                cost = sum(e[2] + 5 * (k[1] == "~" and e[0] != "D") for e, k in zip(edits, kinds))
                found.append((cost + 5 * audit.count("I"), audit))
    return min(found)


def test_cheapest_edits_of_all_short_conversations():
    grammar = conversation_repair.Grammar()
    kinds = [own + state for own in "sua." for state in "-+~"]
    draw = random.Random(2)
    for length in (0, 1, 2, 3):
        all_rows = list(itertools.product(kinds, repeat=length))
        for rows in draw.sample(all_rows, min(len(all_rows), 40)):
            best = grammar.accepted(grammar.parse(rows, grammar.initial()))
            assert best[:2] == cheapest(rows), rows


def repaired(rows):
    """Result columns of one conversation, straight through."""
    rows = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for t, r, x in rows))
    plain = [(t if has else None, r, x) for has, t, r, x in rows]
    kinds, facts = conversation_repair.examined(plain)
    grammar = conversation_repair.Grammar()
    best = grammar.accepted(grammar.parse(kinds, grammar.initial()))
    lines = "\n".join(conversation_repair.repaired_lines([(r, x) for _, r, x in plain], best[1], best[2]))
    seen, faults = set(), []
    for _, role, text in plain:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    turns = {t for t, _, _ in plain if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        illegal,
        best[0],
        best[1],
        hashlib.sha256(lines.encode()).hexdigest(),
    )


@pytest.mark.parametrize("size", [7, 20_000])
def test_conversation_over_many_ranges(spark, monkeypatch, size):
    monkeypatch.setattr(conversation_repair, "SEGMENT", size)
    draw = random.Random(4)
    pool = ["Yes.", "No!", "", None, "half a sen", "why?", "\t", "a\nb."]
    rows = [
        (conv, draw.choice([None, draw.randrange(400)]), draw.choice(["user", "assistant", "system", "tool", "", None]), draw.choice(pool))
        for conv, n in ((1, 700), (2, 3), (None, 40), (3, 1), *((i, draw.randrange(1, 9)) for i in range(10, 40)))
        for _ in range(n)
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = conversation_repair.repair(frame).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = {c: repaired([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert {r.conv: tuple(r[1:]) for r in found} == expected and len(found) == len(expected)


def test_damage_and_conversations_without_rows(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}: ".encode()) % 20 == 0)
    rows = [(gone, None, "user", "x."), (None, 5, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = conversation_repair.repair(conversation_repair.damaged(frame))
    found = {r.conv: r for r in conversation_repair.with_all(found, frame["conv_id"], frame).collect()}
    assert tuple(found[gone])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    fault = zlib.crc32(b" :5") % 20
    assert found[None].blank == (0 if fault == 0 else 2 if fault == 3 else 1) and found[None].audit in ("", "D", "DD")


def distance(term, word, stem):
    """Levenshtein distance of a term to the word, or to its nearest beginning."""
    row = list(range(len(word) + 1))
    for i, a in enumerate(term, 1):
        new = [i]
        for j, b in enumerate(word, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row) if stem else row[-1]


def test_automaton_finds_what_distances_find():
    draw = random.Random(6)
    terms = [
        toxicity.Term("".join(draw.choices("abcde", k=draw.randint(3, 11))), draw.random() < 0.4, 1.0) for _ in range(60)
    ]
    automaton = toxicity.Automaton(terms)
    words = ["".join(draw.choices("abcdef", k=draw.randint(1, 14))) for _ in range(1500)]
    for term in terms:
        for _ in range(20):
            word = list(term.text)
            for _ in range(draw.randrange(4)):
                at = draw.randrange(len(word) + 1)
                word[at : at + draw.randrange(2)] = draw.choice(["", "x", "a"])
            words.append("".join(word) + ("zz" if term.stem else "") or "q")
    words += ["ab" * 5_000, "é", "\U0001f600abc"]
    for word, (errors, number) in zip(words, automaton.run(words)):
        met = [distance(t.text, word, t.stem) for t in terms if distance(t.text, word, t.stem) <= t.errors]
        assert errors == min(met, default=9), word
        if met:
            assert distance(terms[number].text, word, terms[number].stem) == errors


def test_quotation_weighs_less_than_abuse():
    terms = [toxicity.Term("scoundrel", False, 5.0)]
    hits = {"scoundrel": (0, 0), "scoundrell": (1, 0)}
    abuse, quote, line, typo = (
        toxicity.hit_features(text, hits, terms)
        for text in (
            "you are a scoundrel and that is all",
            'the letter said "he is a scoundrel of note" and ended',
            "he wrote\n> what a scoundrel\nthat was all",
            "you are a scoundrell and that is all",
        )
    )
    names = toxicity.FEATURES
    assert abuse[0] == 5 and quote[0] == line[0] == 5 * toxicity.QUOTED and typo[0] == pytest.approx(3)
    assert [x[names.index("quoted")] for x in (abuse, quote, line)] == [0, 1, 1]
    assert abuse[names.index("address")] == 1 and quote[names.index("report")] == 1


def test_toxic_documents_are_found_with_misspellings(spark):
    draw = random.Random(1)
    plain = ["".join(draw.choices("aeioulnrst", k=draw.randint(2, 7))) for _ in range(300)]
    bad = ["vermin", "blockhead", "dimwit"]

    def text(words, extra):
        words = draw.choices(plain, k=words) + extra
        draw.shuffle(words)
        return " ".join(words)

    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        extra = draw.choices(bad, k=3) if toxic else []
        if toxic and i >= 600:
            extra = [w[:3] + "x" + w[4:] for w in extra]
        rows.append((i, text(draw.randint(20, 60), extra)))
        if i < 600:
            labels.append((i, int(toxic)))
    rows += [(1000, ""), (1001, None), (None, "vermin vermin"), (1, rows[1][1])]
    labels += [(5000, 1), (None, 1), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"'x' AS {c}" for c in CLASHING))
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.assess(docs, known).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    wrong = [r.id for r in found if r.id is not None and r.id < 900 and r.predicted != (r.id % 5 == 0)]
    assert len(wrong) < 15
    assert {r.predicted for r in found if r.id in (1000, 1001)} == {0}
    assert all(r.held_out == (r.id is not None and zlib.crc32(str(r.id).encode()) % 4 == 2) for r in found)
    assert toxicity.assess(docs.limit(0), known).count() == 0
    assert all(r.score < 1e-9 for r in toxicity.assess(docs.limit(9), known.limit(0)).collect())


def test_checksums_of_words_and_pairs():
    draw = random.Random(3)
    texts = ["", None, "a", "Ab c9 é日x", "x" * 5_000 + " tail " + "y" * 63 + " " + "z" * 64 + " " + "w" * 65]
    texts += ["".join(draw.choices("aB9 -é日", k=draw.randint(0, 300))) for _ in range(60)]
    found, owner, n_words = resampling.feature_buckets(pa.array(texts, pa.string()), 10_000)
    for i, text in enumerate(texts):
        words = re.findall(FEATURE_WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        features = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        assert n_words[i] == len(words)
        assert sorted(found[owner == i]) == sorted(zlib.crc32(f.encode()) % 10_000 for f in features)


def test_quickselect_cuts_exactly(spark):
    draw = random.Random(9)
    keys = [(draw.choice([1, 1, 1, draw.randrange(50)]), draw.randrange(30), i) for i in range(400)]
    rows = spark.createDataFrame(keys, "a long, b long, c long").repartition(5)
    for k in (0, 1, 57, 200, 400, 401):
        expected = sorted(keys)[k - 1] if 1 <= k <= len(keys) else None
        assert resampling.quickselect(rows, ["a", "b", "c"], k, pivots=3) == expected


def test_resampling_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, ""), (2, None), (None, long), (5, long), (5, long), (6, "short one"), (7, long + " " + "x" * 70_000)]
    rows += [(i, f"{long} doc{i % 3}") for i in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"'x' AS {c}" for c in CLASHING))
    target = spark.createDataFrame([("w1 w2 w3",), (None,)], "text string")
    found = resampling.resample(docs, target).collect()
    able = [r for r in found if r.n_features >= 39]
    assert len(found) == len(rows) and len(able) == len(rows) - 3
    ranks = sorted((r["rank"], -r.score, r.id is None, r.id or 0) for r in found if r["rank"] is not None)
    assert [r[0] for r in ranks] == list(range(1, 25 * len(able) // 100 + 1))
    assert [r[1:] for r in ranks] == sorted((-r.score, r.id is None, r.id or 0) for r in able)[: len(ranks)]
    for r in found:
        h = int(hashlib.sha256(f"7:{'' if r.id is None else r.id}".encode()).hexdigest()[:8], 16)
        assert r.score == r.weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
    assert {r.weight for r in found if r.n_features == 0} == {0}
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert np.all(resampling.gains(np.zeros(4, int), np.zeros(4, int)) == 0)
    assert resampling.resample(docs, target.limit(0)).count() == len(rows)


def test_token_counts_of_the_whole_table(spark):
    import duckdb
    import public_tokenizers
    from tokenizers import Tokenizer

    from panelkit.llm import queries, token_counts

    encoder = Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))
    folder = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    expected = {}
    for i, text in rows:
        n = len(encoder.encode(text or "", add_special_tokens=False).ids)
        expected[i] = (len((text or "").encode()), n, n > 1024)
    found = queries.op6_token_counts(spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found} == expected
    draw = random.Random(1)
    parts = ["a", " ", "\n", "  ", "é", "'s", "<|endoftext|>", "1", "日本", "!", "\x1c", "\xa0", "\x0b", "\x85", "　", "b"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(2_000)]
    counts = token_counts.PieceCounts(lambda t: [len(e) for e in encoder.encode_batch_fast(t, add_special_tokens=False)], 500)
    assert counts.of(texts) == [len(encoder.encode(t, add_special_tokens=False).ids) for t in texts]
