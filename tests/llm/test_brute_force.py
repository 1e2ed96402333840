"""Queries over a whole small table against plain versions of their contracts."""

import hashlib
import math
import re

import duckdb
import numpy as np
import pytest
import xxhash

from panelkit.llm import language_id, quality_rules, queries, source_mixing

SMALL = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def rows():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SMALL}/documents.parquet'").fetchall()


def passes_luhn(digits):
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for kind, pattern in kinds.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(part) <= 255 for part in m.group().split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and passes_luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                yield kind, m.start(), m.end()


def test_personal_data_base_spans(spark, rows):
    found = {r.doc_id: r for r in queries.op3_personal_data(spark, SMALL).collect()}
    assert len(found) == len(rows)
    for i, text, _ in rows:
        spans = list(base_spans(text or ""))
        joined = ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
        counts = [sum(kind == k for k, _, _ in spans) for kind in ("email", "ip", "card", "phone")]
        r = found[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans == joined or r.spans.startswith(joined)


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def hashed(*longs):
    """Hash of several longs, each with the hash of those before as its seed."""
    seed = 42
    for value in longs:
        seed = xxhash.xxh64_intdigest(int(value & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "little"), seed)
    return signed(seed)


def test_quality_scores(spark, rows):
    trusted = {
        i for (i,) in duckdb.sql(f"SELECT doc_id FROM '{SMALL}/labels.parquet' WHERE quality = 1").fetchall()
    }
    cells = {}
    for i, text, _ in rows:
        words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(WORD, text or "")]
        cells[i] = [w % 10_000 for w in words] + [hashed(a, b) % 10_000 for a, b in zip(words, words[1:])]
    raw, target = np.ones(10_000), np.ones(10_000)
    for i, own in cells.items():
        np.add.at(raw, own, 1)
        if i in trusted:
            np.add.at(target, own, 1)
    ratio = np.log(target / raw) + math.log(raw.sum()) - math.log(target.sum())
    for r in queries.op8_quality_rules(spark, SMALL).collect():
        own = cells[r.doc_id]
        score = ratio[own].mean() if own else 0.0
        assert r.score == pytest.approx(score, abs=1e-7)
        if abs(score - quality_rules.THRESHOLD) > 1e-6:
            assert r.kept == (not r.base_failed and score >= quality_rules.THRESHOLD)


def test_mixing_sizes_and_targets(spark, rows):
    size = {i: len(re.findall(WORD, text or "")) for i, text, _ in rows}
    total = {}
    for i, _, source in rows:
        total[source] = total.get(source, 0) + size[i]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    whole, capped, target = 1.5 * sum(total.values()), set(), {}
    while True:
        rest = whole - sum(2.0 * total[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: 2.0 * total[s] for s in capped}
        target |= {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if target[s] > 2.0 * total[s]}
        if not above:
            break
        capped |= above
    source = {i: s for i, _, s in rows}
    taken = {s: 0 for s in order}
    for r in queries.op9_source_mixing(spark, SMALL).collect():
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], total[s])
        assert r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= max(2 * source_mixing.BLOCK, 0.02 * target[s])


def test_language_scores_sum_all_segmentations(spark):
    words = {"aa": "lalo lala olal", "bb": "mimi imo momi"}
    sample = spark.createDataFrame([(k, v) for k, v in words.items() for _ in range(3)], "lang string, text string")
    languages, table = language_id.learn(sample)
    pieces = language_id.Pieces(language_id.VOCABULARY)
    number = {name: k for k, name in enumerate(pieces.names)}

    def likelihood(word, column):
        marked = language_id.START + word
        sums = [1.0] + [0.0] * len(marked)
        for end in range(1, len(marked) + 1):
            for begin in range(max(0, end - pieces.longest), end):
                piece = marked[begin:end]
                if piece in number:
                    sums[end] += sums[begin] * table[number[piece], column]
                elif len(piece) == 1:
                    sums[end] += sums[begin] * language_id.UNSEEN
        return math.log(sums[-1])

    texts = ["lalo mimi", "Momi!", "olal 12 lala mo", "12 !", None, "q lalolalo"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.id: r for r in language_id.predict(docs, languages, table).collect()}
    for i, text in enumerate(texts):
        runs = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not runs:
            assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
            continue
        sums = [sum(likelihood(w, k) for w in runs) for k in range(len(languages))]
        best = int(np.argmax(sums))
        assert found[i].lang_pred == languages[best]
        assert found[i].score == pytest.approx(1 / sum(math.exp(s - sums[best]) for s in sums), rel=1e-6)
