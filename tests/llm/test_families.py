"""Families of sets that crowded keys connect: linked at once, in their blocks."""

import random

import numpy as np
import pandas as pd

from panelkit.llm import ngram_join
from tests.llm.test_corpus import near_components


def close_texts(m: int) -> dict[int, str]:
    """Texts around one, about as far from each other as the threshold."""
    draw = random.Random(m)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]
    texts = {}
    for i in range(m):
        words = list(base)
        for _ in range(draw.choice([1, 2, 3, 4])):
            words[draw.randrange(len(words))] = f"v{draw.randrange(9000)}"
        texts[i] = " ".join(words)
    return texts


def test_full_sets_are_fetched_once(spark, monkeypatch):
    stored, store = [], ngram_join.materialise

    def watched(df, name, *more):
        stored.append(name)
        return store(df, name, *more)

    monkeypatch.setattr(ngram_join, "materialise", watched)
    monkeypatch.setattr(ngram_join, "BLOCK", 40)
    texts = close_texts(140) | {1000 + i: text for i, text in close_texts(12).items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = ngram_join.near_duplicates(docs).collect()
    assert {r.id: (r.n, r.component) for r in rows} == near_components(texts, 4, 85)
    assert len(set(stored)) == len(stored), "no rounds, however many pairs are close to the threshold"


def test_links_of_two_blocks_are_a_forest(monkeypatch):
    monkeypatch.setattr(ngram_join, "TOKENS", 500)
    draw = np.random.default_rng(1)
    base = draw.integers(0, 1 << 62, 100, dtype=np.uint64)
    rows = []
    for k in range(30):
        tokens = np.unique(np.concatenate([base[draw.integers(0, 9) :], draw.integers(0, 1 << 62, 5, dtype=np.uint64)]))
        bits = np.zeros(ngram_join.sketch_bits(len(tokens)), dtype=np.uint8)
        np.bitwise_xor.at(bits, tokens & np.uint64(len(bits) - 1), 1)
        rows.append((9, 0, 1, k % 2, 100 + k, len(tokens), np.packbits(bits).tobytes(), tokens.tobytes()))
    names = ["group", "i", "j", "block", "node", "n", "sketch", "tokens"]
    for same in (False, True):
        group = pd.DataFrame(rows, columns=names)
        if same:
            group[["j", "block"]] = 0
        sets = {r.node: set(np.frombuffer(r.tokens, np.uint64).tolist()) for r in group.itertuples()}
        block = dict(zip(group["node"], group["block"]))
        met = [
            (a, b)
            for a in sets
            for b in sets
            if a < b and (same or block[a] != block[b]) and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
        ]
        assert 0 < len(met) < 30 * 29 // 2
        near = ngram_join.near_rows(group, 90)
        assert {x for pair in met for x in pair} <= set(group["node"][near])
        found = [tuple(sorted(map(int, p))) for p in ngram_join.linked_rows(group[near], 90)]
        assert set(found) <= set(met)
        assert merged(met) == merged(found) and len(found) == sum(len(c) - 1 for c in merged(met))


def merged(pairs) -> set[frozenset]:
    parts: list[set] = []
    for pair in pairs:
        hit = [p for p in parts if p & set(pair)]
        parts = [p for p in parts if p not in hit] + [set(pair).union(*hit)]
    return {frozenset(p) for p in parts}
