"""Sets that share keys in small groups: what leaves the comparison, and that nothing is lost."""

import random

import pandas as pd

from panelkit.llm import ngram_join
from tests.llm.test_corpus import near_components


def rows_made(node) -> int:
    """Rows out of the Arrow functions of a plan that has run."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return rows_made(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return rows_made(node.plan())
    own = node.metrics().get("pythonNumRowsReceived").get().value() if kind.startswith("MapInArrow") else 0
    return own + sum(rows_made(node.children().apply(i)) for i in range(node.children().size()))


def sharing(m: int, copies: int = 0) -> dict[int, str]:
    """Texts that share a third of their words, and copies of some with one word changed."""
    draw = random.Random(m)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {i: f"{passage} " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(120)) for i in range(m)}
    return texts | {m + i: f"{texts[i]} w{i}" for i in range(copies)}


def test_sets_that_cannot_link_leave_no_pairs(spark, monkeypatch):
    made, store = [], ngram_join.materialise

    def watched(df, name, *more):
        if name == "ngram-pairs":
            df.collect()
            made.append(rows_made(df._jdf.queryExecution().executedPlan()))
        return store(df, name, *more)

    monkeypatch.setattr(ngram_join, "materialise", watched)
    for m in (12, 48):
        docs = spark.createDataFrame(list(sharing(m, 2).items()), "doc_id long, text string")
        rows = ngram_join.near_duplicates(docs).collect()
        assert {r.id: (r.n, r.component) for r in rows} == near_components(sharing(m, 2), 4, 85)
    assert made[1] <= 2 * made[0] <= 40, "as many as pairs that link, not all pairs of the 50"


def test_units_of_few_groups_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "UNIT", 3)
    draw = random.Random(8)
    texts = {}
    for i in range(8):
        base = [f"w{draw.randrange(900)}" for _ in range(80)]
        for j in range(12):
            words = list(base)
            for _ in range(draw.choice([0, 1, 2, 3])):
                words[draw.randrange(80)] = f"v{draw.randrange(40)}"
            texts[20 * i + j] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = ngram_join.near_duplicates(docs).collect()
    assert {r.id: (r.n, r.component) for r in rows} == near_components(texts, 4, 85)


def test_only_members_of_a_group_of_their_unit_are_paired():
    sketch = b"\0" * 16
    frame = pd.DataFrame(
        {
            "unit": [0, 0, 0, 0, 1, 1],
            "node": [1, 5, 7, 9, 2, 5],
            "n": [50, 50, 50, 80, 50, 50],
            "family": [-1, 3, 3, -1, -1, -1],
            "groups": [[10, 11], [10, 11, 12], [10, 12], [10], [13], [10]],
            "sketch": [sketch] * 6,
        }
    )
    assert ngram_join.likely_pairs(frame, 85).tolist() == [[1, 5], [1, 7]]
