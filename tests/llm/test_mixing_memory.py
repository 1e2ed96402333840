"""What a mixture sends through the driver: nothing that grows with the words of the input."""

from collections import Counter

import pytest

from panelkit.llm import source_mixing

ROWS = [(i, " ".join(f"w{i}x{j}" for j in range(700 + i)), "ab"[i % 2]) for i in range(40)]


def broadcast(node, inside: bool = False) -> list[str]:
    """Nodes of a plan that has run whose rows are broadcast before Spark has measured them in a shuffle."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return broadcast(node.executedPlan(), inside)
    if kind.endswith("QueryStageExec"):
        return broadcast(node.plan(), inside)
    inside = kind == "BroadcastExchangeExec" or inside and kind != "ShuffleExchangeExec"
    children = [node.children().apply(i) for i in range(node.children().size())]
    own = [kind] if inside and kind in ("MapInArrowExec", "GenerateExec") else []
    return own + [found for child in children for found in broadcast(child, inside)]


def run(df):
    """The rows, and the plan that has made them."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string")


@pytest.mark.parametrize("threshold", ["10m", "1k"])  # above and below the rows of the mixture, above its draws
def test_slots_and_pieces_are_not_broadcast(spark, docs, threshold):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        mixture = source_mixing.mix(docs)
        texts, plan = run(source_mixing.mixed_texts(docs, mixture, "doc_id", "text"))
        counts, counting = run(mixture.documents())
    finally:
        spark.conf.set(name, before)
    assert broadcast(plan) == broadcast(counting) == []
    taken = Counter()
    for r in texts:
        taken[r.doc_id] += len(r.text.split())
    assert taken == {r.id: r.taken for r in counts if r.taken}
    total = sum(len(text.split()) for _, text, _ in ROWS)
    assert abs(sum(taken.values()) - source_mixing.TOTAL * total) <= 4 * source_mixing.BLOCK


def test_the_driver_makes_no_draws(spark, docs, monkeypatch):
    expected = sorted(tuple(r) for r in source_mixing.mix(docs).draws.collect())
    assert expected

    def on_driver(*_):
        raise AssertionError("drawn on the driver")

    monkeypatch.setattr(source_mixing.np.random, "default_rng", on_driver)
    assert sorted(tuple(r) for r in source_mixing.mix(docs).draws.collect()) == expected


def test_draws_use_every_slot_once():
    slots = [9000, 0, 40, 1]
    met = {number: [] for number in range(len(slots))}
    for shard, number, first, n in source_mixing.shard_draws(slots):
        met[number].append((shard, first, n))
    for number, parts in met.items():
        assert parts == sorted(parts)
        assert sum(n for _, _, n in parts) == slots[number]
        assert [first for _, first, _ in parts] == [sum(n for _, _, n in parts[:i]) for i in range(len(parts))]
