"""The stages of the pipeline on null, odd, repeated and clashing input, and on an empty table."""

import pytest
from pyspark.sql import functions as F

from panelkit.llm import stages

SMALL = "/root/testdata/sf0.001"
CLASHING = "__id __digest __n __of __text __content __copies __judged row id kept_id digest n content doc spans size".split()
LONG = " ".join(f"word{i}" for i in range(20_000))
ROWS = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (None, "some words without an id", "en", None),
    (4, "Some words  here", "en", "b"),
    (4, "Some words  here", "en", "b"),
    (5, "Some words here", "de", "b"),
    (6, LONG, "en", "a"),
    (7, LONG + " more", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    frame = frame.withColumn("n_chars", F.length("text").cast("long"))
    extra = {name: F.lit("x") for name in CLASHING} | {"tags": F.create_map(F.lit("k"), F.col("doc_id"))}
    return frame.withColumns(extra)


STAGES = {
    "quality": (stages.quality, set()),
    "exact": (stages.exact, {1, None, 4, 6, 7}),
    "near": (stages.near, {1, 2, None, 4, 6}),
    "mixing": (stages.mixing, None),
}


@pytest.mark.parametrize("name", STAGES)
def test_odd_rows_go_through(spark, docs, name):
    stage, expected = STAGES[name]
    given = stages.exact(spark, docs, SMALL) if name == "mixing" else docs
    found = stage(spark, given, SMALL)
    assert found.columns == docs.columns
    rows = found.collect()
    assert all(r[c] == "x" for r in rows for c in CLASHING)
    assert all(r.tags == {"k": r.doc_id} for r in rows)
    if expected is None:
        taken = {}
        for r in rows:
            taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
        size = {r[0]: len((r[1] or "").split()) for r in ROWS}
        assert taken.keys() <= size.keys() and all(n <= 2 * size[i] for i, n in taken.items())
    elif name == "quality":
        assert {r.doc_id for r in rows} <= {6, 7}
    else:
        ids = [r.doc_id for r in rows]
        assert set(ids) == expected
        assert ids.count(4) == (1 if name == "exact" else 2 if name == "near" and len(ids) > len(expected) else 1)
    assert stage(spark, given.limit(0), SMALL).count() == 0


def test_packing_of_odd_rows(spark, docs):
    found = stages.packed(spark, docs, SMALL)
    assert found.agg(F.sum("words")).first()[0] == sum(len((r[1] or "").split()) for r in ROWS)
    assert stages.packed(spark, docs.limit(0), SMALL).count() == 0
