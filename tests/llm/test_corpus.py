"""Each corpus operator against a brute-force version, and on odd rows."""

import hashlib
import random
import re
import textwrap
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from panelkit.llm import (
    components,
    exact_dedup,
    language_id,
    license_scan,
    ngram_join,
    oracles,
    packing,
    personal_data,
    quality_rules,
    queries,
    source_mixing,
    suffix_dedup,
    token_counts,
)
from tests.support import connect, difference

SMALL = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
ODD = [
    (1, "", None, "other"),
    (2, None, "en", "other"),
    (None, "one two three four five", "en", None),
    (5, "one two  three four five", "fr", "a"),
    (6, "same text again", "de", "a"),
    (6, "same text again", "de", "a"),
    (7, "½ 12 !", "fr", "b"),
    (8, "x" * 50_000, "es", "b"),
    (9, "ab cd " * 9_000, "en", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = "row digest id kept content n key block".split()


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ODD, SCHEMA)
    return frame.withColumns({name: F.lit(name) for name in CLASHING})


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    return dict(rows)


def operators(spark):
    labels = spark.createDataFrame([(9, 1), (6, 0)], "doc_id long, quality int")
    trusted = quality_rules.trusted_documents(labels)
    return {
        "language": language_id.identify,
        "near": ngram_join.near_duplicates,
        "personal": personal_data.personal_spans,
        "suffix": suffix_dedup.remove_repeats,
        "exact": exact_dedup.exact_dedup,
        "tokens": token_counts.count_tokens,
        "quality": lambda docs: quality_rules.quality_rules(docs, trusted),
        "mixing": lambda docs: source_mixing.mix(docs).documents(),
        "licenses": license_scan.license_scan,
    }


def test_odd_rows_and_empty_tables(spark, odd):
    for name, operator in operators(spark).items():
        assert operator(odd).count() == len(ODD), name
        assert operator(odd.limit(0)).count() == 0, name
    assert packing.pack(odd).select("row").distinct().count() == len(ODD)
    assert packing.pack(odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_sql(spark, name):
    got = queries.queries()[name](spark, SMALL).toPandas()
    assert difference(got, connect(SMALL).sql(oracles.oracle_sql()[name]).df()) is None


def test_colliding_digests_are_taken_apart(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (3, "a")], "doc_id long, text string")
    found = exact_dedup.exact_dedup(rows, digest=lambda text: F.lit("same")).collect()
    assert sorted((r.id, r.keep_id, r.group_size) for r in found) == [
        (1, 1, 3), (2, 2, 1), (3, 1, 3), (3, 1, 3)
    ]
    assert sum(r.kept for r in found) == 2


def test_state_spans_feeds(spark, tmp_path):
    first = spark.createDataFrame([(5, "a b"), (6, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(2, "a  b"), (9, "c")], "doc_id long, text string")
    feed, state = str(tmp_path / "feed"), str(tmp_path / "state")
    for docs in (first, second):
        rows = exact_dedup.digest_feed(docs, "doc_id", "text", exact_dedup.sha256)
        rows.write.mode("append").parquet(feed)
        exact_dedup.update_state(rows, state, feed)
    known = exact_dedup.read_state(spark, state).collect()
    assert sorted((r.keep_id, r.group_size) for r in known) == [(2, 2), (6, 2)]


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def near_components(texts, n_words, percent):
    sets = {}
    for i, text in texts.items():
        w = re.findall(WORD, lowered(text))
        count = max(1, len(w) - n_words + 1)
        sets[i] = {tuple(w[j : j + n_words]) for j in range(count)} if w else set()
    name = {i: i for i in texts}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * max(1, len(sets[a] | sets[b])):
                x, y = sorted((root(a), root(b)))
                name[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_of_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 40)  # families of several blocks
    draw = random.Random(3)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(draw.choice([0, 1, 2, 3, 4, 6])):
            words[draw.randrange(len(words))] = f"v{draw.randrange(9000)}"
        texts[i] = " ".join(words)
    texts |= {200 + i: " ".join(f"u{draw.randrange(60)}" for _ in range(draw.randrange(12))) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for n_words, percent in ((4, 85), (5, 80)):
        rows = ngram_join.near_duplicates(docs, percent=percent, n_words=n_words).collect()
        assert {r.id: (r.n, r.component) for r in rows} == near_components(texts, n_words, percent)
        kept = ngram_join.keep_one(docs, percent=percent, n_words=n_words)
        assert kept.count() == len({c for _, c in near_components(texts, n_words, percent).values()})


def test_suffix_groups():
    draw = random.Random(5)
    for _ in range(100):
        n, length = draw.randint(1, 150), draw.choice([3, 8, 9, 20])
        data = bytes(draw.choice(b"ab") for _ in range(n))
        order, group = suffix_dedup.suffix_groups(np.frombuffer(data, np.uint8), length)
        keys = [(data + b"\0" * length)[i : i + length] for i in range(n)]
        assert [keys[i] for i in order] == sorted(keys)
        assert len(set(zip(keys, group))) == len(set(keys)) == len(set(group))


def test_repeats_against_brute_force(spark, texts):
    seen, expected = set(), {}
    for i, text in sorted(texts.items()):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        expected[i] = (len(data), sum(gone), hashlib.sha256(kept).hexdigest())
    rows = queries.op4_suffix_dedup(spark, SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in rows} == expected


def test_repeats_of_crowded_anchors(spark):
    draw = random.Random(8)
    line = "".join(draw.choices("abcdefgh", k=130))

    def noise(n):
        return "".join(draw.choices("ijklmnop", k=n))

    rows = [(i % 35 or None, noise(90) + line[i % 40 :] + noise(90)) for i in range(60)]
    rows += [(70 + i, rows[i][1][50:] + noise(9)) for i in range(5)] + [(80, line + noise(5) + line)]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, expected = set(), []
    for i in order:
        data = rows[i][1]
        gone = set()
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone |= set(range(p, p + 100))
            seen.add(data[p : p + 100])
        kept = "".join(c for p, c in enumerate(data) if p not in gone)
        expected.append((rows[i][0], len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    # batches of two texts: equal strings meet by their anchors only
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        found = suffix_dedup.remove_repeats(docs, crowded=10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(str, expected)) == sorted(str((r.id, r.n_removed, r.kept_sha256)) for r in found)


def test_long_documents_are_cut_into_shards(spark):
    size, draw = suffix_dedup.SHARD, random.Random(9)
    passage = "".join(draw.choices("abcdefgh", k=300))
    text = bytearray(draw.choices(b"ijklmnop", k=2 * size + 5_000))
    for at, edge in ((1_000, "1"), (size - 150, "2"), (2 * size + 50, "3")):
        text[at - 1 : at + 301] = (edge + passage + edge).encode()
    text = text.decode()
    batch = pa.RecordBatch.from_pylist([{"text": "short"}, {"text": text}, {"text": ""}])
    parts = [(part.column("text").to_pylist(), base) for part, base in suffix_dedup.shards(batch, 100)]
    assert [base for _, base in parts] == [0, 0, size, 2 * size, 0]
    assert max(sum(map(len, texts)) for texts, _ in parts) == size + 99
    docs = spark.createDataFrame([(1, text), (2, "x" + passage)], "doc_id long, text string")
    spans = {r.id: [tuple(s) for s in r.spans] for r in suffix_dedup.remove_repeats(docs).collect()}
    assert spans == {1: [(size - 150, size + 150), (2 * size + 50, 2 * size + 350)], 2: [(1, 301)]}


def test_quality_counts(spark, texts):
    rows = {r.doc_id: r for r in queries.op8_quality_rules(spark, SMALL).collect()}
    for i, text in texts.items():
        w = re.findall(WORD, text or "")
        windows = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        often = Counter(windows)
        covered = {j + k for j, x in enumerate(windows) if often[x] > 1 for k in range(3)}
        lines = [line for line in (text or "").split("\n") if re.search(WORD, line)]
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert r.n_symbols == sum((text or "").count(c) for c in "#*$%&|<>")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert r.kept == (not r.base_failed and r.score >= quality_rules.THRESHOLD)


def test_tokens_in_chunks():
    import public_tokenizers
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))

    def ends(text):
        encoded = encoder.encode(text, add_special_tokens=False)
        return np.array([e for _, e in encoded.offsets], dtype=np.int64)

    draw = random.Random(1)
    parts = ["a", " ", "\n", "  ", "é", "'s", "<|endoftext|>", "1", "日本", "!", "\x1c", " ", "b"]
    for _ in range(200):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(1, 200)))
        whole = len(encoder.encode(text, add_special_tokens=False).ids)
        assert token_counts.count_in_chunks(text, ends, 20, 4) == whole


def test_language_of_held_out_documents(spark):
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.01").toPandas()
    true = duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").df()
    held = rows.merge(true, on="doc_id").query("held_out")
    assert (held.lang_pred == held.lang).mean() > 0.95


def test_long_runs_of_letters_are_learned_from(spark):
    rows = [("aa", "abcde" * 12), ("bb", "vwxyz" * 12 + " vwxyz"), ("cc", "q" * 1_000)]
    sample = spark.createDataFrame(rows, "lang string, text string")
    counts = {(r.lang, r.word): r.n for r in language_id.word_counts(sample).collect()}
    assert counts == {
        ("aa", "abcde" * 8): 1,
        ("aa", "abcde" * 4): 1,
        ("bb", "vwxyz" * 8): 1,
        ("bb", "vwxyz" * 4): 1,
        ("bb", "vwxyz"): 1,
        ("cc", "q" * 40): 25,
    }
    languages, table = language_id.learn(sample)
    assert languages == ["aa", "bb", "cc"] and np.isfinite(table).all()
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = language_id.predict(docs, languages, table).collect()
    assert [r.lang_pred for r in sorted(found, key=lambda r: r.id)] == languages


def test_forward_sums_all_segmentations():
    found = [np.array([[0, 1, 2]]), np.array([[3, 4]]), np.array([[5]])]
    table = np.array([[0.1], [0.2], [0.3], [0.4], [0.5], [0.6], [0.0]])
    got = np.exp(language_id.forward(found, np.array([3]), table))[0, 0]
    assert got == pytest.approx(0.1 * 0.2 * 0.3 + 0.4 * 0.3 + 0.1 * 0.5 + 0.6)


def test_personal_data_patterns_and_terms(spark):
    texts = {
        1: "mail a@b.cd+x@e.fg, 1.2.3.4.5.6.7.8 and 999.1.1.1",
        2: "4111 1111 1111 1111 or 4111-1111-1111-1112, +1 (234) 567-8901.",
        10: "the zanzibar heiress writes from k@l.mn today",
        11: "a note: zanzibar heiress k@l.mn replied",
        **{i: "today the note from a writer replied" for i in range(20, 60)},
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.id: r.spans for r in personal_data.personal_spans(docs).collect()}
    cut = {i: [(s.kind, texts[i][s.start : s.end]) for s in spans] for i, spans in rows.items()}
    assert cut[1] == [(0, "a@b.cd"), (0, "+x@e.fg"), (1, "1.2.3.4"), (1, "5.6.7.8")]
    assert cut[2] == [(2, "4111 1111 1111 1111"), (3, "+1 (234) 567-8901")]
    assert cut[10] == [(0, "k@l.mn"), (4, "zanzibar"), (4, "heiress")]
    assert not cut[20]
    clean = {r.doc_id: r.text for r in personal_data.sanitised(docs.filter("doc_id < 20")).collect()}
    assert clean[1].startswith("mail [EMAIL][EMAIL], [IP].[IP] and 999")


def test_terms_of_whole_texts_give_entities_away(spark):
    far = "the note from a writer today " * 5
    rows = [
        (1, f"Heiress {far}x@y.zz, k@l.mn 1.2.3.4.5 {far} zanzibar, zanzibar {far}Наследница"),
        (2, f"наследница ZANZIBAR {far}k@l.mn, 4.5.6.7 {far} heiress"),
        (2, f"наследница ZANZIBAR {far}k@l.mn, 4.5.6.7 {far} heiress"),
        (3, "zanzibar alone"),
        *((i, far) for i in range(4, 60)),
    ]
    texts = dict(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = personal_data.personal_spans(docs).collect()
    cut = [(r.id, [texts[r.id][s.start : s.end].lower() for s in r.spans if s.kind == 4]) for r in found]
    expected = [re.findall("heiress|zanzibar|наследница", t.lower()) for _, t in rows]
    assert sorted(cut) == sorted((i, x if i < 3 else []) for (i, _), x in zip(rows, expected))
    share = {texts[r.id][s.start : s.end].lower(): s.disclosure for r in found for s in r.spans if s.kind == 4}
    n = len(rows)
    assert share["heiress"] == share["наследница"] == pytest.approx(1)
    assert share["zanzibar"] == pytest.approx(np.log2(n * 3 / (3 * 4)) / np.log2(n / 3))


def test_licenses_are_found_across_line_breaks(spark):
    mit, bsd = license_scan.TEMPLATES[1][0], license_scan.TEMPLATES[-1][0]
    foreign = [f"w{i}" for i in range(50)]
    random_ = random.Random(5)
    texts = {
        1: "# " + "\n# ".join(textwrap.wrap(mit, 60)),
        2: " * " + "\n * ".join(textwrap.wrap(bsd, 40)),
        3: " ".join(foreign).join(mit.split()),
        4: " ".join(foreign[:33] + mit.split() + foreign),
        5: "",
    }
    for i in range(10, 60):
        template = random_.choice(license_scan.TEMPLATES)[0].split()
        words = [w for w in template if random_.random() < 0.95]
        for _ in range(random_.randrange(9)):
            words.insert(random_.randrange(len(words) + 1), random_.choice(foreign + template))
        texts[i] = " ".join(foreign[: random_.randrange(40)]) + " " + "\n".join(words)
    expected = {}
    for i, text in texts.items():
        words = [w for w in re.split("[^a-z0-9]+", text) if w]
        labels = {label for phrase, label in license_scan.PHRASES if f" {phrase} " in f" {' '.join(words)} "}
        score = float(bool(labels))
        for template, label in license_scan.TEMPLATES:
            members, width = set(template.split()), -(-len(template.split()) * 5 // 4)
            share = max(len(members & set(words[k : k + width])) for k in range(len(words) + 1)) / len(members)
            if share >= license_scan.CONTAINMENT:
                labels, score = labels | {label}, max(score, share)
        expected[i] = (",".join(sorted(labels)), score)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.id: (r.labels, r.score) for r in license_scan.license_scan(docs).collect()}
    assert found == expected
    assert [found[i][0] for i in (1, 2, 3, 4)] == ["mit", "bsd", "", "mit"]


def test_mixing_meets_targets_and_reruns_agree(spark):
    rows = queries.op9_source_mixing(spark, SMALL).toPandas()
    again = queries.op9_source_mixing(spark, SMALL).toPandas()
    assert difference(rows, again) is None
    assert (rows.taken <= 2 * rows["size"]).all()
    source = duckdb.sql(f"SELECT doc_id, source FROM '{SMALL}/documents.parquet'").df()
    per_source = rows.merge(source, on="doc_id").groupby("source")
    assert (abs(per_source.taken.sum() / per_source.target.first() - 1) < 0.05).all()
    for n in (1, 2, 3, 17, 1000):
        assert sorted(source_mixing.permuted(np.arange(n), n, 5)) == list(range(n))


def test_packing_has_no_conflicts(spark):
    rows = packing.pack(spark.read.parquet(f"{SMALL}/documents.parquet")).toPandas()
    filled = rows.dropna(subset=["bin"]).groupby(["shard", "bin"])
    assert (filled.words.sum() + filled.free.first() == packing.CAPACITY).all()
    assert (filled.source.nunique() == filled.size()).all()


def test_best_fit_takes_the_tightest_compatible_bin():
    items = [(6, 1, 0), (5, 2, 1), (4, 1, 0), (4, 4, 1), (1, 8, 0)]
    assert packing.best_fit(items, 10)[0] == [0, 1, 1, 0, 1]


def test_pipeline(spark):
    """The kept documents and the packed words follow from the stages' brute-force versions."""
    import corpus_pipeline
    from panelkit.llm import stages

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = stages.quality(spark, docs, SMALL)
    kept = {r.doc_id for r in queries.op8_quality_rules(spark, SMALL).collect() if r.kept}
    assert {r.doc_id for r in good.select("doc_id").collect()} == kept
    single = stages.exact(spark, good, SMALL)
    first = defaultdict(list)
    for r in good.select("doc_id", "text").collect():
        first[re.sub(r"[\x20\x09-\x0D]+", " ", r.text)].append(r.doc_id)
    assert {r.doc_id for r in single.collect()} == {min(ids) for ids in first.values()}
    apart = stages.near(spark, single, SMALL)
    texts = {r.doc_id: r.text for r in single.collect()}
    assert {r.doc_id for r in apart.collect()} == {c for _, c in near_components(texts, 5, 80).values()}
    mixed = stages.mixing(spark, apart, SMALL)
    taken = source_mixing.mix(apart).documents().agg({"taken": "sum"}).first()[0]
    assert sum(len(re.findall(WORD, r.text)) for r in mixed.collect()) == taken
    assert mixed.columns == docs.columns
    packed = corpus_pipeline.run(spark, SMALL).toPandas()
    assert packed.words.sum() == taken


def test_components(spark):
    random_ = random.Random(4)
    links = [(random_.randrange(60), random_.randrange(60)) for _ in range(35)]
    links += [(i, i + 1) for i in range(100, 140)] + [(200, x) for x in range(201, 230)] + [(300, 300)]
    low = {x: x for pair in links if pair[0] != pair[1] for x in pair}
    for _ in low:
        for a, b in links:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == low and len(found) == len(low)
    assert components.components(spark.createDataFrame([], "a long, b long")).isEmpty()
