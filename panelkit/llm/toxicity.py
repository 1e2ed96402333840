"""Toxicity by a lexicon that is met in spite of misspellings, and by the context of each hit.

A bounded sample of labelled documents gives the lexicon: words, and stems of words, that toxic
documents use far more often than others. Its terms form a trie. Levenshtein automata for the
terms, intersected with the trie, are one automaton whose states are sets of (trie node, errors);
it is made deterministic as far as the words of the corpus ask for it, and runs over all distinct
words of a batch at once. A hit is scored by its term and its errors, and by the window of words
around it: inside quotation marks or a quoted line it counts less, and words of report or of direct
address in the window are told apart. A logistic model, fitted on labelled documents that the lexicon
was not learned from, turns the hits of a document into a score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.hashing import shingles
from panelkit.session import materialise

TOXIC, CLEAN = 3_000, 6_000  # labelled documents of each kind that the model is learned from, at most
LEXICON = 400  # terms at most, the most telling ones
SHORTEST, LONGEST = 3, 14  # letters of a stem
FOUND_IN = 3  # toxic documents that must use a term
TELLING = 24.0  # least G-squared of a term
RATIO = 1.5  # least log ratio of its rates
WINDOW = 8  # words on either side of a hit
QUOTED = 0.25  # what a quoted hit counts
THRESHOLD = 0.3
KEPT = 400_000  # words whose hits a task remembers

WORDS = re.compile(r"[^\W_]+")
QUOTES = (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("‹", "›"))
# Words of direct address and of report in the languages of the corpus.
ADDRESS = frozenset("you your yours youre du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split())
REPORT = frozenset(
    "said says say called calls wrote writes quote quoted reported according sagte sagt nannte schrieb laut "
    "zitat dit disait écrit selon appelé citation dijo dice llamó escribió según cita".split()
)
FEATURES = ("best", "all", "density", "terms", "quoted", "address", "report")


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool  # whether words may go on after it
    weight: float

    @property
    def errors(self) -> int:
        """Edits allowed: short terms none, long ones two."""
        length = len(self.text) - self.stem  # a stem has no end that would confirm it
        return 0 if length < 5 else 1 if length < 9 else 2


@dataclass
class Automaton:
    """Levenshtein automata of all terms, intersected with their trie, determinised on demand."""

    terms: list[Term]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[list[int]] = field(default_factory=lambda: [[]])  # terms that end at a node
    slack: list[int] = field(default_factory=lambda: [0])  # most errors that a term below allows
    states: dict[tuple, int] = field(default_factory=dict)
    sets: list[tuple] = field(default_factory=list)

    def __post_init__(self) -> None:
        for number, term in enumerate(self.terms):
            node = 0
            self.slack[0] = max(self.slack[0], term.errors)
            for letter in term.text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.slack.append(0)
                node = self.children[node][letter]
                self.slack[node] = max(self.slack[node], term.errors)
            self.ends[node].append(number)
        letters = sorted({c for node in self.children for c in node})
        self.letters = ["", "", *letters]  # 0: no further letter, 1: a letter that no term has
        self.codes = np.array([ord(c) for c in letters], dtype=np.uint32)
        self.table = np.zeros((0, len(self.letters)), dtype=np.int32)
        self.inside: list[tuple[int, int]] = []  # best stem met in a state: (errors, term)
        self.whole: list[tuple[int, int]] = []  # best term met if the word ends there
        self._state({})  # no position left
        self.start = self._state({0: 0})

    def _state(self, positions: dict[int, int]) -> int:
        waiting = list(positions)
        while waiting:  # letters of a term that the word leaves out
            node = waiting.pop()
            for child in self.children[node].values():
                errors = positions[node] + 1
                if errors <= self.slack[child] and errors < positions.get(child, 9):
                    positions[child] = errors
                    waiting.append(child)
        key = tuple(sorted(positions.items()))
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            none = (9, -1)
            met = [(e, -len(self.terms[t].text), t) for node, e in key for t in self.ends[node] if e <= self.terms[t].errors]
            stems = [m for m in met if self.terms[m[2]].stem]
            self.inside.append((min(stems)[0], min(stems)[2]) if stems else none)
            self.whole.append((min(met)[0], min(met)[2]) if met else none)
            if len(self.sets) > len(self.table):
                more = np.full((max(64, len(self.table)), len(self.letters)), -1, dtype=np.int32)
                self.table = np.vstack([self.table, more])
        return self.states[key]

    def _next(self, state: int, letter: int) -> int:
        positions: dict[int, int] = {}

        def reach(node: int, errors: int) -> None:
            if errors <= self.slack[node] and errors < positions.get(node, 9):
                positions[node] = errors

        for node, errors in self.sets[state]:
            reach(node, errors + 1)  # a letter too many
            for own, child in self.children[node].items():
                reach(child, errors + (own != self.letters[letter]))
        return self._state(positions)

    def run(self, words: list[str]) -> list[tuple[int, int]]:
        """(errors, term) of the best term that each word meets; (9, -1) where there is none."""
        if not words or not self.terms:
            return [(9, -1)] * len(words)
        longest = max(len(t.text) + t.errors for t in self.terms) + 1  # a stem is met before that
        width = min(max(map(len, words)), longest)
        joined = "".join(w[:width].ljust(width, "\0") for w in words)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(words), width)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        classes = np.where(self.codes[at] == codes, at + 2, np.where(codes == 0, 0, 1))
        best: dict[int, tuple[int, int]] = {}
        alive, state = np.arange(len(words)), np.full(len(words), self.start)
        for place in range(width + 1):
            ended = np.ones(len(alive), bool) if place == width else classes[alive, place] == 0
            for some, outs in ((ended, self.whole), (~ended, self.inside)):
                chosen = np.flatnonzero(some)
                useful = np.array([out[1] >= 0 for out in outs])[state[chosen]]
                for i, s in zip(alive[chosen[useful]].tolist(), state[chosen[useful]].tolist()):
                    best[i] = min(outs[s], best.get(i, (9, -1)))
            alive, state = alive[~ended], state[~ended]
            if not len(alive):
                break
            letter = classes[alive, place]
            after = self.table[state, letter]
            while (missing := np.flatnonzero(after < 0)).size:
                for s, c in {(int(state[i]), int(letter[i])) for i in missing}:
                    self.table[s, c] = self._next(s, c)
                after = self.table[state, letter]
            alive, state = alive[after > 0], after[after > 0]
        return [best.get(i, (9, -1)) for i in range(len(words))]


def held_out(id_column: str) -> Column:
    """A row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """text, toxic, fits of at most ``TOXIC`` and ``CLEAN`` documents that are not held out.

    The first ids by hash, a bounded number, pick the texts; of documents with the same least
    five-word sequence, so of most near copies, one is taken. ``fits`` marks a quarter for the logistic model.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
    ids = [
        known.filter(F.col("toxic") == kind).select(F.col(id_column).alias("chosen"), "toxic").distinct()
        .orderBy(F.xxhash64("chosen"), "chosen").limit(most)
        for kind, most in ((1, TOXIC), (0, CLEAN))
    ]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.join(F.broadcast(ids[0].unionByName(ids[1])), F.col("id") == F.col("chosen"))
    part = F.pmod(F.xxhash64("id", F.lit(12)), F.lit(4))
    rows = rows.select("text", F.col("toxic").cast("int").alias("toxic"), (part == 0).alias("fits"))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, hashes = shingles(batch.column("text"), 5)
            least = np.zeros(batch.num_rows, dtype=np.int64)
            first = np.unique(owners, return_index=True)
            least[first[0]] = hashes[first[1]].view(np.int64)  # sorted, so the first is the least
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=[*batch.schema.names, "sketch"])

    found = rows.mapInArrow(sketched, "text string, toxic int, fits boolean, sketch long")
    return found.dropDuplicates(["sketch", "toxic"]).drop("sketch")


def term_counts(sample: DataFrame) -> DataFrame:
    """Per word (marked by a final space) and per stem: documents, and distinct words, of each kind."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs: dict[int, Counter] = {0: Counter(), 1: Counter()}
            words: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, kind in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                own = Counter()
                for word in set(WORDS.findall((text or "").lower())):
                    own[word[:256] + " "] += 1
                    own.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
                words[kind].update(own)
                docs[kind].update(own.keys())
            terms = sorted(words[0].keys() | words[1].keys())
            arrays = [pa.array(terms, pa.string())]
            arrays += [pa.array([c[k][t] for t in terms], pa.int64()) for c in (docs, words) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays(arrays, names=["term", "docs1", "docs0", "words1", "words0"])

    names = ["docs1", "docs0", "words1", "words0"]
    counts = sample.select("text", "toxic").mapInArrow(counted, "term string, " + ", ".join(f"{n} long" for n in names))
    return counts.groupBy("term").agg(*(F.sum(n).alias(n) for n in names))


def lexicon(sample: DataFrame) -> list[Term]:
    """The most telling words and stems; a stem is as long as all that share it agree, and stands
    for all words under it."""
    counts = materialise(term_counts(sample), "toxic-terms")
    ends = counts.filter(F.col("term").endswith(" ")).agg(F.sum("words1").alias("n1"), F.sum("words0").alias("n0")).first()
    n1, n0 = ends["n1"] or 0, ends["n0"] or 0
    if not n1 or not n0:
        return []
    share = n1 / (n1 + n0)
    total = F.col("words1") + F.col("words0")
    surprise = 2 * (
        F.col("words1") * F.log(F.col("words1") / (total * share))
        + F.when(F.col("words0") > 0, F.col("words0") * F.log(F.col("words0") / (total * (1 - share)))).otherwise(0.0)
    )
    ratio = F.log((F.col("words1") + 0.5) / (n1 + 1.0)) - F.log((F.col("words0") + 0.5) / (n0 + 1.0))
    telling = (
        counts.filter(F.col("docs1") >= FOUND_IN)
        .select("term", "docs1", "words1", surprise.alias("surprise"), ratio.alias("ratio"))
        .filter((F.col("surprise") >= TELLING) & (F.col("ratio") >= RATIO))
        .orderBy(F.desc("surprise"), "term")
        .limit(20 * LEXICON)
        .collect()
    )
    rows = {r["term"]: r for r in telling}
    loose = set()  # stems of which a longer one says as much, or half of it far more clearly
    for term, row in rows.items():
        for n in range(SHORTEST, len(term)):
            stem = rows.get(term[:n])
            if stem and (
                n == len(term) - 1 and row["docs1"] >= 0.95 * stem["docs1"]
                or row["ratio"] > stem["ratio"] + 1 and row["docs1"] >= 0.5 * stem["docs1"]
            ):
                loose.add(term[:n])
    kept: dict[str, Term] = {}
    for term in sorted(rows.keys() - loose, key=len):
        if not any(term[:n] in kept for n in range(SHORTEST, len(term))):
            kept[term] = Term(term.rstrip(" "), not term.endswith(" "), round(rows[term]["ratio"], 6))
    best = sorted(kept, key=lambda t: (-rows[t]["surprise"], t))[:LEXICON]
    return [kept[t] for t in sorted(best)]


def quoted(before: str, after: str) -> bool:
    """Whether a place between two pieces of text stands inside quotation marks or a quoted line."""
    if before.rsplit("\n", 1)[-1].lstrip().startswith(">"):
        return True
    for opening, closing in QUOTES:
        if opening == closing:
            if before.count(opening) % 2 and closing in after:
                return True
        elif before.rfind(opening) > before.rfind(closing) and closing in after:
            return True
    return False


def hit_features(text: str, hits: dict[str, tuple[int, int]], terms: list[Term]) -> list[float]:
    """``FEATURES`` of a lowered text in which the words ``hits`` meet (errors, term)."""
    places = [(m.start(), m.end()) for m in WORDS.finditer(text)]
    best = total = aside = address = report = 0.0
    seen, n = set(), 0
    for i, (start, end) in enumerate(places):
        hit = hits.get(text[start:end])
        if hit is None:
            continue
        first, last = places[max(0, i - WINDOW)][0], places[min(len(places) - 1, i + WINDOW)][1]
        line = text.rfind("\n", 0, start) + 1
        before = text[min(first, line) if start - line < 400 else first : start]
        inside = quoted(before, text[end : last + 2])
        near = {text[a:b] for a, b in places[max(0, i - WINDOW) : i + WINDOW + 1]}
        value = terms[hit[1]].weight * 0.6 ** hit[0] * (QUOTED if inside else 1.0)
        best, total, n = max(best, value), total + value, n + 1
        seen.add(hit[1])
        aside += inside
        address += bool(near & ADDRESS)
        report += bool(near & REPORT)
    if not n:
        return [0.0] * len(FEATURES)
    return [best, math.log1p(total), 10 * math.sqrt(n / len(places)), math.log1p(len(seen)), aside / n, address / n, report / n]


class Scanner:
    """Features of texts; remembers a bounded number of words."""

    def __init__(self, terms: list[Term]):
        self.terms, self.automaton = terms, Automaton(terms)
        self.hits: dict[str, tuple[int, int]] = {}
        self.seen: set[str] = set()

    def features(self, texts: list[str]) -> np.ndarray:
        lowered = [text.lower() for text in texts]
        words = [set(WORDS.findall(text)) for text in lowered]
        new = list(set().union(*words) - self.seen) if words else []
        for word, hit in zip(new, self.automaton.run(new)):
            if hit[1] >= 0:
                self.hits[word] = hit
        self.seen.update(new)
        found = np.zeros((len(texts), len(FEATURES)))
        for i, (text, own) in enumerate(zip(lowered, words)):
            met = {w: self.hits[w] for w in own & self.hits.keys()}
            if met:
                found[i] = hit_features(text, met, self.terms)
        if len(self.seen) > KEPT:
            self.seen, self.hits = set(), {}
        return found


def _slices(texts: list[str | None], size: int = 1 << 20) -> Iterator[list[str]]:
    ends = np.cumsum([len(text or "") for text in texts]).tolist()
    at = 0
    while at < len(texts):
        full = (ends[at - 1] if at else 0) + size
        end = max(at + 1, bisect_right(ends, full))
        yield [text or "" for text in texts[at:end]]
        at = end


def fitted(features: np.ndarray, toxic: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Weights of a logistic model with an intercept first, by Newton steps with a quadratic penalty."""
    x = np.hstack([np.ones((len(features), 1)), features])
    weights = np.zeros(x.shape[1])
    penalty = np.diag([1e-3] + [strength] * features.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - toxic) + penalty @ weights
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, slope)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[list[Term], np.ndarray]:
    """The lexicon, and the weights of the logistic model; empty weights without labels of both kinds."""
    sample = materialise(labelled_sample(docs, labels, id_column, text_column), "toxicity-sample")
    terms = lexicon(sample.filter("NOT fits"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms)
        for batch in batches:
            at = 0
            for texts in _slices(batch.column("text").to_pylist()):
                found = scanner.features(texts)
                arrays = [batch.column("toxic").slice(at, len(texts)), *(pa.array(column) for column in found.T)]
                yield pa.RecordBatch.from_arrays(arrays, names=["toxic", *FEATURES])
                at += len(texts)

    rows = sample.filter("fits").mapInArrow(described, "toxic int, " + ", ".join(f"{f} double" for f in FEATURES))
    frame = rows.toPandas().sort_values(["toxic", *FEATURES])  # the bounded sample; sums in one order
    if frame["toxic"].nunique() < 2:
        return terms, np.zeros(0)
    return terms, fitted(frame[list(FEATURES)].to_numpy(), frame["toxic"].to_numpy(dtype=float)).round(9)


def score(
    docs: DataFrame, terms: list[Term], weights: np.ndarray, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id, held_out, score, predicted of every row, see ``assess``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms)
        for batch in batches:
            at = 0
            for texts in _slices(batch.column("text").to_pylist()):
                found = scanner.features(texts)
                sums = weights[0] + found @ weights[1:] if len(weights) else np.full(len(texts), -30.0)
                values = 1 / (1 + np.exp(-np.clip(sums, -30, 30)))
                own = batch.slice(at, len(texts))
                arrays = [own.column("id"), own.column("held_out"), pa.array(values.round(9))]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "held_out", "score"])
                at += len(texts)

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        held_out(id_column).alias("held_out"),
        F.col(text_column).cast("string").alias("text"),
    )
    found = rows.mapInArrow(scored, "id long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def assess(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, held_out, score, predicted of every row.

    Learns from labelled documents that are not held out, then scores all. A null or empty text has
    no hits and gets the score of a text without any; so does every text if the labels tell nothing.
    Labels that are null, or of rows without an id or without a document, are left out. Repeated
    rows are scored each; an empty table gives no rows; other columns are not read.
    """
    terms, weights = learn(docs, labels, id_column, text_column)
    return score(docs, terms, weights, id_column, text_column)
