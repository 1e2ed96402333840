"""Language identification with unigram pieces, all segmentations of a word summed.

The pieces are those of a fixed public vocabulary. Each language has its own probability for
every piece, learned by expectation maximisation from labelled documents: the expected number of
uses of a piece over all segmentations of the words. A text's likelihood is the product over its
words of the forward sum over all segmentations; the language with the largest one is predicted.
Words do not depend on each other, so each distinct word of a batch is summed once.

A word is a run of letters. Long runs, such as clauses of scripts without word spaces, are cut, and
each part counts as a word: for learning after ``LEARNED`` letters, for scores after ``LONGEST``.
Segmentations across a cut are not summed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import materialise

VOCABULARY = "piece_bpe_32k.model"
SAMPLE = 1600  # labelled documents per language that the model is learned from, at most
SALTS = 64  # the sample is drawn in so many parts, so that no language meets in one task
ROUNDS = 3
UNSEEN = 1e-7  # probability of a character without a piece
SMOOTHING = 0.05
LONGEST = 256  # a longer run of letters is scored in parts of this length
LEARNED = 40  # a longer run is learned from in parts of this length, whose sums need no scaling
UNDETERMINED = "und"
KEPT = 400_000  # words whose sums a task keeps

LETTERS = re.compile(r"[^\W\d_]+")
START = "▁"  # marks the start of a word in the vocabulary
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The letter pieces of the vocabulary, found by the hash of their characters."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        kept = {p for p in names if p == p.lower() and p.replace(START, "", 1).isalpha() or p == START}
        self.names = sorted(kept)
        self.longest = max(map(len, self.names))
        hashes = np.array([self._hash(p) for p in self.names], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for character in piece:
            value = (value * int(FACTOR) + ord(character)) & 0xFFFFFFFFFFFFFFFF
        return value

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece, or that after the last where there is none."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ids[at], len(self.names))

    def matches(self, words: list[str]) -> list[np.ndarray]:
        """For each piece length the piece that starts at each place of each word."""
        width = max(map(len, words)) + 1
        marked = "".join((START + w).ljust(width, "\0") for w in words)
        codes = np.frombuffer(marked.encode("utf-32-le"), dtype=np.uint32).reshape(len(words), width)
        codes = codes.astype(np.uint64)
        found, hashes = [], np.zeros_like(codes)
        for length in range(1, min(self.longest, width) + 1):
            hashes = hashes[:, : width - length + 1] * FACTOR + codes[:, length - 1 :]
            found.append(self.lookup(hashes))
        return found


def forward(found: list[np.ndarray], lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, over all segmentations.

    ``table`` has a row per piece and a last one of zeros. Sums are scaled every few places, so
    that long words do not vanish.
    """
    n, languages, width = len(lengths), table.shape[1], found[0].shape[1]
    reach = len(found)
    sums = np.zeros((n, width + 1, languages))
    sums[:, 0] = 1.0
    scale = np.zeros((n, languages))
    result = np.zeros((n, languages))
    for end in range(1, width + 1):
        total = np.zeros((n, languages))
        for length in range(1, min(reach, end) + 1):
            share = table[found[length - 1][:, end - length]]
            if length == 1:
                share = np.where(found[0][:, end - 1, None] == len(table) - 1, UNSEEN, share)
            total += sums[:, end - length] * share
        sums[:, end] = total
        over = lengths == end
        if over.any():
            result[over] = np.log(total[over]) + scale[over]
        if end % 16 == 0:
            window = sums[:, max(0, end - reach + 1) : end + 1]
            largest = window.max(axis=1)
            window /= largest[:, None]
            scale += np.log(largest)
    return result


def expected_uses(
    found: list[np.ndarray], lengths: np.ndarray, counts: np.ndarray, column: np.ndarray
) -> np.ndarray:
    """Expected uses of each piece over all segmentations of words that occur ``counts`` times."""
    n, width, reach, none = len(lengths), found[0].shape[1], len(found), len(column) - 1

    def share(start: int, length: int) -> np.ndarray:
        value = column[found[length - 1][:, start]]
        return np.where(found[0][:, start] == none, UNSEEN, value) if length == 1 else value

    ahead = np.zeros((n, width + 1))
    ahead[:, 0] = 1.0
    for end in range(1, width + 1):
        for length in range(1, min(reach, end) + 1):
            ahead[:, end] += ahead[:, end - length] * share(end - length, length)
    behind = np.zeros((n, width + 1))
    behind[np.arange(n), lengths] = 1.0
    for start in range(width - 1, -1, -1):
        for length in range(1, min(reach, width - start) + 1):
            behind[:, start] += share(start, length) * behind[:, start + length]
    whole = ahead[np.arange(n), lengths]
    weight = np.divide(counts, whole, out=np.zeros(n), where=whole > 0)
    uses = np.zeros(none + 1)
    for length in range(1, reach + 1):
        for start in range(width - length + 1):
            part = ahead[:, start] * share(start, length) * behind[:, start + length] * weight
            uses += np.bincount(found[length - 1][:, start], part, minlength=none + 1)
    return uses[:none]


def _by_width(words: list[str], letters: int = 300_000) -> Iterator[np.ndarray]:
    """Numbers of the words in blocks of similar length, of so many letters with their padding."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    begin = 0
    while begin < len(order):
        longest = max(8, 2 * lengths[order[begin]])
        some = begin + max(1, letters // longest)
        end = min(np.searchsorted(lengths[order], longest, side="right"), some)
        yield order[begin:end]
        begin = end


def letter_runs(text: str, longest: int = LONGEST) -> list[str]:
    runs = LETTERS.findall(text.lower())
    if max(map(len, runs), default=0) <= longest:
        return runs
    return [run[i : i + longest] for run in runs for i in range(0, len(run), longest)]


def labelled_sample(docs: DataFrame, id_column: str, text_column: str, lang_column: str) -> DataFrame:
    """lang, text of at most ``SAMPLE`` documents per language that are not held out.

    The smallest by hash in each of ``SALTS`` parts. Ids and languages are looked at first; the
    chosen ids, a bounded number, then pick the texts.
    """
    learned = docs.filter(F.col(lang_column).isNotNull() & ~held_out(id_column))
    place = F.xxhash64(id_column)
    part = Window.partitionBy("lang", "salt").orderBy("place", "id")
    chosen = (
        learned.select(
            F.col(lang_column).alias("lang"), F.col(id_column).alias("id"), place.alias("place")
        )
        .withColumn("salt", F.pmod(F.shiftright("place", 20), F.lit(SALTS)))
        .withColumn("n", F.row_number().over(part))
        .filter(F.col("n") <= SAMPLE // SALTS)
        .select(F.col("id").alias("__chosen"))
        .distinct()
    )
    return learned.join(
        F.broadcast(chosen), F.col(id_column) == F.col("__chosen"), "left_semi"
    ).select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))


def held_out(id_column: str):
    """A row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def word_counts(sample: DataFrame) -> DataFrame:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas().dropna()
            for lang, texts in frame.groupby("lang")["text"]:
                words = pd.Series([w for text in texts for w in letter_runs(text, LEARNED) if w.isalpha()])
                counts = words.value_counts()
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(counts), pa.string()),
                        "word": pa.array(list(counts.index), pa.string()),
                        "n": pa.array(counts.to_numpy(), pa.int64()),
                    }
                )

    counts = sample.mapInArrow(counted, "lang string, word string, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn(sample: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """The languages, and a table of piece probabilities with a column for each."""
    spark = sample.sparkSession
    counts = materialise(word_counts(sample), "language-words")
    languages = sorted(row["lang"] for row in counts.select("lang").distinct().collect())
    pieces = Pieces(vocabulary)
    size = len(pieces.names)
    table = np.vstack([np.full((size, len(languages)), 1.0 / size), np.zeros((1, len(languages)))])
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast((languages, table))

        def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, current = shared.value
            known = Pieces(vocabulary)
            sums = np.zeros((size, len(names)))
            for batch in batches:
                frame = batch.to_pandas()
                for lang, rows in frame.groupby("lang"):
                    column = names.index(lang)
                    words, n = rows["word"].tolist(), rows["n"].to_numpy(dtype=float)
                    for block in _by_width(words):
                        found = known.matches([words[i] for i in block])
                        lengths = np.array([len(words[i]) + 1 for i in block])
                        sums[:, column] += expected_uses(found, lengths, n[block], current[:, column])
            piece, lang = np.nonzero(sums)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array(lang, pa.int32()),
                    "piece": pa.array(piece, pa.int32()),
                    "uses": pa.array(sums[piece, lang], pa.float64()),
                }
            )

        summed = counts.mapInArrow(uses, "lang int, piece int, uses double").groupBy("lang", "piece")
        rows = summed.agg(F.sum("uses").alias("uses")).toPandas()  # pieces times languages at most
        table = np.zeros_like(table)
        table[rows["piece"], rows["lang"]] = rows["uses"]
        table[:size] += SMOOTHING
        table[:size] /= table[:size].sum(axis=0)
        shared.unpersist()
    return languages, table


def predict(
    docs: DataFrame,
    languages: list[str],
    table: np.ndarray,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """id, held_out, lang_pred, score of every row.

    ``score`` is the share of the predicted language in the likelihoods of all, each language
    being as probable before. A text that is null or has no letter, or a model without languages,
    gives ``und`` with score 0. Repeated rows are each scored; an empty table gives no rows;
    other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((languages, table))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, current = shared.value
        pieces = Pieces(vocabulary)
        cache: dict[str, np.ndarray] = {}

        def sums_of(words: list[str]) -> np.ndarray:
            new = [w for w in words if w not in cache]
            for block in _by_width(new):
                part = [new[i] for i in block]
                lengths = np.array([len(w) + 1 for w in part])
                cache.update(zip(part, forward(pieces.matches(part), lengths, current)))
            found = np.array([cache[w] for w in words])
            if len(cache) > KEPT:
                cache.clear()
            return found

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                runs = [letter_runs(text or "") for text in batch.column("text").to_pylist()]
                n = np.array([len(r) for r in runs])
                flat = np.array([w for r in runs for w in r], dtype=object)
                likely = np.zeros((len(runs), len(names)))
                lettered = np.zeros(len(runs), dtype=np.int64)
                if len(flat) and names:
                    codes, distinct = pd.factorize(flat)
                    real = np.array([any(map(str.isalpha, w)) for w in distinct])
                    sums = np.where(real[:, None], sums_of(list(distinct)), 0.0)
                    owner = np.repeat(np.arange(len(runs)), n)
                    for k in range(len(names)):
                        likely[:, k] = np.bincount(owner, sums[codes, k], minlength=len(runs))
                    lettered = np.bincount(owner, real[codes], minlength=len(runs))
                best = likely.argmax(axis=1) if names else np.zeros(len(runs), dtype=int)
                with np.errstate(over="ignore"):
                    top = likely.max(axis=1, initial=-np.inf)
                    share = 1 / np.exp(likely - top[:, None]).sum(axis=1) if names else lettered * 0.0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("held_out"),
                        pa.array([names[b] if m else UNDETERMINED for b, m in zip(best, lettered)], pa.string()),
                        pa.array(np.where(lettered > 0, share, 0.0)),
                    ],
                    names=["id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        held_out(id_column).alias("held_out"),
        F.col(text_column).alias("text"),
    )
    return rows.mapInArrow(scored, "id long, held_out boolean, lang_pred string, score double")


def identify(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """Learn from the labelled documents that are not held out, then predict all."""
    languages, table = learn(labelled_sample(docs, id_column, text_column, lang_column))
    return predict(docs, languages, table, id_column, text_column)
