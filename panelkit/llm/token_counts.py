"""Token counts with a public tokenizer; huge documents by overlapping chunks.

A document up to ``CHUNK`` code points is cut at places that no token can reach across (see below), and
each distinct piece is encoded once. A longer one is encoded in chunks
that overlap. Both encodings of an overlap give offsets, and the count goes over from one to the
next at their last common token boundary that is proven stable: a place between a character that
is no white space and white space. The pre-tokenizer's pattern (words with at most one leading
space, or runs of white space) never matches across such a place, and what it matches on either
side does not depend on the other, so both encodings agree with that of the whole document there.
An overlap without such a place is widened, up to the whole chunk, and then the chunk itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
CHUNK = 1 << 15
OVERLAP = 1 << 9
SLICE = 1 << 19  # code points encoded at once
KEPT = 400_000  # pieces whose counts a task remembers

# Stable places, see ``stable``: where white space is plain, pieces are found faster one by one.
SEVERED = re.compile(r"(?<=\S)(?=[ \t\n\r])")
OTHER_SPACE = re.compile(r"[^\S \t\n\r]")
WORD = re.compile(r"\s*\S+|\s+")

Ends = Callable[[str], np.ndarray]


def stable(text: str, place: int) -> bool:
    """Whether no token can reach across ``place``, whatever stands further away."""
    return text[place] in " \t\n\r" and not text[place - 1].isspace()


def count_in_chunks(text: str, ends_of: Ends, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of ``text``; ``ends_of`` gives the end offset of each token of a text."""
    size, total, lower, upper = chunk, 0, 0, min(chunk, len(text))
    ends = ends_of(text[:upper])
    while upper < len(text):
        wide, splice = overlap, None
        while splice is None:
            begin = max(lower, upper - wide)
            finish = min(len(text), upper + size)
            following = ends_of(text[begin:finish]) + begin
            common = np.intersect1d(ends, following)
            common = common[(common > begin) & (common < upper)]
            splice = next((int(p) for p in common[::-1] if stable(text, int(p))), None)
            if begin == lower:
                break
            wide *= 8
        if splice is None:  # nothing to hold on to in the whole chunk: a larger one instead
            size *= 2
        else:
            total += int(np.count_nonzero((ends > lower) & (ends <= splice)))
            lower = splice
        ends, upper = following, finish
    return total + int(np.count_nonzero(ends > lower))


def pieces_of(text: str) -> list[str]:
    """The text cut at its stable places: a word each, with the white space before it."""
    return SEVERED.split(text) if OTHER_SPACE.search(text) else WORD.findall(text)


class PieceCounts:
    """Tokens of texts as sums over their pieces; each distinct piece is encoded once.

    No token reaches across a stable place, and the pieces on either side are encoded as they are in
    the whole text. At most ``kept`` pieces and those of one slice are remembered.
    """

    def __init__(self, lengths: Callable[[list[str]], list[int]], kept: int = KEPT):
        self.lengths, self.kept = lengths, kept
        self.known: dict[str, int] = {}

    def of(self, texts: list[str]) -> list[int]:
        found = []
        for part in _slices(texts):
            pieces = [pieces_of(text) for text in part]
            new = list(set().union(*pieces).difference(self.known))
            self.known.update(zip(new, self.lengths(new)))
            found += [sum(map(self.known.__getitem__, own)) for own in pieces]
            if len(self.known) > self.kept:
                self.known.clear()
        return found


def _slices(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > SLICE:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def count_tokens(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str = TOKENIZER,
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row.

    Counts are those of the library's own encoding: no added tokens, special strings within texts
    as by its default, no truncation or padding. A null text counts as empty (0 tokens). Rows are
    counted each for itself, so repeated rows and ids do no harm; an empty table gives no rows;
    other columns are not read. ``tokenizer`` names a file of the public vocabularies.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        encoder.no_truncation()
        encoder.no_padding()

        def ends_of(text: str) -> np.ndarray:
            encoded = encoder.encode(text, add_special_tokens=False)
            return np.array([end for _, end in encoded.offsets], dtype=np.int64)

        def lengths(texts: list[str]) -> list[int]:
            return [len(encoded) for encoded in encoder.encode_batch_fast(texts, add_special_tokens=False)]

        pieces = PieceCounts(lengths)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            counts = np.zeros(len(texts), dtype=np.int64)
            short = [i for i, text in enumerate(texts) if len(text) <= chunk]
            counts[short] = pieces.of([texts[i] for i in short])
            for i, text in enumerate(texts):
                if len(text) > chunk:
                    counts[i] = count_in_chunks(text, ends_of, chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts)],
                names=["id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(F.octet_length(text_column).cast("long"), F.lit(0).cast("long")).alias("n_bytes"),
        F.col(text_column).alias("text"),
    )
    return rows.mapInArrow(counted, "id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
