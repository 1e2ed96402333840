"""Hashes of words, word sequences and byte windows of whole Arrow columns, by array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
STEP = 1 << 20  # bytes of text looked at together
_RANDOM = np.random.default_rng(7)
VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
MIXERS = _RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(factor: int, n: int) -> np.ndarray:
    """factor**0 ... factor**(n-1) modulo 2**64."""
    known = _powers.get(factor)
    if known is None or len(known) < n:
        steps = np.full(1 << n.bit_length(), factor, dtype=np.uint64)
        steps[0] = 1
        known = _powers[factor] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums whose differences, see ``between``, hash any range of ``data``."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(VALUES[data] * powers(BASE, len(data)), out=sums[1:])
    return sums


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from ``start`` to ``end``, the same wherever they stand."""
    return (sums[end] - sums[start]) * powers(INVERSE, len(sums))[start]


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column one after the other, and where each text starts (and the end)."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, column: str, size: int = STEP) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, one text at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    ends = np.cumsum(lengths)
    begin = 0
    while begin < len(lengths):
        full = ends[begin] - lengths[begin] + size
        end = max(begin + 1, int(np.searchsorted(ends, full, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def shingles(texts: pa.Array, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct word sequences of each text, sorted.

    Words are runs of bytes that are no ASCII white space, A-Z in lower case. A text with fewer
    than ``n_words`` words has its whole sequence as one; without words it has none.
    """
    data, offsets = joined_bytes(texts)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.empty_like(word), np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    words = mixed(between(prefix_hash(_LOWER[data]), starts, ends))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    counts = np.bincount(owner, minlength=len(texts))
    last = len(words) - n_words + 1
    found, owners = [], []
    if last > 0:
        whole = owner[:last] == owner[n_words - 1 :]
        sums = sum(words[k : last + k] * MIXERS[k] for k in range(n_words))
        found.append(sums[whole])
        owners.append(owner[:last][whole])
    first = np.cumsum(counts) - counts
    for length in range(1, n_words):
        short = np.flatnonzero(counts == length)
        sums = sum((words[first[short] + k] * MIXERS[k] for k in range(length)), np.uint64(length))
        found.append(sums)
        owners.append(short)
    hashes, owners = mixed(np.concatenate(found)), np.concatenate(owners)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return owners[new], hashes[new]
