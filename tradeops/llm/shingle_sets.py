"""Documents as sets of word shingles, coded so that numeric order puts rare shingles first."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory

CELLS = 1 << 16  # cells of the frequency sketch: what is collected and broadcast, whatever the corpus
CLASSES = 128  # hash classes of a signature
LONGEST = 1 << 20  # bytes of a text that are hashed at once

_LOW = np.uint64((1 << 48) - 1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)  # fixed value: multiplier of a well-known 64-bit finalizer
_SPACES = b" \t\n\x0b\x0c\r"
_IN_WORD = np.array([b not in _SPACES for b in range(256)], np.int8)
_BASE = 0x9E3779B97F4A7C15  # fixed value: an odd number without structure
_INVERSE = pow(_BASE, -1, 1 << 64)
_NUMBER = np.random.default_rng(64).integers(0, 1 << 64, 256, np.uint64)
_NUMBER[65:91] = _NUMBER[97:123]


def word_hashes(data: bytes, in_word: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of every word; words are split at space and the characters 9 to 13, A-Z are lower-cased.

    ``in_word`` names other bytes as parts of words (0 or 1 for each; the six separators are never).

    A word's hash is the sum of its characters' random numbers times powers of an odd base: a difference of two running
    sums, brought back to the word's own place by the base's inverse.
    """
    if len(data) > LONGEST:
        # Long texts go in parts that end between words.
        end = next((i for i in range(LONGEST, len(data)) if data[i] in _SPACES), len(data))
        if end < len(data):
            return np.concatenate([_hashes(data[:end], in_word), word_hashes(data[end:], in_word)])
    return _hashes(data, in_word)


def _hashes(data: bytes, in_word: np.ndarray | None) -> np.ndarray:
    chars = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(chars) + 2, np.int8)
    inside[1:-1] = (_IN_WORD if in_word is None else in_word)[chars]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    power, inverse = _powers(len(chars) + 1)
    sums = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(_NUMBER[chars] * power[: len(chars)], out=sums[1:])
    out = (sums[ends] - sums[starts]) * inverse[starts]
    out ^= (ends - starts).astype(np.uint64)
    out ^= out >> np.uint64(32)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def _powers(n: int, kept: list[np.ndarray] = []) -> list[np.ndarray]:  # noqa: B006
    """Powers of the base and of its inverse, at least ``n``; kept for the next text."""
    if not kept or len(kept[0]) < n:
        size = max(n, 1 << 16)
        kept[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, x, np.uint64))]) for x in (_BASE, _INVERSE)]
    return kept


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; of all its words, if there are fewer."""
    h = word_hashes((text or "").encode())
    if not len(h):
        return h
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = (out ^ h[i : len(h) - width + 1 + i]) * _MIX
        out ^= out >> np.uint64(32)
    return np.unique(out)


def cell_counts(texts: DataFrame, cells_of) -> np.ndarray:
    """How often each cell occurs in ``cells_of(text)`` over all rows of ``texts`` (one column, text).

    Every task sends at most ``CELLS`` sums, and that many numbers are collected.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            found = [cells_of(t) for t in batch.iloc[:, 0]]
            if found:
                total += np.bincount(np.concatenate(found), minlength=CELLS)
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cells, "n": total[cells]})
        release_memory()

    sums = texts.mapInPandas(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(CELLS, np.int64)
    total[sums["cell"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy(dtype=np.int64)
    return total


def frequency_ranks(texts: DataFrame, text: str, size: int) -> np.ndarray:
    """For each cell of the hash space its rank by how many shingles of the whole corpus fall into it.

    A shingle in many documents lifts its cell, so shingles in cells of low rank are rare. Ranks only order the work: any
    order gives the same result.
    """
    total = cell_counts(texts.select(text), lambda t: (shingles(t, size) >> np.uint64(48)).astype(np.int64))
    ranks = np.empty(CELLS, np.uint64)
    ranks[np.argsort(total, kind="stable")] = np.arange(CELLS, dtype=np.uint64)
    return ranks


def codes(text: str | None, size: int, ranks: np.ndarray) -> np.ndarray:
    """The shingle set, each hash with its cell number replaced by the cell's rank; sorted."""
    h = shingles(text, size)
    return np.sort(ranks[(h >> np.uint64(48)).astype(np.int64)] << np.uint64(48) | h & _LOW)


def set_key(coded: np.ndarray) -> bytes | None:
    """128 bits that name the set; none for the empty set."""
    return hashlib.blake2b(coded.tobytes(), digest_size=16).digest() if len(coded) else None


def signature(coded: np.ndarray) -> np.ndarray:
    """How many members each hash class has, up to 255: a map that brings no two sets further apart than they are."""
    counts = np.bincount((coded & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES)
    return np.minimum(counts, 255).astype(np.uint8)
