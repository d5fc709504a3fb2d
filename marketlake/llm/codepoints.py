"""Texts of an Arrow batch as one code-point array, and vectorised words over it."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTER_UPPER, LETTER, DIGIT, SPACE, OTHER = range(5)
SLICE_BYTES = 1_000_000  # of text at a time: some 100 bytes of arrays for each
PIECE_BYTES = 250_000  # where no sum over a slice goes out, so that smaller ones cost nothing


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of the code points below 65,536."""
    kind, low = np.full(65536, OTHER, np.uint8), np.arange(65536, dtype=np.uint32)
    for c in range(65536):
        ch = chr(c)
        cat = unicodedata.category(ch)
        if ch.isspace():
            kind[c] = SPACE
        elif cat in ("Lu", "Lt"):
            kind[c] = LETTER_UPPER
        elif cat[0] in "LM":
            kind[c] = LETTER
        elif cat[0] == "N":
            kind[c] = DIGIT
        small = ch.lower()
        if len(small) == 1:
            low[c] = ord(small)
    return kind, low


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` with about ``size`` bytes of text, whole rows always."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


class Texts:
    """``cp``: all code points; document i is ``cp[at[i]:at[i + 1]]`` (null: empty)."""

    def __init__(self, column: pa.Array):
        texts = pc.fill_null(column, "").to_pylist()
        self.n = len(texts)
        self.at = np.zeros(self.n + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=self.at[1:])
        self.cp = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.at))

    def kinds(self) -> np.ndarray:
        return tables()[0][np.minimum(self.cp, 65535)]

    def lowered(self) -> np.ndarray:
        return np.where(self.cp < 65536, tables()[1][np.minimum(self.cp, 65535)], self.cp)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First index and end of the maximal runs of ``inside``; none spans two documents."""
        if not len(self.cp):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.zeros(len(self.cp) + 1, bool)
        first[self.at] = True  # a document's first code point begins a run anew
        before = np.concatenate(([False], inside[:-1]))
        start = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.concatenate((inside[1:], [False]))
        end = np.flatnonzero(inside & (~after | first[1:])) + 1
        return start, end


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (the public SplitMix64 constants)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(cp: np.ndarray, start: np.ndarray, end: np.ndarray, most: tuple[int | None, ...] = (None,)) -> list[np.ndarray]:
    """Hashes of runs of code points; with ``most`` = m, of their first m only."""
    if not len(start):
        return [np.zeros(0, np.uint64) for _ in most]
    size = end - start
    held = np.zeros(int(size.sum()), np.int64)  # code points of all runs, one after another
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(len(held)) - np.repeat(first, size)
    held = cp[np.repeat(start, size) + place].astype(np.uint64)
    value = mixed(held + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return [mixed(np.add.reduceat(value if m is None else np.where(place < m, value, np.uint64(0)), first)) for m in most]


def sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n)
