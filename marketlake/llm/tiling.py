"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits.  Seeds are runs of
``min_match`` words that a document and a benchmark item share (all words of a
shorter item); documents meet the items by a join on the seeds' rolling hashes.
For each (document, item) that shares seeds, the longest common unmarked match
is found by running Karp-Rabin hashes over a falling match length and marked in
both, again and again, until none of ``min_match`` words is left; passages in
another order are caught since tiles may lie anywhere.  An item whose words
are marked to ``coverage`` or more is found in the document.

The benchmark is a stated query set.  It is cut into blocks of about
``block_bytes`` of text; every document meets every block, a block is broadcast
and the documents are never shuffled.

Cases: null and empty texts share nothing; items without words are never found;
repeated documents are found alike, repeated items each; ties between matches of
one length go to the earliest place in the item, then in the document; an empty
benchmark finds nothing and keeps all; other columns pass unchanged in ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import codepoints as C
from .common import map_arrow

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, for hashes mod 2 ** 64


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and word hashes of the texts."""
    t = C.Texts(column)
    kind = t.kinds()
    start, end = t.runs((kind == C.LETTER_UPPER) | (kind == C.LETTER) | (kind == C.DIGIT))
    doc = t.doc[start] if len(start) else np.zeros(0, np.int64)
    return np.searchsorted(doc, np.arange(t.n + 1)), C.run_hashes(t.lowered(), start, end)[0]


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of k words."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    h = words[:len(words) - k + 1].copy()
    for j in range(1, k):
        h = h * BASE + words[j:len(words) - k + 1 + j]
    return h


class _Windows:
    """Window hashes of any length from prefix hashes: H[i + s] - H[i] * BASE ** s."""

    def __init__(self, words: np.ndarray):
        self.words, self.prefix = words, np.zeros(len(words) + 1, np.uint64)
        h = 0
        for i, w in enumerate(words.tolist()):
            h = (h * int(BASE) + w) & 0xFFFFFFFFFFFFFFFF
            self.prefix[i + 1] = h
        self.marked = np.zeros(len(words), bool)

    def free(self, s: int) -> np.ndarray:
        """Starts of windows of s words without a mark."""
        if s > len(self.words):
            return np.zeros(0, np.int64)
        taken = np.concatenate(([0], np.cumsum(self.marked)))
        return np.flatnonzero(taken[s:] == taken[:-s])

    def hashes(self, at: np.ndarray, s: int) -> np.ndarray:
        return self.prefix[at + s] - self.prefix[at] * np.uint64(pow(int(BASE), s, 1 << 64))


def tile(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in doc, words), longest first."""
    a, b, tiles = _Windows(item), _Windows(doc), []
    most = min(len(item), len(doc))

    def common(s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        i, j = a.free(s), b.free(s)
        x, y = a.hashes(i, s), b.hashes(j, s)
        return i[np.isin(x, y)], x[np.isin(x, y)], j[np.isin(y, x)], y[np.isin(y, x)]

    while most >= min_match:
        low, high = min_match - 1, most  # a common match of `low` words is known, longer than `high` is none
        while low < high:
            s = (low + high + 1) // 2
            low, high = (s, high) if len(common(s)[0]) else (low, s - 1)
        most = low
        if most < min_match:
            break
        i, x, j, y = common(most)
        places: dict[int, list[int]] = {}
        for h, at in zip(y.tolist()[::-1], j.tolist()[::-1]):
            places.setdefault(h, []).append(at)  # the last is the earliest
        for h, at in zip(x.tolist(), i.tolist()):
            if a.marked[at:at + most].any():
                continue
            while places[h]:
                there = places[h].pop()
                if not b.marked[there:there + most].any():
                    a.marked[at:at + most] = b.marked[there:there + most] = True
                    tiles.append((at, there, most))
                    break
    return tiles


class Block:
    """Benchmark items of one block, with their seeds sorted by hash."""

    def __init__(self, ids: list, texts: list, min_match: int):
        at, words = words_of(pa.array(texts, pa.string()))
        self.ids, self.min_match = ids, min_match
        self.items = [words[at[i]:at[i + 1]] for i in range(len(ids))]
        self.seeds = {}
        for k in sorted({min(min_match, len(w)) for w in self.items} - {0}):
            own = [i for i, w in enumerate(self.items) if min(min_match, len(w)) == k]
            each = [np.unique(rolling(self.items[i], k)) for i in own]
            h, item = np.concatenate(each), np.repeat(own, [len(e) for e in each])
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << 20, bool)
            bits[h >> np.uint64(44)] = True  # most windows of a document end here
            self.seeds[k] = (h[order], item[order], bits)

    def findings(self, column: pa.Array, coverage: float) -> list[tuple[int, int, int, int, list]]:
        """(row, item, words of the item, words marked, tiles) of the texts in ``column``."""
        at, words = words_of(column)
        found = []
        for k, (seed, item, bits) in self.seeds.items():
            h = rolling(words, k)
            place = np.flatnonzero(bits[h >> np.uint64(44)])
            left, right = np.searchsorted(seed, h[place], "left"), np.searchsorted(seed, h[place], "right")
            place, left, right = place[right > left], left[right > left], right[right > left]
            row = np.searchsorted(at, place, "right") - 1
            inside = place + k <= at[row + 1]
            place, left, right, row = place[inside], left[inside], right[inside], row[inside]
            n = right - left
            if not len(n):
                continue
            whose = item[np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            row, place = np.repeat(row, n), np.repeat(place, n)
            order = np.lexsort((place, whose, row))
            row, whose, place = row[order], whose[order], place[order]
            cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(whose) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(row)]):
                own = self.items[whose[a]]
                spots = place[a:b]
                # words of the document that a tile can hold: those below its seeds, in runs
                new = np.concatenate(([True], spots[1:] > spots[:-1] + k))
                first, last = spots[new], spots[np.concatenate((new[1:], [True]))] + k
                if (last - first).sum() < coverage * len(own):
                    continue
                parts, origin = [], []
                for u, (f, e) in enumerate(zip(first.tolist(), last.tolist())):
                    parts += [words[f:e], np.array([C.mixed(np.array([u + 1]))[0]], np.uint64)]  # a word that no item has
                    origin += [*range(f, e), -1]
                tiles = tile(own, np.concatenate(parts), k)
                marked = sum(t[2] for t in tiles)
                if marked >= coverage * len(own):
                    base = int(at[row[a]])
                    found.append((int(row[a]), int(whose[a]), len(own), marked,
                                  [(int(p), origin[q] - base, int(s)) for p, q, s in tiles]))
        return found


def blocks(benchmark: DataFrame, min_match: int, block_bytes: int) -> Iterator[Block]:
    """The benchmark in blocks, dealt by a hash of the item; each is read by itself."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for i in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text").collect()
        if own:
            yield Block([r["item_id"] for r in own], [r["text"] for r in own], min_match)


FOUND = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("item_words", T.IntegerType()), T.StructField("marked_words", T.IntegerType()),
    T.StructField("coverage", T.DoubleType()),
    T.StructField("tiles", T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("item_at", "doc_at", "words")])))])


def find(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.6, min_match: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, item_words, marked_words, coverage, tiles."""
    spark, schema = docs.sparkSession, T.StructType([docs.schema["doc_id"], *FOUND.fields])
    out = None
    for block in blocks(benchmark, min_match, block_bytes):
        held = spark.sparkContext.broadcast(block.__dict__)

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            own = Block.__new__(Block)
            own.__dict__ = held.value
            kinds = pa.list_(pa.struct([(n, pa.int32()) for n in ("item_at", "doc_at", "words")]))
            for batch in batches:
                for part in C.slices(batch, "text", C.PIECE_BYTES):
                    got = own.findings(part.column("text"), coverage)
                    if got:
                        yield pa.RecordBatch.from_arrays([
                            part.column("doc_id").take(pa.array([g[0] for g in got])), pa.array([own.ids[g[1]] for g in got], pa.int64()),
                            pa.array([g[2] for g in got], pa.int32()), pa.array([g[3] for g in got], pa.int32()),
                            pa.array([g[3] / g[2] for g in got], pa.float64()),
                            pa.array([[dict(zip(("item_at", "doc_at", "words"), t)) for t in g[4]] for g in got], kinds)],
                            names=["doc_id", "item_id", "item_words", "marked_words", "coverage", "tiles"])

        part = map_arrow(docs.select("doc_id", "text"), search, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.select("doc_id").limit(0).select("doc_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in FOUND])


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.6, min_match: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` without the rows in which an item is found."""
    spark = docs.sparkSession
    for block in blocks(benchmark, min_match, block_bytes):
        held = spark.sparkContext.broadcast(block.__dict__)

        def stay(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            own = Block.__new__(Block)
            own.__dict__ = held.value
            for batch in batches:
                for part in C.slices(batch, "text", C.PIECE_BYTES):
                    ok = np.ones(part.num_rows, bool)
                    ok[[g[0] for g in own.findings(part.column("text"), coverage)]] = False
                    yield part.filter(pa.array(ok))

        docs = map_arrow(docs, stay, docs.schema)
    return docs
