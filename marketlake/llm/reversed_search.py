"""Ranked lexical search, reversed: the documents stream past the queries.

The items are the stated query set.  In blocks of about ``block_bytes`` their
terms become an inverted index (term -> items), which is broadcast; each
document's term counts stream through it, and every task keeps a bounded heap of
``k`` documents for each item.  The heaps are merged by item.  Documents are
never shuffled.

Texts are read once: a first pass over all of them writes, for each document,
its number of terms and the counts of those of its terms that some item holds,
and counts documents, terms and document frequencies.

A term's weight is floor(1000 * ln((2N + 2) / (2df + 1))); all else is integers:
a document's score is the sum of w * (10**9 * tf div (1000 * tf + 8m)) over the
item's distinct terms, with m = 10 + (90 * n * N) div L.

Cases: null and empty texts have no term and are never found; an item without
terms, or whose terms no document holds, has no row; repeated documents are
ranked each; equal scores go by ascending ``doc_id`` (null last); items of equal
id are searched each and ranked apart by their text; empty tables give no rows;
columns but ``doc_id, text`` and ``item_id, text`` are left out.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, keep, map_arrow

#: FIXED VALUES: bytes between terms become blanks, A-Z is lower-cased, all other bytes are parts of terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
CHUNK = 1 << 21  # (document, term, item) triples scored at a time


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return text.encode().translate(_FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """(item_id, terms) in blocks of bounded size, one block at a time on the driver."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, held = [], 0
    for r in rows.sort(F.col("item_id").asc_nulls_last(), "text").toLocalIterator():
        block.append((r["item_id"], sorted(set(terms(r["text"])))))
        held += len(r["text"] or "") + 64
        if held > block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def _counter(vocabulary):
    def run(batches):
        ids = {t: i for i, t in enumerate(vocabulary.value)}
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found = terms(text.as_py())
                if found:
                    own = [(ids[t], c) for t, c in Counter(found).items() if t in ids]
                    out.append((doc, len(found), [i for i, _ in own], [c for _, c in own]))
            yield pa.record_batch([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                   pa.array([r[2] for r in out], pa.list_(pa.int32())), pa.array([r[3] for r in out], pa.list_(pa.int64()))],
                                  names=["doc_id", "n", "ids", "tfs"])
    return run


class _Heaps:
    """For each item the k best (score, -doc_id) so far; a null doc_id ranks last of equals."""

    def __init__(self, n_items: int, k: int):
        self.heaps, self.k = [[] for _ in range(n_items)], k
        self.least = np.zeros(n_items, np.int64)  # a full heap's lowest score; else 0

    def add(self, scores: np.ndarray, docs: list) -> None:
        """scores: items x documents."""
        m, k = scores.shape[1], self.k
        least = self.least.copy()
        if m > k:  # below the k-th of this chunk nothing can enter
            least = np.maximum(least, np.partition(scores, m - k, axis=1)[:, m - k])
        item, doc = np.nonzero((scores >= np.maximum(least, 1)[:, None]))
        for i, d, s in zip(item.tolist(), doc.tolist(), scores[item, doc].tolist(), strict=True):
            entry = (s, -math.inf if docs[d] is None else -docs[d])
            heap = self.heaps[i]
            if len(heap) < k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == k:
                self.least[i] = heap[0][0]


def _searcher(index, k: int, chunk: int):
    def run(batches):
        begin, items, weights, names, n_docs, n_terms = index.value
        n_items = len(names)
        heaps = _Heaps(n_items, k)
        for b in batches:
            n, docs = b.column(1).to_numpy(), b.column(0).to_pylist()
            offsets = b.column(2).offsets.to_numpy()
            ids, tf = b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()
            offsets = offsets - offsets[0]
            if len(n) and int(n.max()) * 90 * n_docs >= 1 << 62:
                m = np.array([10 + 90 * x * n_docs // n_terms for x in n.tolist()], np.int64)
            else:
                m = 10 + 90 * n * n_docs // n_terms
            value = weights[ids] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(offsets))))
            fan = begin[ids + 1] - begin[ids]
            total = np.concatenate(([0], np.cumsum(fan)))[offsets]
            at = 0
            while at < len(docs):  # a chunk of documents: bounded triples, bounded score table
                to = min(int(np.searchsorted(total, total[at] + chunk, "right")) - 1, at + max(1, chunk // n_items))
                to = max(to, at + 1)
                lo, hi = offsets[at], offsets[to]
                f = fan[lo:hi]
                inside = np.arange(f.sum()) - np.repeat(np.cumsum(f) - f, f)
                item = items[np.repeat(begin[ids[lo:hi]], f) + inside]
                doc = np.repeat(np.repeat(np.arange(to - at), np.diff(offsets[at:to + 1])), f)
                scores = np.zeros(n_items * (to - at), np.int64)
                np.add.at(scores, item * (to - at) + doc, np.repeat(value[lo:hi], f))
                heaps.add(scores.reshape(n_items, to - at), docs[at:to])
                at = to
        rows = [(i, names[i], None if d == -math.inf else -d, s) for i, heap in enumerate(heaps.heaps) for s, d in heap]
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(map(list, zip(*rows, strict=True)), (pa.int32(), *[pa.int64()] * 3), strict=True)],
                                  names=["item", "item_id", "doc_id", "score"])
    return run


def _search_block(docs: DataFrame, block: list[tuple], k: int, chunk: int) -> DataFrame | None:
    spark = docs.sparkSession
    vocabulary = sorted({t for _, ts in block for t in ts})
    shipped = spark.sparkContext.broadcast(vocabulary)
    counts = keep(map_arrow(docs, _counter(shipped), "doc_id long, n long, ids array<int>, tfs array<long>"), "search-counts")
    n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs or not vocabulary:
        return None
    # one row for each term of the block at most
    df = {r[0]: r[1] for r in counts.select(F.explode("ids").alias("id")).groupBy("id").count().collect()}
    ids = {t: i for i, t in enumerate(vocabulary)}
    holders: list[list[int]] = [[] for _ in vocabulary]
    for i, (_, ts) in enumerate(block):
        for t in ts:
            holders[ids[t]].append(i)
    begin = np.concatenate(([0], np.cumsum([len(h) for h in holders])))
    items = np.array([i for h in holders for i in h], np.int64)
    weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    index = spark.sparkContext.broadcast((begin, items, weights, [i for i, _ in block], n_docs, n_terms))
    found = map_arrow(counts.filter(F.size("ids") > 0), _searcher(index, k, chunk), "item int, item_id long, doc_id long, score long")
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # heaps are merged in two steps, so that no item's heaps of all tasks meet in one
    rank = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).filter(F.col("rank") <= k)
    found = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    top = rank(rank(found, "item", "salt").drop("rank"), "item")
    out = keep(top.select("item_id", "rank", "doc_id", "score"), "search-top")
    discard(counts)
    for b in (shipped, index):
        b.unpersist()
    return out


def search(documents: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = 4 << 20, chunk: int = CHUNK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0.

    A task scores ``chunk`` triples at a time, which bounds its memory.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in _blocks(items, block_bytes):
        found = _search_block(docs, block, k, chunk)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
