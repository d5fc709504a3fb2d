"""Stupid-backoff scores of documents, from relational n-gram counts.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  The model is the counts
of all n-grams of one to ``order`` words over all documents, partitioned by
hash; n-grams of two words or more that are counted fewer than ``min_count``
times are pruned from it (1: none is).  A word scores log(n-gram / n-gram without
its last word) for the longest n-gram that ends in it within its document, and
is in the model; each step to a shorter one costs log(alpha), and a lone word
scores log(word / all words).  A document's score is the sum over its words.

How it scales, any order but 2: documents are dealt by hash into chunks of about
CHUNK characters; a batch's documents of one chunk travel packed, since small rows
of text shuffle at hardly less than their size.  A chunk sends each distinct n-gram once, with its count in
the chunk, packed by hash bucket; a bucket adds up its n-grams and sends each
chunk the totals in the order asked, without the n-grams; the chunk scores its
documents with them.  A common n-gram is one entry for each chunk, however many
documents hold it; the buckets grow in number with the chunks.

How it scales, order 2: the ``frequent`` most common words at most hold 1 / frequent of
all words each, so their table has a proven bound and is broadcast; they get
small codes, the others their 64-bit hashes.  Pairs that alone hold 1 / HOT of
all words or more (at most HOT of them, again by count) are scored where the
text is read; the other pairs are exploded, one row for each document and
distinct pair, and meet their counts in one shuffle by the pair.  The words
that a score still needs are looked up in the broadcast table, and the rare
ones by a join on the word, where no key holds more than 1 / frequent.

Cases: null and empty texts have no words and score 0.0 (per word: null);
repeated rows are separate documents and count; a null doc_id is a document as
any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import codepoints as C
from .common import keep, map_arrow, ship
from .part_join import _ascii

FREQUENT, HOT = 1 << 19, 1 << 12
#: Characters of a chunk; buckets for every 64 chunks.
CHUNK, BUCKETS = 1 << 24, 256
#: Compression level of packed documents.
PACK_LEVEL = 9


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document of each word and its hash; a hash is negative as a signed number, codes are not."""
    t = C.Texts(column)
    word, low = _ascii()
    small, plain = np.minimum(t.cp, 127), t.cp < 128
    start, end = t.runs(~plain | word[small])
    h = C.run_hashes(np.where(plain, low[small], t.cp), start, end)[0] | np.uint64(1 << 63)
    return t.doc[start] if len(start) else np.zeros(0, np.int64), h


def _counted(keys: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the key columns and how often each occurs."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    if not len(order):
        return keys, order
    new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.diff(np.append(at, len(order)))


class _Codes:
    """Codes of the frequent words: their place among them by count."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return h.view(np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.order[at], h.view(np.int64))


def _count_words(docs: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "text"):
                words, n = np.unique(word_hashes(part.column("text"))[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return map_arrow(docs.select("text"), count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _pairs(codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word before, word, document, for each word that is not the first of its document."""
    follows = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    return codes[follows - 1], codes[follows], doc[follows]


def _count_hot(docs: DataFrame, codes, top: int) -> DataFrame:
    """Counts of the pairs of words with codes below ``top``, summed for each slice before they are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "text"):
                doc, h = word_hashes(part.column("text"))
                a, b, _ = _pairs(codes.value.of(h), doc)
                both = (a >= 0) & (a < top) & (b >= 0) & (b < top)
                pair, n = np.unique((a[both] << 32) | b[both], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])

    return map_arrow(docs.select("text"), count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _grams(doc: np.ndarray, h: np.ndarray, order: int) -> list[np.ndarray]:
    """For one to ``order`` words, the hash of the n-gram that ends in each word (0: it would begin before its document)."""
    out = [C.mixed(h) | np.uint64(1)]
    for k in range(1, order):
        longer = np.zeros(len(h), np.uint64)
        if len(h) > k:
            whole = doc[k:] == doc[:-k]
            longer[k:][whole] = C.mixed(out[-1][k - 1:-1][whole] * np.uint64(0x9E3779B97F4A7C15) + h[k:][whole]) | np.uint64(1)
        out.append(longer)
    return out


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers of 0 or more, without the leading bytes that none of them has; equal bytes stand together, for the shuffle's compression."""
    x = x.astype("<u8")
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(-1, n) if n else np.zeros((1, 0), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :len(planes)] = planes.T
    return out.view("<u8").reshape(-1)


def _pack(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, chunk) as rows (chunk, pack): those of a batch that go to one chunk, compressed."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", PACK_LEVEL))
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk = batch.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            dealt, rows = chunk[order], batch.select(["doc_id", "text"]).take(pa.array(order))
            at = np.concatenate(([0], np.flatnonzero(dealt[1:] != dealt[:-1]) + 1, [len(dealt)]))
            for a, b in zip(at[:-1], at[1:]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                    out.write_batch(rows.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([pa.array(dealt[a:a + 1]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "pack"])

    return map_arrow(docs, pack, "chunk int, pack binary")


def _unpack(packs: pa.Table) -> pa.Table:
    """The documents (doc_id, text) of packs."""
    return pa.concat_tables([pa.ipc.open_stream(p.as_buffer()).read_all() for p in packs.column("pack")])


class _Chunk:
    """The n-grams of a chunk's documents, for each order and word (``grams``)."""

    def __init__(self, table: pa.Table, order: int):
        docs, grams, n = [], [], 0
        for batch in table.select(["text"]).to_batches():
            for part in C.slices(batch, "text"):
                doc, h = word_hashes(part.column("text"))
                grams.append(_grams(doc, h, order))
                docs.append(doc.astype(np.int64) + n)
                n += part.num_rows
        self.n = n
        self.doc = np.concatenate([np.zeros(0, np.int64), *docs])
        self.grams = [np.concatenate([np.zeros(0, np.uint64), *g]) for g in zip(*grams)] or [np.zeros(0, np.uint64)] * order

    def distinct(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of order k + 1 by their hashes, and how often each occurs."""
        return np.unique(self.grams[k][self.grams[k] != 0], return_counts=True)

    def looked_up(self, k: int, counts: np.ndarray) -> np.ndarray:
        """For each word, the count of the n-gram that ends there (none: 0), from those of ``distinct``."""
        whole = self.grams[k] != 0
        out = np.zeros(len(whole), np.int64)
        out[whole] = counts[np.unique(self.grams[k][whole], return_inverse=True)[1]]
        return out


def _score_chunks(docs: DataFrame, alpha: float, min_count: int, order: int) -> DataFrame:
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = -(-chars // CHUNK) or 1
    buckets = BUCKETS * -(-chunks // 64)
    kind = docs.schema["doc_id"].dataType.simpleString()
    packs = _pack(docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk")))

    def ask(table: pa.Table) -> pa.Table:
        chunk, parts = _Chunk(_unpack(table), order), []
        step = (1 << 64) // buckets  # a bucket is a range of hashes of one order; the last one has the rest too
        for k in range(order):
            held, times = chunk.distinct(k)
            at = np.append(np.searchsorted(held, np.array([i * step for i in range(buckets)], np.uint64)), len(held))
            full = np.flatnonzero(np.diff(at))
            own = [held[at[b]:at[b + 1]] for b in full]
            parts.append(pa.table({"bucket": pa.array((full + k * buckets).astype(np.int32)), "chunk": pa.array(np.full(len(full), table.column("chunk")[0].as_py(), np.int32)),
                                   "n": pa.array(np.diff(at)[full].astype(np.int32)), "least": pa.array([int(g[0]) - (1 << 63) for g in own], pa.int64()),
                                   "gaps": pa.array([_packed(np.diff(g)) for g in own], pa.binary()),
                                   "times": pa.array([_packed(times[at[b]:at[b + 1]]) for b in full], pa.binary())}))
        return pa.concat_tables(parts)

    def answer(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        grams = [np.cumsum(np.concatenate((np.array([least + (1 << 63)], np.uint64), _unpacked(gaps, n - 1))), dtype=np.uint64)
                 for n, least, gaps in zip(sizes, table.column("least").to_pylist(), table.column("gaps").to_pylist())]
        times = np.concatenate([_unpacked(t, n) for n, t in zip(sizes, table.column("times").to_pylist())])
        held, where = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.bincount(where, weights=times, minlength=len(held)).astype(np.int64)[where]  # exact below 2 ** 53
        at = np.concatenate(([0], np.cumsum(sizes)))
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "n": table.column("n"),
                         "counts": pa.array([_packed(total[a:b]) for a, b in zip(at[:-1], at[1:])], pa.binary())})

    def scored(table: pa.Table, told: pa.Table) -> pa.Table:
        table = _unpack(table)
        own = _Chunk(table, order)
        told = told.sort_by("bucket")
        told_order = told.column("bucket").to_numpy() // buckets

        def counted(k: int) -> np.ndarray:
            part = told.filter(pa.array(told_order == k))
            counts = [_unpacked(c, n).astype(np.int64) for c, n in zip(part.column("counts").to_pylist(), part.column("n").to_pylist())]
            return own.looked_up(k, np.concatenate([np.zeros(0, np.int64), *counts]))

        last = counted(0)
        value = np.log(np.maximum(last, 1))  # log(all words) is taken off at the end
        lone = np.ones(len(value))
        for k in range(1, order):
            now = counted(k)
            before = np.concatenate(([1], last[:-1]))
            here, there = now >= max(min_count, 1), own.grams[k] != 0
            value = np.where(here, np.log(np.maximum(now, 1)) - np.log(np.maximum(before, 1)), np.where(there, value + np.log(alpha), value))
            lone = np.where(here, 0.0, lone)
            last = now
        n_words = np.bincount(own.doc, minlength=own.n)
        return pa.table({"doc_id": table.column("doc_id"), "n_words": pa.array(n_words.astype(np.int64)),
                         "v": pa.array(np.bincount(own.doc, weights=value, minlength=own.n).astype(float)),
                         "lone": pa.array(np.bincount(own.doc, weights=lone, minlength=own.n).astype(float))})

    asked = packs.groupBy("chunk").applyInArrow(ask, "bucket int, chunk int, n int, least bigint, gaps binary, times binary")
    told = asked.groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, n int, counts binary")
    rows = keep(packs.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(scored, f"doc_id {kind}, n_words bigint, v double, lone double"), "scores")
    total = rows.agg(F.sum("n_words")).first()[0] or 1
    log_score = F.col("v") - F.col("lone") * F.lit(float(np.log(max(total, 1))))
    return rows.select("doc_id", "n_words", log_score.alias("log_score"), F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"))


def score(docs: DataFrame, alpha: float = 0.4, min_count: int = 2, order: int = 2) -> DataFrame:
    """doc_id, n_words, log_score (sum over words) and mean_log_score for every row of ``docs`` (doc_id, text)."""
    if order != 2:
        return _score_chunks(docs, alpha, min_count, order)
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    words = keep(_count_words(docs), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    frequent = words.filter((F.col("n") * FREQUENT >= total) & F.lit(total > 0)).toArrow()  # FREQUENT rows at most
    word, n = frequent.column("word").to_numpy(), frequent.column("n").to_numpy()
    order = np.lexsort((word, -n))
    held, counts = word[order].view(np.uint64), n[order].astype(np.float64)
    codes = spark.sparkContext.broadcast(_Codes(held))
    top = int((counts * HOT >= total).sum())
    hot = _count_hot(docs, codes, top).filter(F.col("n") * HOT >= total).collect() if top else []  # HOT rows at most
    hot.sort(key=lambda r: r["pair"])
    hot_pair, hot_n = np.array([r["pair"] for r in hot], np.int64), np.array([r["n"] for r in hot], np.float64)
    table = spark.sparkContext.broadcast((hot_pair, hot_n, counts))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_pair, hot_n, counts = table.value
        for batch in batches:
            for part in C.slices(batch, "text"):
                doc, h = word_hashes(part.column("text"))
                code, key = codes.value.of(h), part.column("row_key").to_numpy()
                n = part.num_rows
                first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, np.int64)
                a, b, d = _pairs(code, doc)
                (d, a, b), times = _counted([d, a, b])
                known = np.zeros(n)
                if len(hot_pair):
                    pair = np.where((a >= 0) & (b >= 0), (a << 32) | b, -1)
                    at = np.minimum(np.searchsorted(hot_pair, pair), len(hot_pair) - 1)
                    is_hot = (hot_pair[at] == pair) & (hot_n[at] >= min_count)
                    at, who = at[is_hot], a[is_hot]
                    known = np.bincount(d[is_hot], times[is_hot] * (np.log(hot_n[at]) - np.log(counts[who])), n)
                    a, b, d, times = a[~is_hot], b[~is_hot], d[~is_hot], times[~is_hot]
                # first words (before: null) come along; the rows with a word of null bring what is known already
                docs_, firsts = np.arange(n), code[first]
                at = np.argsort(np.concatenate((d, doc[first], docs_)), kind="stable")
                column = lambda *x: np.concatenate(x)[at]  # noqa: E731  rows of one document stand together
                none = lambda *x: column(*[np.full(m, v, bool) for m, v in zip((len(d), len(first), n), x)])
                nothing = np.zeros(n, np.int64)
                ids = part.column("doc_id")
                rows = [pa.array(key[column(d, doc[first], docs_)]),
                        pa.array(column(a, np.zeros(len(first), np.int64), pc.fill_null(ids, 0).to_numpy()),
                                 mask=column(np.zeros(len(d), bool), np.ones(len(first), bool), ids.is_null().to_numpy(zero_copy_only=False))),
                        pa.array(column(b, firsts, nothing), mask=none(False, False, True)),
                        pa.array(column(times, np.ones(len(first), np.int64), np.bincount(doc, minlength=n)).astype(np.int32)),
                        pa.array(column(np.zeros(len(d)), np.zeros(len(first)), known), mask=none(True, True, False))]
                for i in range(0, len(at), 500_000):
                    yield pa.RecordBatch.from_arrays([r.slice(i, 500_000) for r in rows], names=["row_key", "a", "b", "times", "known"])

    exploded = map_arrow(docs, explode, "row_key bigint, a bigint, b bigint, times int, known double")
    return _summed(exploded, words, counts, total, alpha, min_count)


def _summed(exploded: DataFrame, words: DataFrame, counts: np.ndarray, total: int, alpha: float, min_count: int) -> DataFrame:
    """Exploded rows: pairs (a, b); first words (b alone); one row for each document with ``known`` (a: its doc_id, times: its words)."""
    spark = exploded.sparkSession
    row = F.col("known").isNotNull()
    pair = ~row & F.col("a").isNotNull()
    # rows without a pair have groups of their own
    group = Window.partitionBy(F.when(pair, F.col("a")).otherwise(F.col("row_key")), F.when(pair, F.col("b")).otherwise(F.col("row_key")), pair)
    seen = exploded.withColumn("c", F.sum("times").over(group))
    kept = pair & (F.col("c") >= min_count)
    n_all = float(max(total, 1))
    value = F.when(row, F.col("known")).when(kept, F.col("times") * F.log("c")) \
             .when(pair, F.col("times") * F.lit(float(np.log(alpha) - np.log(n_all)))).otherwise(F.lit(-float(np.log(n_all))))
    asked = seen.select("row_key", value.alias("v"), F.when(row, F.lit(None)).when(kept, F.col("a")).otherwise(F.col("b")).alias("word"),
                        F.when(kept, -F.col("times")).otherwise(F.col("times")).alias("w"),
                        F.when(row, F.col("a")).alias("doc_id"), F.when(row, F.col("times")).alias("n_words"))
    # FREQUENT rows at most
    common = keep(spark.createDataFrame(pd.DataFrame({"word": np.arange(len(counts)), "log_n": np.log(counts)}), "word bigint, log_n double"), "frequent")
    looked = asked.join(F.broadcast(common), "word", "left")
    rare = F.col("word").isNotNull() & (F.col("word") < 0)
    per_doc = looked.groupBy("row_key").agg(
        F.sum(F.col("v") + F.coalesce(F.col("w") * F.col("log_n"), F.lit(0.0))).alias("v"), F.max("doc_id").alias("doc_id"),
        F.count("n_words").alias("copies"), F.max("n_words").alias("n_words"),
        F.collect_list(F.when(rare, F.struct("word", "w"))).alias("rare"))
    # one row for the document itself and one for each rare word still asked for; the former get keys that no word has
    nobody = F.col("row_key").bitwiseAND(2 ** 63 - 1)
    own = F.struct(nobody.alias("word"), F.lit(0).alias("w"), F.lit(True).alias("own"))
    parts = per_doc.select("row_key", "v", "doc_id", "copies", "n_words", F.explode(F.concat(
        F.array(own), F.transform("rare", lambda r: F.struct(r["word"].alias("word"), r["w"].alias("w"), F.lit(False).alias("own"))))).alias("r")) \
        .select("row_key", "r.word", "r.w", *[F.when(F.col("r.own"), F.col(c)).alias(c) for c in ("v", "doc_id", "copies", "n_words")])
    found = parts.join(words.filter(F.col("n") * FREQUENT < total), "word", "left")
    # equal rows brought equal sums to one key: each gets its share back
    sums = found.groupBy("row_key").agg(F.sum(F.coalesce(F.col("v"), F.col("w") * F.log("n"))).alias("v"), F.max("doc_id").alias("doc_id"),
                                        F.max("copies").alias("copies"), F.max("n_words").alias("n_words"))
    score = F.col("v") / F.col("copies")
    return sums.select("doc_id", F.col("n_words").cast("long").alias("n_words"), score.alias("log_score"),
                       F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_log_score"),
                       F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
