"""Toxicity: factorisation machine over hashed terms.

Terms are a text's lower-cased words and their first four and five letters,
hashed into ``2 ** BITS`` slots; a text is the set of its terms.  The model adds
a weight for each term and, through ``FACTORS``-dimensional factors, a weight
for each pair of terms, so that two harmless words can be harmful together (the
sum over n terms' pairs is divided by twice the root of n: undivided, long texts
would drown in it; divided by n, no pair of a long text could be learned).
It is fitted by AdaGrad with an L1 proximal step (the factors' penalty is far below
their gradients, or it would hold them at 0) on a bounded sample of the
labelled rows (``train_rows``, chosen by a hash of the id); every text is
scored in one pass without a shuffle, whole.

Cases: null and empty texts have no terms and score the bias alone; repeated
rows score alike; null labels are left out; without labels each score is 0.5;
an empty table gives no rows; other columns pass unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import codepoints as C
from .common import map_arrow

BITS, FACTORS = 18, 8
SCORE = "toxicity_score"


def hashed_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and the distinct term slots of each text, one after another."""
    t = C.Texts(column)
    kind = t.kinds()
    start, end = t.runs((kind == C.LETTER_UPPER) | (kind == C.LETTER) | (kind == C.DIGIT))
    doc = t.doc[start] if len(start) else np.zeros(0, np.int64)
    keys = []
    for salt, h in enumerate(C.run_hashes(t.lowered(), start, end, (None, 4, 5))):
        slot = C.mixed(h + np.uint64(salt)) >> np.uint64(64 - BITS)
        keys.append((doc.astype(np.int64) << BITS) | slot.astype(np.int64))
    held = np.unique(np.concatenate(keys))
    at = np.searchsorted(held, np.arange(t.n + 1, dtype=np.int64) << BITS)
    return at, (held & ((1 << BITS) - 1)).astype(np.int32)


def _row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one row for each term) over each text; texts without terms: 0."""
    total = np.zeros((len(at) - 1, *values.shape[1:]))
    full = np.flatnonzero(np.diff(at))
    if len(full):
        total[full] = np.add.reduceat(values, at[full], axis=0)
    return total


def _spread(n: np.ndarray) -> np.ndarray:
    """What the pair sum of a text of ``n`` terms is divided by."""
    return 2 * np.sqrt(np.maximum(n, 1))


@dataclass
class Model:
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def logits(self, at: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.factor[terms]
        total = _row_sums(v, at)
        pairs = 0.5 * ((total ** 2).sum(1) - _row_sums((v * v).sum(1), at)) / _spread(np.diff(at))
        return self.bias + _row_sums(self.weight[terms], at) + pairs, total

    def score(self, at: np.ndarray, terms: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(at, terms)[0], -30, 30)))


def train(at: np.ndarray, terms: np.ndarray, y: np.ndarray, steps: int = 512, batch: int = 128, rate: float = 0.1,
          l1: float = 5e-4, l1_factor: float = 1e-5, seed: int = 7) -> Model:
    size = 1 << BITS
    rng = np.random.default_rng(seed)
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(share / (1 - share))) if len(y) else 0.0, np.zeros(size), rng.normal(0, 0.01, (size, FACTORS)))
    seen_w, seen_v, seen_b = np.full(size, 1e-8), np.full((size, FACTORS), 1e-16), 1e-8
    width = np.diff(at)
    rounds = -(-steps * batch // max(1, len(y))) if len(y) else 0
    for _ in range(rounds):
        order = rng.permutation(len(y))
        for i in range(0, len(y), batch):
            rows = order[i:i + batch]
            n = width[rows]
            cut = np.concatenate(([0], np.cumsum(n)))
            own = terms[np.repeat(at[rows] - cut[:-1], n) + np.arange(cut[-1])]
            logit, total = model.logits(cut, own)
            off = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]
            each = np.repeat(off, n) / len(rows)
            part = each / np.repeat(_spread(n), n)
            used, where = np.unique(own, return_inverse=True)
            g = np.bincount(where, weights=each, minlength=len(used))
            pull = part[:, None] * (np.repeat(total, n, axis=0) - model.factor[own])
            gv = np.column_stack([np.bincount(where, weights=pull[:, f], minlength=len(used)) for f in range(FACTORS)])
            seen_w[used] += g * g
            step = rate / np.sqrt(seen_w[used])
            w = model.weight[used] - step * g
            model.weight[used] = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
            seen_v[used] += gv * gv
            step = rate / np.sqrt(seen_v[used] + 1e-12)
            v = model.factor[used] - step * gv
            model.factor[used] = np.sign(v) * np.maximum(np.abs(v) - step * l1_factor, 0)
            seen_b += off.mean() ** 2
            model.bias -= rate / np.sqrt(seen_b) * off.mean()
    met = np.zeros(size, bool)
    met[terms] = True
    model.factor[~met] = 0  # a term never met has no effect, not a random one
    return model


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, train_rows: int = 16_384) -> Model:
    """Model from at most ``train_rows`` labelled rows for which ``allowed`` (on doc_id) holds: those of the smallest
    hashes, trained in the order of their ids, so that the model does not depend on the order or place of the rows."""
    sample = (labels.filter(F.col("toxic").isin(0, 1) & allowed).select("doc_id", F.col("toxic").alias("y"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(train_rows))
    schema = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("doc_id", T.LongType()), T.StructField("place", T.LongType())])

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in C.slices(b, "text"):
                at, held = hashed_terms(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.ListArray.from_arrays(at.astype(np.int32), pa.array(held)),
                                                  part.column("doc_id"), part.column("place")], names=["y", "terms", "doc_id", "place"])

    # the sample has train_rows short rows at most, so it may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(
        F.col("y").cast("int").alias("y"), "text", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("place"))
    # a repeated id brings several rows: which of them count is told by the hash as well
    got = map_arrow(rows, terms, schema).orderBy("place", "y").limit(train_rows).toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("place", "ascending"), ("y", "ascending")]).combine_chunks()
    if not got.num_rows:
        return train(np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0))
    lists = got.column("terms").chunk(0)
    at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)))
    return train(at, lists.flatten().to_numpy(), got.column("y").to_numpy().astype(float))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the column ``toxicity_score``, 0 to 1 (a column of that name is replaced)."""
    docs = docs.select(*[c for c in docs.columns if c != SCORE])
    schema = T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS rows, whatever the input

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held.value.score(*hashed_terms(part.column(text))))],
                                                 names=[*part.schema.names, SCORE])

    return map_arrow(docs, scored, schema)
