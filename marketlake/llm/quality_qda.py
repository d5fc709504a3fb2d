"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes ``len(FEATURES)`` transformed statistics.  Class counts, sums
and cross products are aggregated by Spark over all labelled rows; a class
covariance is shrunk towards the pooled covariance and towards its own mean
variance.  A score is the posterior of label 1 from the difference of the two
Mahalanobis log densities, computed with the Cholesky factors that the model
keeps.  Only the text enters a score.

Cases: null and empty texts have the statistics of no words; repeated rows
score alike; labels that are null are left out; with labels of one class alone
each score is that class's share (1.0 or 0.0), without labels 0.5; an empty
table gives no rows; other columns pass unchanged.
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

FEATURES = ("log_words", "log_word_len", "upper", "symbols", "symbol_runs",
            "same_as_before", "distinct", "distinct_pairs", "log_line_words", "symbol_words")
SCORE = "quality_score"
FEW = 10


def _share(part: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Variance-stabilised share: arcsine of the root; ``FEW`` more in the whole calm short texts."""
    return np.arcsin(np.sqrt(np.clip(part / (of + FEW), 0, 1)))


def text_stats(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    t = C.Texts(column)
    kind, n = t.kinds(), t.n
    chars = np.diff(t.at).astype(float)
    space = kind == C.SPACE
    upper, other = kind == C.LETTER_UPPER, kind == C.OTHER
    letters = C.sums((kind <= C.LETTER), t.doc, n)
    start, end = t.runs(~space)
    word_doc = t.doc[start] if len(start) else np.zeros(0, np.int64)
    words = np.bincount(word_doc, minlength=n).astype(float)
    h = C.run_hashes(t.cp, start, end)[0]
    follows = np.zeros(len(h), bool)
    follows[1:] = word_doc[1:] == word_doc[:-1]
    same = np.zeros(len(h), bool)
    same[1:] = follows[1:] & (h[1:] == h[:-1])
    pair = h[1:] * np.uint64(31) + h[:-1] if len(h) else h
    pair, pair_doc = pair[follows[1:]], word_doc[1:][follows[1:]]

    def distinct(value: np.ndarray, doc: np.ndarray) -> np.ndarray:
        order = np.lexsort((value, doc))
        v, d = value[order], doc[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
        return np.bincount(d[new], minlength=n).astype(float)

    symbol_run = np.zeros(len(other), bool)
    symbol_run[1:] = other[1:] & other[:-1] & (t.doc[1:] == t.doc[:-1])
    lines = C.sums(t.cp == 10, t.doc, n) + 1
    size = (end - start).astype(float)
    mean = C.sums(size, word_doc, n) / np.maximum(words, 1)
    bare = np.add.reduceat(other.astype(np.int64), start) == size if len(start) else np.zeros(0, bool)  # a word and the space after it
    return np.column_stack([
        np.log1p(words), np.log1p(mean), _share(C.sums(upper, t.doc, n), letters), _share(C.sums(other, t.doc, n), chars),
        _share(C.sums(symbol_run, t.doc, n), words),
        _share(C.sums(same, word_doc, n), words), np.log1p(distinct(h, word_doc)) / np.log(words + 2),
        _share(distinct(pair, pair_doc), np.bincount(pair_doc, minlength=n)), np.log1p(words / lines),
        _share(C.sums(bare, word_doc, n), words)])


@dataclass
class Model:
    """Means, lower Cholesky factors and log shares of the two classes."""

    means: np.ndarray
    factors: np.ndarray
    log_share: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if not np.isfinite(self.log_share).all():  # fewer than two classes
            return np.full(len(x), 0.5 if not np.isfinite(self.log_share).any() else float(np.isfinite(self.log_share[1])))
        dens = []
        for m, low, share in zip(self.means, self.factors, self.log_share):
            z = np.linalg.solve(low, (x - m).T)
            dens.append(share - 0.5 * (z * z).sum(0) - np.log(np.diag(low)).sum())
        return 1 / (1 + np.exp(np.clip(dens[0] - dens[1], -700, 700)))


def features(df: DataFrame, text: str = "text", extra: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``extra`` columns and the statistics ``x`` (array) of every row."""
    schema = T.StructType([*[df.schema[c] for c in extra], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, text, C.PIECE_BYTES):
                x = text_stats(part.column(text))
                at = pa.array(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in extra], pa.ListArray.from_arrays(at, pa.array(x.ravel()))],
                                                 names=[*extra, "x"])

    return map_arrow(df.select(*extra, *([] if text in extra else [text])), stats, schema)


def fit(docs: DataFrame, labels: DataFrame, train: Column, shrink_pooled: float = 0.1, shrink_mean: float = 0.02) -> Model:
    """Model from all rows of ``docs`` for which ``train`` holds and ``labels`` (doc_id, quality) has a label."""
    p = len(FEATURES)
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("y"))
    rows = features(docs.filter(train)).join(known, "doc_id").select("y", "x")
    x = lambda i: F.col("x")[i]
    got = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x(i)).alias(f"s{i}") for i in range(p)],
                                *[F.sum(x(i) * x(j)).alias(f"c{i}_{j}") for i in range(p) for j in range(i + 1)]).collect()
    count, means, covs = np.zeros(2), np.zeros((2, p)), np.zeros((2, p, p))
    for r in got:
        n = r["n"]
        m = np.array([r[f"s{i}"] for i in range(p)]) / n
        second = np.array([[r[f"c{max(i, j)}_{min(i, j)}"] for j in range(p)] for i in range(p)]) / n
        count[r["y"]], means[r["y"]], covs[r["y"]] = n, m, second - np.outer(m, m)
    pooled = (covs * count[:, None, None]).sum(0) / max(1, count.sum())
    factors = np.zeros_like(covs)
    for c in (0, 1):
        shrunk = (1 - shrink_pooled) * covs[c] + shrink_pooled * pooled
        shrunk = (1 - shrink_mean) * shrunk + shrink_mean * (np.trace(shrunk) / p + 1e-9) * np.eye(p)
        factors[c] = np.linalg.cholesky(shrunk)
    with np.errstate(divide="ignore"):
        return Model(means, factors, np.log(count / max(1, count.sum())))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the column ``quality_score``, 0 to 1 (a column of that name is replaced)."""
    docs = docs.select(*[c for c in docs.columns if c != SCORE])
    schema = T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, text, C.PIECE_BYTES):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(text_stats(part.column(text))))],
                                                 names=[*part.schema.names, SCORE])

    return map_arrow(docs, scored, schema)
