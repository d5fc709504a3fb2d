"""Quality discriminant and toxicity factorisation machine."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marketlake.llm import quality_qda as Q
from marketlake.llm import toxicity_fm as X
from marketlake.llm.common import held_out

from conftest import SF_ORACLE


def _held_accuracy(spark, scored, name, label, cut):
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    rows = scored.join(labels, "doc_id").filter(held_out(F.col("doc_id"))).select(name, label).collect()
    return np.mean([(r[0] >= cut) == r[1] for r in rows])


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = Q.fit(docs, spark.read.parquet(f"{SF_ORACLE}/labels.parquet"), ~held_out(F.col("doc_id")))
    assert _held_accuracy(spark, Q.score(docs, model), Q.SCORE, "quality", 0.3) >= 0.95


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = X.fit(docs, spark.read.parquet(f"{SF_ORACLE}/labels.parquet"), ~held_out(F.col("doc_id")))
    assert _held_accuracy(spark, X.score(docs, model), X.SCORE, "toxic", 0.5) >= 0.9


def test_toxicity_held_out_recall_and_precision(spark):
    """Accuracy alone would pass a model that finds nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = X.score(docs, X.fit(docs, labels, ~held_out(F.col("doc_id"))))
    r = (scored.filter(held_out(F.col("doc_id"))).join(labels.filter("toxic in (0, 1)").select("doc_id", "toxic"), "doc_id")
               .agg(F.count_if((F.col(X.SCORE) >= 0.5) & (F.col("toxic") == 1)).alias("hit"), F.count_if(F.col(X.SCORE) >= 0.5).alias("said"),
                    F.count_if(F.col("toxic") == 1).alias("all"))).first()
    assert r["all"] > 50 and r["hit"] / r["all"] >= 0.6 and r["hit"] / r["said"] >= 0.9


def test_toxicity_does_not_depend_on_the_order_of_rows(spark, frame):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.limit(5))  # repeated ids as well
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    models = [X.fit(d, labels, ~held_out(F.col("doc_id")), train_rows=150) for d in (docs, docs.repartition(7, "text"), docs.orderBy(F.desc("doc_id")))]
    for m in models[1:]:
        assert (m.weight == models[0].weight).all() and (m.factor == models[0].factor).all() and m.bias == models[0].bias


def test_density_matches_the_formula():
    rng = np.random.default_rng(1)
    p = len(Q.FEATURES)
    cov = [(a := rng.normal(size=(p, p))) @ a.T + np.eye(p) for _ in range(2)]
    model = Q.Model(rng.normal(size=(2, p)), np.array([np.linalg.cholesky(c) for c in cov]), np.log([0.3, 0.7]))
    x = rng.normal(size=(5, p))
    dens = np.array([[s - 0.5 * (v - m) @ np.linalg.inv(c) @ (v - m) - 0.5 * np.linalg.slogdet(c)[1]
                      for m, c, s in zip(model.means, cov, model.log_share)] for v in x])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(dens[:, 0] - dens[:, 1])))


def test_fm_learns_a_pair_that_no_weight_shows():
    """Terms 1 and 2 are harmless alone and together: label 1 only where both or neither stand with 3."""
    rng = np.random.default_rng(3)
    sets, y = [], []
    for _ in range(3000):
        a, b = rng.integers(0, 2, 2)
        sets.append(sorted({10 + a, 20 + b}))
        y.append(float(a == b))
    at = np.arange(0, 2 * len(sets) + 1, 2)
    model = X.train(at, np.concatenate(sets).astype(np.int32), np.array(y), steps=1500, rate=0.5, l1=0.0, l1_factor=0.0)
    assert np.mean((model.score(at, np.concatenate(sets)) >= 0.5) == np.array(y)) > 0.95


def test_fm_logit_matches_the_pair_sum():
    rng = np.random.default_rng(5)
    model = X.Model(0.3, rng.normal(size=1 << X.BITS), rng.normal(size=(1 << X.BITS, X.FACTORS)))
    terms = np.array([4, 9, 77, 1000])
    pairs = sum(model.factor[i] @ model.factor[j] for k, i in enumerate(terms) for j in terms[k + 1:])
    got, _ = model.logits(np.array([0, 4, 4]), terms)
    assert np.allclose(got, [0.3 + model.weight[terms].sum() + pairs / 4, 0.3])


def test_fm_fits_pairs_of_long_texts(spark, frame):
    """With the defaults of fit(): no word shows the label, only whether the two marks agree."""
    fill = [a + b + c for a in ("br", "cl", "dw", "fj", "gn", "kp") for b in "aeiou" for c in ("lond", "mist", "nurk", "pelt", "rasp", "tuff")]
    rng, rows = np.random.default_rng(11), []
    for i in range(2400):
        a, b = rng.integers(0, 2, 2)
        text = [*rng.choice(fill, 130, replace=False), ("amber", "violet")[a], ("hammer", "spindle")[b]]
        rows.append((i, " ".join(rng.permutation(text)), int(a == b)))
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    docs = frame([r[:2] for r in rows])
    model = X.fit(docs, labels, F.col("doc_id") < 2000)
    at, terms = X.hashed_terms(pa.array([t for _, t, _ in rows]))
    assert np.diff(at).min() >= 300 and np.count_nonzero(model.factor) > 0
    held = [r for r in X.score(docs, model).filter("doc_id >= 2000").join(labels, "doc_id").collect()]
    assert np.mean([r[X.SCORE] >= 0.5 for r in held if r["toxic"] == 1]) >= 0.8
    assert np.mean([r[X.SCORE] < 0.5 for r in held if r["toxic"] == 0]) >= 0.8


def test_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows, extra=True)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (8, 1, None), (9, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for module in (Q, X):
        model = module.fit(docs, labels, F.lit(True))
        out = module.score(docs, model)
        assert set(out.columns) == set(docs.columns) | {module.SCORE}
        rows = out.collect()
        assert len(rows) == len(odd_rows) and all(0 <= r[module.SCORE] <= 1 for r in rows)
        same = {r[module.SCORE] for r in rows if r["text"] and r["text"].startswith("same")}
        assert len(same) == 1
        assert module.score(docs.limit(0), model).count() == 0
        none = module.fit(docs, labels.limit(0), F.lit(True))
        assert {round(r[module.SCORE], 6) for r in module.score(docs, none).collect()} == {0.5}


def test_stats_of_no_words():
    assert np.isfinite(Q.text_stats(pa.array([None, "", " \n"]))).all()
    at, terms = X.hashed_terms(pa.array([None, "", "Loser loser"]))
    assert at.tolist() == [0, 0, 0, 3] and len(terms) == 3
