"""Distributed exact percentiles and dense ordinals against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators.quantiles import grouped_percentiles
from marketlake.operators.ranking import global_index


def _data(spark):
    rng = np.random.default_rng(7)
    rows = []
    # one hot group holding about a third of the rows, repeated values, nulls
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{i % 17}"
        v = None if i % 101 == 0 else float(rng.integers(0, 500)) / 4
        rows.append((g, v))
    rows.append(("only_null", None))
    return spark.createDataFrame(rows, "g string, v double").repartition(6)


def test_grouped_percentiles_match_numpy(spark):
    df = _data(spark)
    r = grouped_percentiles(df, ["g"], "v", {"p25": 0.25, "p50": 0.5, "p90": 0.9},
                            aggs={"n": ("sum", F.col("v").isNotNull().cast("bigint"))}).collect()
    pdf = df.toPandas()
    for row in r:
        vals = pdf[pdf.g == row["g"]].v.dropna().to_numpy()
        assert row["n"] == len(vals)
        if len(vals) == 0:
            assert row["p50"] is None
            continue
        for k, p in (("p25", 0.25), ("p50", 0.5), ("p90", 0.9)):
            assert row[k] == pytest.approx(np.percentile(vals, p * 100), abs=1e-9)


def test_nearest_rank_and_global(spark):
    df = _data(spark)
    r = grouped_percentiles(df, [], "v", {"p95": 0.95}, mode="nearest",
                            aggs={"n": ("sum", F.col("v").isNotNull().cast("bigint"))}).first()
    vals = np.sort(df.toPandas().v.dropna().to_numpy())
    k = min(max(int(np.floor(0.95 * (len(vals) - 1) + 0.5)), 0), len(vals) - 1)
    assert r["p95"] == vals[k] and r["n"] == len(vals)


def test_empty_global(spark):
    df = spark.createDataFrame([], "v double")
    r = grouped_percentiles(df, [], "v", {"p50": 0.5}, aggs={"n": ("sum", F.col("v").isNotNull().cast("bigint"))}).collect()
    assert len(r) == 1 and r[0]["p50"] is None and r[0]["n"] is None


def test_ties_do_not_grow_a_task(spark):
    """70 % of 200,000 values are one value: a task reads rows of the folded table, evenly dealt."""
    tied = spark.range(200_000).select(F.lit("g").alias("g"), F.when(F.col("id") % 10 < 7, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    seen = {}

    def spy(df, name):
        seen["df"] = kept = materialize(df, name)
        return kept

    import marketlake.operators.quantiles as q
    from marketlake.session import materialize
    old, q.materialize = q.materialize, spy
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = grouped_percentiles(tied, ["g"], "v", {"p50": 0.5, "p90": 0.9}, {"n": ("sum", F.lit(1))}).first()
    finally:
        q.materialize = old
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    vals = np.sort([5.0 if i % 10 < 7 else float(i) for i in range(200_000)])
    assert row["n"] == 200_000 and row["p50"] == np.percentile(vals, 50) and row["p90"] == pytest.approx(np.percentile(vals, 90))
    sizes = [r["count"] for r in seen["df"].groupBy("_pid").count().collect()]
    assert len(sizes) > 1 and sum(sizes) == 60_001 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_global_index_dense(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    out = global_index(df, [F.col("k")], "idx").collect()
    assert sorted((r["k"], r["idx"]) for r in out) == [(i, i + 1) for i in range(5000)]
