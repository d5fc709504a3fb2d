"""The pipeline against a plain version of each decision, on the smallest tables."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import nbest_pieces
from marketlake.llm import quality_qda as Q
from marketlake.llm.catalog import piece_model
from marketlake.llm.common import held_out

from conftest import SF_SMALL
from llm.test_joins import _closure, _shingles
from llm.test_lines_and_shards import _brute_lines


def _covered(item, text, k=5):
    """Share of the item's words that lie in runs of k words which the text holds too."""
    cut = lambda t: re.findall(r"[^\W_]+", t.lower())
    a, b = cut(item), cut(text)
    k = min(k, len(a))
    held = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)}
    seen = {j for i in range(len(a) - k + 1) if tuple(a[i:i + k]) in held for j in range(i, i + k)} if k else set()
    return len(seen) / max(1, len(a))


def test_pipeline_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert set(docs.columns) <= set(out.columns)
    model = Q.fit(docs, labels, ~held_out(F.col("doc_id")))
    rows = [(r["doc_id"], r["text"]) for r in Q.score(docs, model).filter(F.col(Q.SCORE) >= 0.3).collect()]
    rows = [(i, t) for i, _, _, t in _brute_lines(rows, 10, 1)]
    sets = [_shingles(t, 5) for _, t in rows]
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    part = _closure([i for i, _ in rows], links)
    rows = [(i, t) for i, t in rows if part[i] == i]
    items = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(_covered(x, t or "") >= 0.6 for x in items)]
    got = nbest_pieces.decode(out, piece_model(spark)).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in got) == sorted((i, t or "") for i, t in rows)
    assert all(r["decoded"] == (r["text"] or "") and r["round_trip"] and r["n_pieces"] == len(r["piece_ids"]) for r in got)
    assert all(r["n_chars"] == len(r["text"] or "") for r in got)


def test_stages_keep_columns_of_any_name_and_odd_rows(spark, odd_rows):
    """Nulls, long texts, repeated rows and columns named like the stages' own."""
    from llm.conftest import DOC_SCHEMA
    own = ("n_dropped", "n_lines", "quality_score", "row", "kept", "whole", "lines", "cid", "n", "piece_ids_", "component_id", "row_key")
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in odd_rows] + [(50 + i, f"shared line\nown {i}", "en", None, 0) for i in range(12)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).select("*", *[F.lit(777).alias(c) for c in own])
    for (name, stage) in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        got = out.collect()
        assert set(docs.columns) <= set(out.columns), name
        assert all(r[c] == 777 for r in got for c in own), name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        if name == "line_dedup_runs":
            assert len(got) == len(rows) and {r["text"] for r in got if (r["doc_id"] or 0) >= 50} == {f"own {i}" for i in range(12)}


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, SF_SMALL).count() == 0
