"""What a worker holds while it goes through one large batch."""

import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from marketlake.llm import nbest_pieces, part_join, quality_qda, tiling

from .conftest import words

MODEL = os.environ.get("CORPUS_TOKENIZERS", "/opt/tokenizers") + "/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def batch():
    """A million bytes of text in one batch."""
    texts = [" ".join(words(i, 500)) for i in range(500)]
    n = len(texts)
    return pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts)], names=["row_key", "doc_id", "text"])


def _functions(spark):
    docs = spark.createDataFrame([(1, 1, "a")], "row_key long, doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(words(10_000, 30)))], "item_id long, text string")
    flat = quality_qda.Model(np.zeros((2, 10)), np.array([np.eye(10)] * 2), np.log([0.5, 0.5]))
    return {"quality": lambda: quality_qda.score(docs, flat), "sets": lambda: part_join._sized(docs, 5),
            "entries": lambda: part_join._entries(docs, 5, {0: (400, 560, 320, 20, 0, 0)}, np.zeros(0, np.uint64), {}),
            "tiling": lambda: tiling.clean(docs, benchmark), "pieces": lambda: nbest_pieces.encode(docs, nbest_pieces.load_model(MODEL))}


@pytest.mark.parametrize("name", ["quality", "sets", "entries", "tiling", "pieces"])
def test_a_large_batch_is_worked_on_in_pieces(spark, monkeypatch, batch, name):
    for module in (quality_qda, part_join, tiling, nbest_pieces):
        monkeypatch.setattr(module, "map_arrow", lambda df, f, schema: f)
    run = _functions(spark)[name]()
    sum(part.num_rows for part in run(iter([batch.slice(0, 5)])))  # tables that stay are made
    tracemalloc.start()
    try:
        rows = 0
        for part in run(iter([batch])):
            rows += part.num_rows
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows >= batch.num_rows
    assert peak < 30 * batch.column("text").nbytes  # some 50 with slices of a million bytes


def test_bounds_of_the_cache_change_nothing(monkeypatch):
    model = nbest_pieces.load_model(MODEL)
    texts = ["some text to cut", "another text, longer than it", "some text again"] * 3
    whole = nbest_pieces.Encoder(model, 3).encode(texts)
    monkeypatch.setattr(nbest_pieces, "LIST_IDS", 0)
    monkeypatch.setattr(nbest_pieces, "CACHE_IDS", 8)
    small = nbest_pieces.Encoder(model, 3)
    got = [small.encode([t]) for t in texts]
    assert [i for g in got for i in g["ids"].tolist()] == whole["ids"].tolist()
    assert [b for g in got for b in g["best"]] == whole["best"]
    assert len(small.lists) <= 3
