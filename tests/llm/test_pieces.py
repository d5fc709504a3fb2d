"""N-best segmentation against enumeration, and exact decoding."""

import os

import pytest
import sentencepiece
from pyspark.sql import functions as F

from marketlake.llm import nbest_pieces as N

MODEL = os.environ.get("CORPUS_TOKENIZERS", "/opt/tokenizers") + "/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def model():
    return N.load_model(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _enumerate(text, model, sp):
    """All segmentations with their scores, best first."""
    words = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in range(len(sp)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    s = "▁" + text.replace(" ", "▁")
    ways = [[(0.0, ())]] + [[] for _ in s]
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - 16), j):
            if s[i:j] in words:
                ways[j] += [(a + words[s[i:j]][1], b + (words[s[i:j]][0],)) for a, b in ways[i]]
            elif j - i == 1:
                ways[j] += [(a + model.unknown, b + tuple(int(model.byte_ids[x]) for x in s[i:j].encode())) for a, b in ways[i]]
    return sorted(ways[-1], key=lambda w: -w[0])


def _all(best, score, alternatives):
    out = [(score, tuple(best))]
    for s, edits in alternatives:
        ids = list(best)
        for at, drop, new in sorted(edits, key=lambda e: -e[0]):
            ids[at:at + drop] = new
        out.append((s, tuple(ids)))
    return out


@pytest.mark.parametrize("text", ["hello wor", "the cat", "a  b", "日本語x", "naïve☃", "x\ny z", "in the end", "tion", "  ", "isn't it"])
def test_n_best_against_enumeration(model, library, text):
    for n in (2, 4, 9):
        got = N.Encoder(model, n).encode([text])
        mine = _all(got["ids"].tolist(), float(got["score"][0]), got["best"][0])
        ways = _enumerate(text, model, library)
        assert [round(a, 6) for a, _ in mine] == [round(a, 6) for a, _ in ways[:n]]
        assert len({w for _, w in mine}) == len(mine) and {w for _, w in mine} <= {w for _, w in ways}


def test_spark_round_trip(spark, frame, odd_rows, model, library):
    docs = frame(odd_rows, extra=True)
    out = N.decode(N.encode(docs, model, n_best=3), model)
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        text = r["text"] or ""
        assert r["round_trip"] and r["decoded"] == text
        assert len(r["alternatives"]) <= 2 and all(a["score"] <= r["piece_score"] for a in r["alternatives"])
        if text and "▁" not in text:
            assert library.decode(list(r["piece_ids"])) == text
    assert N.encode(frame([]), model).count() == 0
    assert N.decode(spark.createDataFrame([(1, None), (2, [])], "i long, piece_ids array<int>"), model) \
        .orderBy("i").select(F.col("decoded")).collect() == [(None,), ("",)]


def test_cache_limit_changes_nothing(model, monkeypatch):
    texts = ["some text to cut", "another text, longer than it", "some text again"] * 3
    whole = N.Encoder(model, 3).encode(texts)
    monkeypatch.setattr(N, "CACHE_CHUNKS", 1)
    small = N.Encoder(model, 3)
    ids = [i for t in texts for i in small.encode([t])["ids"].tolist()]
    assert ids == whole["ids"].tolist()
