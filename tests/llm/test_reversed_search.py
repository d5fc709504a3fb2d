import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketlake.llm import reversed_search as R

from .conftest import words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(docs, items, k):
    own = [(d, Counter(plain_terms(t))) for d, t in docs]
    own = [(d, c, sum(c.values())) for d, c in own if c]
    n_docs, n_terms = len(own), sum(n for _, _, n in own)
    out = []
    for item, text in items:
        terms, scored = set(plain_terms(text)), []
        for d, c, n in own:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in x for _, x, _ in own) + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    assert dict(df.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("rank", F.lit("clash")).withColumn("score", F.lit("clash"))


def test_terms():
    for t in ("Ab-c_D1 é x İ K", "", "''", "\x00\x7fa\x80", "日本 x", None):
        assert [w.decode() for w in R.terms(t)] == plain_terms(t)


@pytest.mark.parametrize("block_bytes", [4 << 20, 100])
def test_search_against_brute_force(spark, frame, odd_rows, block_bytes):
    docs = odd_rows + [(100 + i, " ".join(words(i % 37, 5 + i % 50))) for i in range(200)] + [(500 + i, "one hot copy of many") for i in range(300)]
    asked = [(i, " ".join(words(i % 37, 12))) for i in range(15)] + [(50, None), (51, "..."), (52, "nowhere"), (53, "copy of HOT"), (53, "one"), (54, "日本 line")]
    out = R.search(frame(docs, extra=True).repartition(7), items(spark, asked), k=10, block_bytes=block_bytes)
    assert found(out) == brute(docs, asked, 10)


def test_chunks_of_documents_do_not_change_scores(spark, frame):
    docs = [(i, " ".join(words(i, 30))) for i in range(60)]
    asked = [(i, " ".join(words(i, 30))) for i in range(9)]
    assert found(R.search(frame(docs), items(spark, asked), k=3, chunk=50)) == brute(docs, asked, 3)


def test_heaps_keep_the_best_with_ties():
    import numpy as np
    h = R._Heaps(2, 3)
    scores = np.array([[5, 5, 5, 5, 7, 0], [0, 0, 1, 0, 0, 0]])
    h.add(scores[:, :3], [9, 8, None])
    h.add(scores[:, 3:], [1, 4, 2])
    assert sorted(h.heaps[0], reverse=True) == [(7, -4), (5, -1), (5, -8)] and h.heaps[1] == [(1, -math.inf)]


def test_empty_tables(spark, frame):
    assert found(R.search(frame([]), items(spark, [(1, "a")]))) == []
    assert found(R.search(frame([(1, "a")]), items(spark, []))) == []
    assert found(R.search(frame([(1, None), (2, "...")]), items(spark, [(1, "a")]))) == []
