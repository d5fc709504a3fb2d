import zlib

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Word list of the made-up texts.
WORDS = [a + b for a in ("ba", "do", "fe", "gi", "lu", "mo", "na", "pe", "ri", "su") for b in ("l", "m", "n", "r", "s", "t", "x", "z")]


def words(seed: int, n: int) -> list[str]:
    """n words, always the same for a seed."""
    return [WORDS[zlib.crc32(f"{seed} {i}".encode()) % len(WORDS)] for i in range(n)]


@pytest.fixture(scope="session")
def frame(spark):
    """frame(rows): documents from (doc_id, text) pairs, with extra columns whose names operators use inside."""
    from pyspark.sql import functions as F

    def make(rows, extra=False):
        rows = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(rows, DOC_SCHEMA)
        if extra:
            for name in ("row", "n", "lines", "cid", "x", "score", "row_key", "kept", "n_lines", "part", "size", "shard",
                         "quality_score", "toxicity_score", "piece_ids", "h1", "drop_pos", "digest"):
                df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, repeated and long texts; null and repeated ids."""
    long_text = " ".join(words(1, 6000))
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "same text here and there now"), (6, "same text here and there now"),
            (6, "same text here and there now"), (None, "no id at all in this row"), (8, long_text), (9, "Ünïcode ▁ tèxt 日本 🙂\nline")]


def unordered(df):
    return sorted(map(tuple, df.collect()), key=str)
