"""Line dedup over runs, and k-d tree shards."""

import hashlib
import zlib
from collections import Counter

from marketlake.llm import kd_shards, line_dedup

from conftest import SF_ORACLE
from llm.conftest import unordered, words

WS = " \t\n\x0b\f\r"


def _brute_lines(rows, min_docs, min_chars):
    fold = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(WS))
    held = Counter(k for _, t in rows for k in {fold(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if held[fold(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_lines_against_brute_force(spark, frame, odd_rows):
    common = ["Common line", "  common LINE\t", "other common", "x", ""]
    rows = odd_rows + [(100 + i, "\n".join([common[i % 5], *words(i, 3), common[(i * 3) % 5], f"own {i}", ""])) for i in range(40)]
    for batches in (1, 3, 4):
        out = line_dedup.dedup_lines(frame(rows, extra=True), min_docs=5, min_chars=2, batches=batches)
        assert [r[:3] + ((r[3] or ""),) for r in unordered(out.select("doc_id", "n_lines", "n_dropped", "text"))] == _brute_lines(rows, 5, 2)


def test_lines_empty_table(frame):
    assert line_dedup.dedup_lines(frame([])).count() == 0


def test_runs_compact_to_levels(spark):
    runs = line_dedup._Runs(spark, 3)
    for b in range(4):
        runs.add(spark.createDataFrame([(1, 1, 1), (2, b, 1)], "h1 long, h2 long, n long"))
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    assert unordered(runs.frequent()) == [(1, 1)]


def test_runs_are_merged_and_anti_joined_without_shuffling_them(spark):
    from pyspark.sql import functions as F
    runs = line_dedup._Runs(spark, 2)
    rows = spark.range(5000).select(F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(1)).alias("h2"), F.lit(1).cast("long").alias("n"))
    a, b = runs._write(rows), runs._write(rows)
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(runs._merge(a, b)) == 0 and runs._merge(a, b).filter("n = 2").count() == 5000
    both = runs._write(runs._merge(a, b))
    assert shuffles(runs._unknown(rows, both)) == 1 and runs._unknown(rows, both).count() == 0  # the batch alone is dealt out
    assert shuffles(runs._unknown(rows.limit(0).unionByName(rows), a)) == 1 and runs._unknown(rows, a).count() == 5000
    runs.close()


def test_a_later_batch_meets_the_stored_runs(spark, frame):
    from marketlake.session import fresh_path
    folder = fresh_path(spark, "test-line-runs")
    dropped = []
    for k in range(4):
        rows = [(k * 10 + i, f"common line\nown {k} {i}") for i in range(2)] + [(k * 10 + 5, None)]
        out = line_dedup.dedup_batch(frame(rows), folder, min_docs=5)
        dropped.append(sum(r["n_dropped"] for r in out.collect()))
        runs = line_dedup._Runs(spark, 5, folder)
        assert [len(x) for x in runs.levels] == [[1], [0, 1], [1, 1], [0, 0, 1]][k]
        runs.close()
    assert dropped == [0, 0, 2, 2]  # the fifth document that holds it comes with the third batch
    assert spark.sql("SHOW TABLES LIKE 'line_run_*'").count() == 0


def _size(t):
    return len((t or "").encode()) + 1


def _check_shards(rows, out, shards):
    got = out.collect()
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((_size(t), zlib.crc32((t or "").encode())) for _, t in rows)
    load = Counter()
    for s in range(shards):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
        load[s] = sum(r["size"] for r in got if r["shard"] == s)
    return load


def test_shards_sizes_and_slots(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    load = _check_shards(rows, kd_shards.kd_shards(docs, 16), 16)
    largest, mean = max(_size(t) for _, t in rows), sum(load.values()) / 16
    assert max(load.values()) - mean <= largest and mean - min(load.values()) <= largest


def test_shards_split_a_hot_group_only(frame):
    rows = [(i, "the same text in a third of all rows" if i % 3 == 0 else " ".join(words(i, 5 + i % 40))) for i in range(600)]
    out = kd_shards.kd_shards(frame(rows, extra=True), 5)
    load = _check_shards(rows, out, 5)
    assert max(load.values()) <= 1.05 * sum(load.values()) / 5
    split = Counter(r["text_crc32"] for r in out.select("text_crc32", "shard").distinct().collect())
    assert sum(v > 1 for v in split.values()) <= 4


def test_shards_odd_rows(frame, odd_rows):
    _check_shards(odd_rows, kd_shards.kd_shards(frame(odd_rows, extra=True), 3), 3)
    _check_shards(odd_rows[:2], kd_shards.kd_shards(frame(odd_rows[:2]), 4), 4)
    assert kd_shards.kd_shards(frame([]), 4).count() == 0


def test_kept_hash(spark):
    from marketlake.llm import catalog
    out = catalog.QUERIES["op4_line_dedup_runs"](spark, SF_ORACLE).limit(3).collect()
    assert all(len(r["kept_sha256"]) == len(hashlib.sha256().hexdigest()) for r in out)
