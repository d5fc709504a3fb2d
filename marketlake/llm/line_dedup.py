"""Line deduplication over levelled sorted runs of line hashes.

The documents come in batches.  A run is a table of (line hash, number of
documents), bucketed and sorted by hash, so that runs are merged and
anti-joined bucket by bucket: a run is never shuffled again, only a new batch's
counts are dealt to the buckets, once.  (Spark sorts a bucket anew unless
``spark.sql.legacy.bucketedTableScan.outputOrdering`` is set, since a bucket may
have several files; the rows are in order then.)  Each new batch

1. is merge-anti-joined with the runs: a line that some run already counts in
   ``min_docs`` documents needs no further count;
2. adds its remaining counts as a run of level 0.

Two runs of one level are compacted into one of the next, so a batch meets at
most log2(batches) runs.  The last compaction gives the lines found in at least
``min_docs`` documents; all their occurrences are dropped from every document.

Cases: a null or empty text is one empty line and stays (its ``text`` is not
changed when nothing is dropped); lines whose key has fewer than ``min_chars``
code points are never counted; a document counts once for a line however often
it holds it; equal rows are separate documents; a null ``doc_id`` is a document
as any other; a text that loses all its lines becomes empty.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from .common import ASCII_WS, ascii_lower, discard, keep, new_folder


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_WS)))


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2"))


class _Runs:
    """Levelled runs; every run is a table in the shared folder, bucketed and sorted by both halves of the hash.

    Runs of one number of buckets merge bucket by bucket.  With a ``folder`` the levels are kept: their paths are
    an entry of a log there, and a later call goes on with them.
    """

    def __init__(self, spark, min_docs: int, folder: str | None = None):
        self.spark, self.min_docs, self.folder, self.levels, self.tables = spark, min_docs, folder, [], {}
        self.buckets, self.entry = int(spark.conf.get("spark.sql.shuffle.partitions")), 0
        if folder:
            self.entry, text = storage.last_numbered(spark, folder)
            held = json.loads(text) if text else {"buckets": self.buckets, "levels": []}
            self.buckets = held["buckets"]
            self.levels = [[self._open(path) for path in level] for level in held["levels"]]

    def _open(self, path: str) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, n BIGINT) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self._table(name, path)

    def _table(self, name: str, path: str) -> DataFrame:
        run = self.spark.table(name)
        run.run_name = name
        self.tables[name] = path
        return run

    def _write(self, counts: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        path = new_folder(self.spark, name) if not self.folder else f"{self.folder}-{name}"
        (counts.repartition(self.buckets, "h1", "h2").write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
               .option("compression", "zstd").option("path", path).saveAsTable(name))
        return self._table(name, path)

    def _merge(self, a: DataFrame, b: DataFrame) -> DataFrame:
        n = lambda t: F.coalesce(t["n"], F.lit(0))
        return a.join(b.hint("merge"), ["h1", "h2"], "full_outer").select("h1", "h2", (n(a) + n(b)).alias("n"))

    def _unknown(self, counts: DataFrame, run: DataFrame) -> DataFrame:
        """Counts of lines that ``run`` does not hold often enough already: a merge-anti-join by bucket."""
        known = run.filter(F.col("n") >= self.min_docs).hint("merge")
        return counts.join(known, ["h1", "h2"], "left_anti")

    def add(self, counts: DataFrame) -> None:
        for level in self.levels:
            for run in level:
                counts = self._unknown(counts, run)
        self._put(self._write(counts), 0)

    def _put(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == 2:
            a, b = self.levels[level]
            self.levels[level] = []
            self._put(self._write(self._merge(a, b)), level + 1)

    def commit(self) -> None:
        """Make the levels those that the next call finds."""
        levels = [[self.tables[run.run_name] for run in level] for level in self.levels]
        if storage.append_entry(self.spark, self.folder, json.dumps({"buckets": self.buckets, "levels": levels}), self.entry) is None:
            raise RuntimeError(f"another batch was added to {self.folder} meanwhile")

    def close(self) -> None:
        """Drop the tables, and the files of those runs that no level holds any more."""
        stay = {self.tables[run.run_name] for level in self.levels for run in level} if self.folder else set()
        for name, path in self.tables.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            if path not in stay:
                storage.remove(self.spark, path)

    def frequent(self) -> DataFrame:
        """Hashes counted in at least ``min_docs`` documents over all runs, written once; the runs are closed."""
        runs = [r for level in self.levels for r in level]
        total = runs[0]
        for r in runs[1:]:
            total = self._merge(total, r)
        out = keep(total.filter(F.col("n") >= self.min_docs).select("h1", "h2"), "line-frequent")
        if self.folder:
            self.commit()
        self.close()
        return out


def frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4) -> DataFrame:
    """Hashes (h1, h2) of the line keys that at least ``min_docs`` rows of ``docs`` hold."""
    keys = F.array_distinct(F.transform(lines_of(F.col("text")), line_key))
    # equal texts fall into different batches by doc_id; one scan writes the counts of all batches
    lines = (docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"), F.explode(keys).alias("key"))
                 .filter(F.char_length("key") >= min_chars)
                 .select("batch", _hash(F.col("key")).alias("h")).select("batch", "h.*"))
    counts = keep(lines.groupBy("batch", "h1", "h2").agg(F.count(F.lit(1)).alias("n")), "line-counts")
    runs = _Runs(docs.sparkSession, min_docs)
    for b in range(batches):
        runs.add(counts.filter(F.col("batch") == b).select("h1", "h2", "n"))
    frequent = runs.frequent()
    discard(counts)
    return frequent


def dedup_batch(docs: DataFrame, folder: str, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """One more batch of a growing corpus: its line counts join the runs kept under ``folder``, and it loses the
    lines that the batches so far hold in ``min_docs`` documents.  Earlier batches are not read again."""
    keys = F.array_distinct(F.transform(lines_of(F.col("text")), line_key))
    lines = docs.select(F.explode(keys).alias("key")).filter(F.char_length("key") >= min_chars).select(_hash(F.col("key")).alias("h")).select("h.*")
    runs = _Runs(docs.sparkSession, min_docs, folder)
    runs.add(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")))
    return _drop_lines(docs, runs.frequent(), min_chars)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4) -> DataFrame:
    """``docs`` with the frequent lines dropped from ``text``, plus ``n_lines`` (before) and ``n_dropped``.

    Other columns pass unchanged.  Texts move once, and only those that lose a line are cut anew.
    """
    return _drop_lines(docs, frequent_lines(docs, min_docs, min_chars, batches), min_chars)


def _drop_lines(docs: DataFrame, frequent: DataFrame, min_chars: int) -> DataFrame:
    # a row's key: rows with equal id and text lose the same lines, so they may share it
    key = lambda: F.struct(F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64("text", "doc_id", F.lit(1)).alias("r2"))
    keys = F.transform(lines_of(F.col("text")), line_key)
    found = (docs.select(key().alias("r"), F.posexplode(keys).alias("pos", "key"))
                 .filter(F.char_length("key") >= min_chars)
                 .select("r.r1", "r.r2", "pos", _hash(F.col("key")).alias("h")).select("r1", "r2", "pos", "h.*"))
    drops = (found.join(frequent, ["h1", "h2"], "left_semi")
                  .groupBy("r1", "r2").agg(F.collect_set("pos").alias("drop_pos")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key().alias("r")).select("row", "r.r1", "r.r2")
    joined = rows.join(drops, ["r1", "r2"], "left")
    lines = lines_of(F.col("row.text"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop_pos"))
    kept = F.when(F.col("drop_pos").isNull(), F.col("row.text")) \
            .otherwise(F.concat_ws("\n", F.transform(stay, lambda i: F.col("lines")[i])))
    cut = joined.select("row", "drop_pos", lines.alias("lines")).select(
        "row", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop_pos"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
    return cut.select(*[F.col("kept").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns
                        if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
