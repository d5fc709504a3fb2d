"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are drawn from the vectors by a hash.  A vector is
described by its ``prefix`` nearest pivots; the inverted lists are kept by
pairs of pivots, so two vectors meet in a list when they share at least two
pivots.  Lists longer than ``block`` are cut into blocks and every two blocks
form a group of their own: no task holds a whole long list.  In a group cosines
are taken in double precision; a pair that meets in several lists counts in the
list of its two smallest shared pivots alone.  Equal vectors are one class
beforehand.  Out of a group come sums and a spanning forest, never its pairs.

Cases: a vector that is null, zero, or holds null or non-finite components, and
one with a null label, links with nothing and is its own component; vectors of
different length are not compared; equal rows are vectors of one class and link
with each other; a null vec_id can be linked, and counts, but never names a
component unless all its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, map_arrow
from .components import components


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix of unit rows."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def postings(classes: DataFrame, pivots: dict[int, np.ndarray], prefix: int) -> DataFrame:
    """(cid, n, label, embedding, near, p, q) for every pair p < q of the nearest pivots of a class."""
    held = classes.sparkSession.sparkContext.broadcast(pivots)  # at most MOST_PIVOTS vectors

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                ref = held.value.get(int(size))
                if ref is None or len(ref) < 2:
                    near = np.zeros((part.num_rows, 1), np.int32)
                    first = last = np.zeros(1, int)
                else:
                    k = min(prefix, len(ref))
                    x = _rows(part.column("embedding"))
                    # ties between pivots go to the earlier one
                    near = np.sort(np.argsort(-(x @ ref.T), axis=1, kind="stable")[:, :k], axis=1).astype(np.int32)
                    first, last = np.triu_indices(k, 1)
                n, pairs = part.num_rows, len(first)
                take = pa.array(np.repeat(np.arange(n), pairs))
                kept = part.take(take)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32)), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, lists.take(take), pa.array(near[:, first].ravel()), pa.array(near[:, last].ravel())],
                    names=[*part.schema.names, "near", "p", "q"])

    return map_arrow(classes, describe, "cid bigint, n bigint, label int, embedding array<float>, near array<int>, p int, q int")


def _links(least: float):
    """Sums of links and a spanning forest over whole groups (g1, g2 tell them apart) in sorted order."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = pc.list_value_length(table.column("embedding")).to_numpy()
        for size in np.unique(sizes):  # a group's vectors are of one length, its neighbours' may differ
            if (out := of_length(table.filter(pa.array(sizes == size)).combine_chunks())) is not None:
                yield out

    def of_length(held: pa.Table) -> pa.RecordBatch | None:
        col = lambda c: held.column(c).to_numpy()
        cid, n, side, q = col("cid"), col("n"), col("side"), col("q")
        g = np.flatnonzero(np.concatenate(([True], (np.diff(col("g1")) != 0) | (np.diff(col("g2")) != 0))))
        size = np.diff(np.append(g, len(cid)))
        after = np.repeat(g + size, size) - np.arange(len(cid)) - 1  # rows that follow in the group
        emb = held.column("embedding").chunk(0)
        near = held.column("near").chunk(0)
        x = _rows(emb)
        top = near.flatten().to_numpy().reshape(len(cid), -1)
        us, vs = [], []
        cut = np.cumsum(after)
        row = 0
        while row < len(cid):
            to = max(row + 1, int(np.searchsorted(cut, (cut[row - 1] if row else 0) + 200_000, "right")))
            u = np.repeat(np.arange(row, to), after[row:to])
            v = u + 1 + np.arange(len(u)) - np.repeat(np.cumsum(after[row:to]) - after[row:to], after[row:to])
            ok = (side[u] != side[v]) | (side[u] == 2)
            u, v = u[ok], v[ok]
            hit = np.einsum("ij,ij->i", x[u], x[v]) >= least
            u, v = u[hit], v[hit]
            # the list of the two smallest shared pivots owns the pair
            shared = (top[u][:, :, None] == top[v][:, None, :]).any(2)
            own = (shared & (top[u] < q[u][:, None])).sum(1) <= 1
            us.append(u[own])
            vs.append(v[own])
            row = to
        u, v = np.concatenate(us), np.concatenate(vs)
        if not len(u):
            return None
        ids, at = np.unique(cid, return_inverse=True)
        a, b = at[u], at[v]
        links = np.bincount(a, n[v], len(ids)) + np.bincount(b, n[u], len(ids))
        root = np.arange(len(ids))
        while True:  # smallest id reachable within these rows
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        met = np.flatnonzero(links)
        return pa.RecordBatch.from_pydict({"cid": ids[met], "links": links[met].astype(np.int64), "root": ids[root[met]]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
            g1, g2 = table.column("g1").to_numpy(), table.column("g2").to_numpy()
            last = np.flatnonzero((np.diff(g1) != 0) | (np.diff(g2) != 0))
            if not len(last):
                left = table
                continue
            whole, left = table.slice(0, last[-1] + 1), table.slice(last[-1] + 1)
            yield from work(whole)
        if left is not None and left.num_rows:
            yield from work(left)

    return run


def near_vectors(vectors: DataFrame, least: float = 0.93, pivots: int | None = None, prefix: int = 8,
                 block: int = 512, most_pivots: int = 1024) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label).

    ``pivots``: their number for each vector length; by default the root of the
    number of classes, at least 64 and at most ``most_pivots``.  The sample is
    the ``pivots`` classes with the smallest hashes.
    """
    spark = vectors.sparkSession
    ok = F.col("label").isNotNull() & F.coalesce(
        ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("embedding", lambda v: v != 0), F.lit(False))
    cid = F.xxhash64("label", "embedding")
    rows = vectors.select("vec_id", F.when(ok, cid).alias("cid"))
    classes = keep(vectors.filter(ok).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id"))
                          .select(cid.alias("cid"), "n", "least_id", F.col("label").cast("int").alias("label"),
                                  F.col("embedding").cast("array<float>").alias("embedding")), "vector-classes")
    count = classes.count()
    m = pivots or min(most_pivots, max(64, math.isqrt(count)))
    sizes = [r[0] for r in classes.select(F.size("embedding").alias("s")).distinct().limit(64).collect()]
    points = {}
    for s in sizes:
        got = classes.filter(F.size("embedding") == s).orderBy(F.xxhash64("cid"), "cid").limit(m).select("embedding").collect()
        x = np.array([r[0] for r in got], np.float64)
        x = x / np.abs(x).max(1, keepdims=True)
        points[s] = x / np.sqrt((x * x).sum(1, keepdims=True))
    listed = postings(classes.select("cid", "n", "label", "embedding"), points, prefix)
    key = ["label", "dim", "p", "q"]
    listed = listed.withColumn("dim", F.size("embedding"))
    counts = listed.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    dealt = listed.join(counts, key).withColumn("blocks", F.ceil(F.col("members") / block).cast("int")) \
                  .withColumn("own", F.pmod(F.xxhash64("cid", "p"), F.col("blocks")).cast("int"))
    # block i meets block j >= i; within one block (side 2) all pairs, else pairs across (sides 0 and 1)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = dealt.withColumn("other", other).select(
        "cid", "n", "embedding", "near", "q",
        F.xxhash64(*key, F.least("own", "other"), F.greatest("own", "other")).alias("g1"),
        F.xxhash64(F.greatest("own", "other"), F.least("own", "other"), *key).alias("g2"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    sorted_ = grouped.repartition("g1", "g2").sortWithinPartitions("g1", "g2", "side", "cid")
    found = keep(map_arrow(sorted_, _links(least), "cid bigint, links bigint, root bigint"), "vector-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    of_class = classes.select("cid", "n", "least_id").join(comp.withColumnRenamed("node", "cid"), "cid", "left") \
                      .withColumn("component", F.coalesce("component", "cid")).join(links, "cid", "left")
    named = of_class.groupBy("component").agg(F.min("least_id").alias("component_id"))
    per_class = of_class.join(named, "component").select("cid", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.join(per_class, "cid", "left")
    comp_id = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"),
                      F.col("vec_id").eqNullSafe(comp_id).alias("kept"))
