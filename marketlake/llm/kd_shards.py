"""K-d tree sharding by bytes.

The points are the rows; the coordinates are metadata columns.  A node that
holds more than one shard is cut along its widest dimension (extent against the
whole table's) at the weighted median, weight = bytes, until each leaf holds
one shard's bytes.  All nodes of a level are cut together.  A median is found
without sorting: the interval that holds it is divided into ``FAN`` buckets,
bytes are summed per (node, bucket), and the bucket of the median is divided
again; the driver sees at most nodes x FAN sums.  Order within a node is
(coordinate, text_crc32, doc_id), so equal texts, whose coordinates agree, stay
together unless a cut falls into their group: a group that holds a third of all
rows is split between shards, others stay whole.

Cases: a null text has no bytes and counts 1; null coordinates and ids come
first; rows equal in coordinate, checksum and id stand on one side of any cut;
an empty table gives no rows; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc32_text, discard, keep, literal_rows

FAN = 1024
_LOWEST = -(2 ** 63)


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _cuts(points: DataFrame, nodes: dict, extents: list[tuple[int, int]], dims: int) -> list[tuple]:
    """For each node of ``nodes`` (first shard -> number of shards) the cut
    (first, shards, dimension, coordinate, checksum, id): rows up to it go left."""
    axes = [f"d{i}" for i in range(dims)]
    stats = points.filter(F.col("k") > 1).groupBy("first").agg(
        F.sum("size").alias("bytes"), *[f(a).alias(f"{f.__name__}_{a}") for a in axes for f in (F.min, F.max)]).collect()
    live, done = {}, []
    for s in stats:
        k = nodes[s["first"]]
        # widest against the root; the earlier dimension on ties
        wide = max(range(dims), key=lambda i: ((s[f"max_d{i}"] - s[f"min_d{i}"]) / max(1, extents[i][1] - extents[i][0]), -i))
        live[s["first"]] = {"k": k, "dim": wide, "bytes": s["bytes"], "left": k // 2, "before": 0, "fixed": [],
                            "lo": s[f"min_d{wide}"], "hi": s[f"max_d{wide}"], "below": None}
    while live:
        spec = literal_rows(points.sparkSession, [
            (f, n["dim"], len(n["fixed"]), n["lo"], n["hi"], *(n["fixed"] + [0, 0, 0])[:3]) for f, n in live.items()],
            "first int, dim int, step int, lo bigint, hi bigint, f0 bigint, f1 bigint, f2 bigint")
        at = F.coalesce(*[F.when(F.col("dim") == i, F.col(a)) for i, a in enumerate(axes)])
        seen = points.filter(F.col("k") > 1).join(F.broadcast(spec), "first").select(
            "first", "step", "lo", "hi", "f0", "f1", "size", at.alias("c0"), F.col("text_crc32").alias("c1"), F.col("ord_id").alias("c2"))
        x = F.when(F.col("step") == 0, F.col("c0")).when(F.col("step") == 1, F.col("c1")).otherwise(F.col("c2"))
        inside = seen.filter(((F.col("step") < 1) | (F.col("c0") == F.col("f0"))) & ((F.col("step") < 2) | (F.col("c1") == F.col("f1")))) \
                     .withColumn("x", x).filter(F.col("x").between(F.col("lo"), F.col("hi")))
        wide = lambda c: F.col(c).cast("decimal(20,0)")  # noqa: E731  no overflow at the ends of bigint
        part = ((wide("x") - wide("lo")).cast("double") / F.greatest((wide("hi") - wide("lo")).cast("double"), F.lit(1.0)) * FAN).cast("int")
        sums = inside.withColumn("part", F.least(part, F.lit(FAN - 1))).groupBy("first", "part").agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"),
            *[f(c).alias(f"{f.__name__}_{c}") for c in ("c0", "c1", "c2") for f in (F.min, F.max)]).collect()
        by = {}
        for s in sums:
            by.setdefault(s["first"], []).append(s)
        for first, parts in by.items():
            n = live[first]
            goal = n["bytes"] * n["left"] / n["k"]
            for s in sorted(parts, key=lambda s: s["part"]):
                chosen = s
                if n["before"] + s["bytes"] >= goal:
                    break
                n["before"] += s["bytes"]
                n["below"] = (s["max_c0"], s["max_c1"], s["max_c2"]) if len(n["fixed"]) < 1 else \
                             (*n["fixed"], *(s[f"max_c{i}"] for i in range(len(n["fixed"]), 3)))
            s, step = chosen, len(n["fixed"])
            ends = [(s[f"min_c{i}"], s[f"max_c{i}"]) for i in range(3)]
            while step < 3 and ends[step][0] == ends[step][1]:
                n["fixed"].append(ends[step][0])
                step += 1
            if step == 3:  # one row, or rows that nothing tells apart: the nearer side
                right = n["before"] + s["bytes"] - goal > goal - n["before"]
                cut = (n["below"] if n["before"] else (_LOWEST, _LOWEST, _LOWEST)) if right else tuple(n["fixed"])
                done.append((first, n["k"], n["dim"], *cut))
                del live[first]
            else:
                n["lo"], n["hi"] = ends[step]
    return done


def kd_shards(docs: DataFrame, shards: int = 16, dims: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` for every row.

    ``dims``: name -> whole-number coordinate; by default language, size and
    text checksum, on which copies of a text agree.  ``slot`` numbers a shard's
    rows without gaps; it is built from counts per range partition, so no task
    holds a whole shard.
    """
    spark = docs.sparkSession
    size, crc = byte_size(F.col("text")), crc32_text(F.col("text"))
    dims = dims or {"lang": F.crc32(F.coalesce(F.col("lang"), F.lit("")).cast("binary")), "size": size, "crc": crc}
    points = keep(docs.select(
        "doc_id", size.alias("size"), crc.alias("text_crc32"), F.coalesce("doc_id", F.lit(_LOWEST)).alias("ord_id"),
        *[F.coalesce(c.cast("long"), F.lit(-1)).alias(f"d{i}") for i, c in enumerate(dims.values())],
        F.lit(0).alias("first"), F.lit(shards).alias("k")), "kd-points")  # the root node, as stored columns
    axes = [f"d{i}" for i in range(len(dims))]
    whole = points.agg(*[f(a) for a in axes for f in (F.min, F.max)]).first()
    extents = [(whole[2 * i] or 0, whole[2 * i + 1] or 0) for i in range(len(axes))]
    tree = points
    nodes = {0: shards}
    while any(k > 1 for k in nodes.values()):
        cuts = _cuts(tree, nodes, extents, len(axes))
        spec = literal_rows(spark, cuts, "first int, cut_k int, cut_dim int, cut_0 bigint, cut_1 bigint, cut_2 bigint")
        at = F.coalesce(*[F.when(F.col("cut_dim") == i, F.col(a)) for i, a in enumerate(axes)])
        left = F.struct(at.alias("a"), F.col("text_crc32").alias("b"), F.col("ord_id").alias("c")) <= \
            F.struct(F.col("cut_0").alias("a"), F.col("cut_1").alias("b"), F.col("cut_2").alias("c"))
        half = F.floor(F.col("cut_k") / 2).cast("int")
        tree = tree.join(F.broadcast(spec), "first", "left").select(
            "doc_id", "size", "text_crc32", "ord_id", *axes,
            F.when(F.col("cut_k").isNull() | left, F.col("first")).otherwise(F.col("first") + half).alias("first"),
            F.when(F.col("cut_k").isNull(), F.col("k")).when(left, half).otherwise(F.col("cut_k") - half).alias("k"))
        nodes = {f: k for first, k0 in nodes.items() for f, k in ([(first, k0)] if k0 == 1 else [(first, k0 // 2), (first + k0 // 2, k0 - k0 // 2)])}
    placed = _slots(tree.select("doc_id", "size", "text_crc32", "ord_id", F.col("first").alias("shard")))
    discard(points)
    return placed


def _slots(placed: DataFrame) -> DataFrame:
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keep(placed.repartitionByRange(parts, "shard", "text_crc32", "ord_id").withColumn("part", F.spark_partition_id()), "kd-placed")
    # one row per (shard, partition): at most partitions + shards rows
    counts = ranged.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "part", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("text_crc32", "ord_id"))
    return ranged.withColumn("place", place).join(F.broadcast(before), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place") - 1).cast("long").alias("slot"))
