"""Exact grouped percentiles without sending a group to one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer.  Here equal values are folded first and ranks are counted:

1. ``(keys, value)`` is aggregated to a count and partial sums, combined before
   the shuffle: however many rows tie, they become one row;
2. the folded rows are range-partitioned on the whole ``(keys, value)``, so a
   hot group is spread by value, and written once with their partition number;
3. counts run within a partition; a group that spans partitions (at most one
   begins in each: a proven bound, broadcast) adds the counts before it;
4. a folded row knows the ranks it covers, so the rows that hold a wanted rank
   are picked in the same aggregation that merges the partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


def _ranks(p: float, n: Column, mode: str) -> tuple[Column, Column, Column]:
    """0-based ranks below and above the p-quantile of n values, and the way between them."""
    pos = F.lit(float(p)) * (n - 1).cast("double")
    if mode == "cont":
        return F.floor(pos), F.ceil(pos), pos - F.floor(pos)
    # nearest rank, k = round_half_up(p * (n - 1)) clamped to [0, n-1]
    k = F.least(F.greatest(F.floor(pos + 0.5), F.lit(0)), n - 1)
    return k, k, F.lit(0.0)


def folded_ranks(df: DataFrame, keys: list[str], value: str, aggs: dict[str, tuple[str, Column]], weight: str | None = None) -> DataFrame:
    """One row per ``(keys, value)``: ``_c`` rows, partial ``aggs``, ``_before`` (rows of
    the group with smaller values) and ``_n`` (rows of the group with a value)."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_w"),
                     *[c.alias(f"_in_{name}") for name, (_, c) in aggs.items()])
    folded = rows.groupBy(*keys, "_v").agg(F.sum("_w").alias("_c"), *[_MERGE[how](f"_in_{name}").alias(name) for name, (how, _) in aggs.items()])
    placed = materialize(folded.orderBy(*[F.col(k).asc_nulls_first() for k in keys], F.col("_v").asc_nulls_first())
                               .withColumn("_pid", F.spark_partition_id()), "folded")
    ranked = F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0)
    part = Window.partitionBy("_pid", *keys)
    local = placed.withColumn("_run", F.sum(ranked).over(part.orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))) \
                  .withColumn("_own", F.sum(ranked).over(part))
    # groups that span partitions: what lies before a partition, and the whole
    over = Window.partitionBy(*keys)
    parts = placed.groupBy("_pid", *keys).agg(F.sum(ranked).alias("_pc"))
    spans = parts.select("_pid", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                         F.sum("_pc").over(over.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"),
                         F.sum("_pc").over(over).alias("_all"), F.count(F.lit(1)).over(over).alias("_parts")) \
                 .filter("_parts > 1").withColumnRenamed("_pid", "_kp")
    same = (F.col("_pid") == F.col("_kp"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(F.broadcast(spans), same, "left")
    return joined.select(*keys, "_v", "_c", *aggs, (F.coalesce("_run", F.lit(0)) + F.coalesce("_earlier", F.lit(0))).alias("_before"),
                         F.coalesce("_all", "_own").alias("_n"))


def grouped_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                        aggs: dict[str, tuple[str, Column]] | None = None, mode: str = "cont",
                        weight: str | None = None) -> DataFrame:
    """Per group of ``keys``: exact percentiles of ``value`` plus ``aggs``.

    ``mode='cont'`` interpolates linearly (``percentile_cont``); ``'nearest'``
    picks rank ``round(p*(n-1))`` (half-up).  Null values are ignored; a group
    whose values are all null still appears, with null percentiles.  With no
    keys, one row is returned even for empty input.  ``aggs``: name -> ('sum',
    'max' or 'min', column of ``df``), mergeable so that they fold along.  ``weight``
    names a column of counts where ``df`` is folded already.
    """
    aggs = aggs or {}
    ranked = folded_ranks(df, keys, value, aggs, weight)
    held = lambda rank: F.max(F.when((rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_c")) & F.col("_v").isNotNull(), F.col("_v")))
    picks = []
    for name, p in probs.items():
        low, high, way = _ranks(p, F.col("_n"), mode)
        picks += [held(low).alias(f"_lo_{name}"), held(high).alias(f"_hi_{name}"), F.max(way).alias(f"_way_{name}")]
    got = ranked.groupBy(*keys).agg(*[_MERGE[how](name).alias(name) for name, (how, _) in aggs.items()], *picks)
    return got.select(*keys, *aggs, *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_way_{n}")).alias(n) for n in probs])
