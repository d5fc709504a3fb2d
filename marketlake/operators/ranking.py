"""Dense global ordinals without a single-partition window.

``row_number() over (order by k)`` with no partition moves every row to one
task.  ``global_index`` range-sorts instead (Spark samples the key to split it
evenly), numbers rows inside each partition with
``monotonically_increasing_id``, and adds per-partition offsets computed from
one count per partition (a table with one row per partition: bounded and
broadcast).  This is the DataFrame form of ``zipWithIndex``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_PART_SHIFT = 1 << 33


def global_index(df: DataFrame, order: list, name: str = "idx", start: int = 1) -> DataFrame:
    """``df`` plus ``name`` = position in ``order`` (dense, from ``start``).

    Ties in ``order`` are numbered in an arbitrary but stable order; pass a
    total order for deterministic ids.
    """
    s = df.orderBy(*order)
    s = s.withColumn("_pid", F.spark_partition_id()) \
         .withColumn("_pos", F.monotonically_increasing_id() - F.col("_pid").cast("long") * _PART_SHIFT)
    s = materialize(s, "indexed")  # positions become stored values (see quantiles)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pn"))
    offs = counts.select(
        "_pid",
        F.coalesce(F.sum("_pn").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offs), "_pid")
             .withColumn(name, F.col("_off") + F.col("_pos") + F.lit(start))
             .drop("_pid", "_pos", "_off"))
