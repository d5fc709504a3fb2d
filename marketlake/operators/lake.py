"""Lake monitoring and retention.

The manifest is a DataFrame ``(layer, dataset, rows, bytes, format,
written_at)`` unique on ``(layer, dataset)``; recording a write is an upsert
(I1).  Row counts come from ``Observation`` during the write itself, so no
second pass over the data is needed.
"""

from __future__ import annotations

import functools
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config, storage
from .quality import DataQualityError, Rule
from .warehouse import upsert_update

MANIFEST_SCHEMA = "layer string, dataset string, rows bigint, bytes bigint, format string, written_at timestamp"


def clustered(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt out by the partition columns of a write that follows: small partitions are put together and
    large ones split by Spark's advisory size, so that files follow bytes and not tasks x partitions."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def gated_write(df: DataFrame, rules: list[Rule], root: str, layer: str, name: str, partition_by: list[str],
                aside: Column | None = None) -> dict:
    """H7 + A6: write a dataset and check its contract in the same pass.

    Every row goes to a staged folder as kept, set ``aside`` (a predicate) or refused (breaks a rule), and
    the rules are counted while the rows are written.  Without a refused row the kept ones replace
    ``<layer>/<name>`` and the others ``<layer>_aside/<name>``; else the refused rows go to
    ``quarantine/<layer>/<name>``, nothing else changes and ``DataQualityError`` is raised.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    staged = f"{root}/_staged/{layer}-{name}-{uuid.uuid4().hex[:12]}"
    missing = [c for c in {r.column for r in rules} - {"*"} if c not in df.columns]
    if missing:
        raise DataQualityError(f"{layer}:{name}: missing {sorted(missing)}")
    put_aside = F.coalesce(aside, F.lit(False)) if aside is not None else F.lit(False)
    breaks = {f"r{i}": ~put_aside & ~F.coalesce(r.ok, F.lit(False)) for i, r in enumerate(rules)}
    fate = F.when(put_aside, "aside").when(functools.reduce(Column.__or__, breaks.values(), F.lit(False)), "refused").otherwise("kept")
    obs = Observation(f"gate_{layer}_{name}_{uuid.uuid4().hex[:8]}")
    (clustered(df.withColumn("_fate", fate), "_fate", *partition_by)
        .observe(obs, F.count_if(F.col("_fate") == "kept").alias("kept"), *[F.count_if(b).alias(k) for k, b in breaks.items()])
        .write.partitionBy("_fate", *partition_by).parquet(staged))
    found = obs.get
    broken = [(r.column, r.check, found[f"r{i}"]) for i, r in enumerate(rules) if found[f"r{i}"]]
    fates = {p.rsplit("=", 1)[1]: p for p in storage.folders(spark, f"{staged}/_fate=*")}
    target = f"{root}/{layer}/{name}"
    if broken:
        storage.move(spark, fates["refused"], f"{root}/quarantine/{layer}/{name}")
        storage.remove(spark, staged)
        raise DataQualityError(f"data quality failed on '{layer}:{name}': " + "; ".join(f"{c}/{k}={n}" for c, k, n in broken))
    for key, path in (("kept", target), ("aside", f"{root}/{layer}_aside/{name}")):
        if key in fates:
            storage.move(spark, fates[key], path)
        elif key == "kept" or aside is not None:  # no such row: an empty dataset of the same columns
            df.limit(0).write.mode("overwrite").parquet(path)
    storage.remove(spark, staged)
    return manifest_record(layer, name, int(found["kept"]), storage.folder_bytes(spark, target))


def write_layer(df: DataFrame, root: str, layer: str, name: str, partition_by: list[str] | None = None) -> dict:
    """Overwrite one layer dataset and return its manifest record.

    The row count is observed while writing (no extra job over the data), the
    size is the file system's; ``partition_by`` enables partition pruning for date filters."""
    obs = Observation(f"rows_{layer}_{name}".replace("/", "_"))
    if partition_by:
        df = clustered(df, *partition_by)
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    path = f"{root.rstrip('/')}/{layer}/{name}"
    w.parquet(path)
    return manifest_record(layer, name, int(obs.get["rows"]), storage.folder_bytes(df.sparkSession, path))


def manifest_record(layer: str, name: str, rows: int, size: int) -> dict:
    return {"layer": layer, "dataset": name, "rows": rows, "bytes": size,
            "format": "parquet", "written_at": datetime.now(timezone.utc).replace(microsecond=0)}


def read_layer(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A5: one written dataset by name."""
    return spark.read.parquet(f"{root.rstrip('/')}/{layer}/{name}")


def record(spark: SparkSession, manifest: DataFrame | None, records: list[dict]) -> DataFrame:
    """K1: upsert write records into the manifest on ``(layer, dataset)``."""
    batch = spark.createDataFrame([tuple(r[k] for k in ("layer", "dataset", "rows", "bytes", "format", "written_at"))
                                   for r in records], MANIFEST_SCHEMA)
    if manifest is None:
        return batch
    return upsert_update(manifest, batch, ["layer", "dataset"])


def layer_totals(manifest: DataFrame) -> DataFrame:
    """Datasets and rows per layer (missing row counts as 0)."""
    return (manifest.groupBy("layer")
            .agg(F.count(F.lit(1)).cast("bigint").alias("datasets"),
                 F.sum(F.coalesce(F.col("rows"), F.lit(0))).cast("bigint").alias("rows")))


def manifest_report(manifest: DataFrame) -> DataFrame:
    """K2: per layer then dataset, sorted; layer totals beside each dataset."""
    t = layer_totals(manifest).withColumnRenamed("rows", "layer_rows")
    return (manifest.join(t, "layer")
            .select("layer", "datasets", "layer_rows", "dataset", "rows",
                    (F.coalesce(F.col("bytes"), F.lit(0)) / 1024).alias("kb"), "format")
            .orderBy("layer", "dataset"))


def retention_tier(layer: Column, age_days: Column) -> Column:
    """K4: storage tier from the lifecycle rules (bronze cold 30 d, expired
    90 d; silver cold 30 d; gold cold 90 d, never expired)."""
    expr = None
    for name, (cold, expire) in config.RETENTION.items():
        tier = F.when(F.lit(expire is not None) & (age_days >= F.lit(expire or 0)), F.lit("expired")) \
                .when(age_days >= cold, F.lit("cold")).otherwise(F.lit("hot"))
        expr = F.when(layer == name, tier) if expr is None else expr.when(layer == name, tier)
    return expr


def retention_plan(objects: DataFrame, layer: str, written: str, now: Column) -> DataFrame:
    """K4: tier of every stored object at ``now``; expired objects are the
    deletion list (filter ``tier != 'expired'`` to keep the rest)."""
    age = F.datediff(now, F.to_date(F.col(written)))
    return objects.withColumn("age_days", age).withColumn("tier", retention_tier(F.col(layer), age))
