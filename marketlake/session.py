"""Spark session for the engine.

UTC session time zone, ANSI mode, AQE with partition coalescing and skew-join
splitting.  On a cluster the session already exists and is passed in; these
settings are only applied when we build a local one (tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# HotSpot never compiles a method of more than this many bytes of code; it stays interpreted, some three
# times slower.  A stage whose generated method is larger runs by its operators' own (split) projections.
COMPILED_METHOD_BYTES = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def keep_compiled(spark: SparkSession) -> SparkSession:
    """Have Spark generate no method that the JVM would interpret; a lower limit of the session's stays."""
    if int(spark.conf.get(_METHOD_LIMIT)) > COMPILED_METHOD_BYTES:
        spark.conf.set(_METHOD_LIMIT, str(COMPILED_METHOD_BYTES))
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "marketlake", driver_memory: str | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024)))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``.  Where it is unset, a
    local session (one machine) gets a fresh scratch folder; on a cluster each
    executor would write to a disk of its own, so there it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not d:
        if sc is None or not (sc.master.startswith("local[") or sc.master == "local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="marketlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder name below the shared checkpoint folder that nobody used yet."""
    import uuid
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: one computation, lineage cut, values (including any partition-
    dependent ids) fixed on disk.  Used where a result is consumed several
    times and must be identical each time, even if executors are lost."""
    spark = df.sparkSession
    path = fresh_path(spark, f"mat-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
