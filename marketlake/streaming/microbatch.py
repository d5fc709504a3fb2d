"""Micro-batches and streams.

A micro-batch is one day of offers: validate -> silver increment -> fact ->
validate -> upsert -> watermark (``run_day``).  The same gates and upsert run
inside ``foreachBatch`` of a Structured Streaming query (file source,
availableNow trigger); the caller's checkpoint gives at-least-once delivery, and
the upsert keyed by the grain makes a replay harmless (idempotent).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config, storage
from ..functions import cents
from ..operators import cleaners, gold, indicators, lake, quality, warehouse
from ..session import fresh_path, materialize


def fresh_since(silver: DataFrame, watermark: str, one_day: bool = False) -> DataFrame:
    """Offers newer than the watermark (design) or exactly the next day
    (code).  On a table partitioned by ``date_posted`` this prunes partitions."""
    if one_day:
        nxt = F.date_add(F.to_date(F.lit(watermark)), 1).cast("string")
        return silver.where(F.col("date_posted") == nxt)
    return silver.where(F.col("date_posted") > F.lit(watermark))


def micro_batch(target_fact: DataFrame, batch_silver: DataFrame, seq: str | None = None) -> DataFrame:
    """I6 (data part): build the batch fact (no C1 filter on this path) and
    upsert it into the target fact at the grain."""
    batch_fact = gold.build_fact(gold.salary_frame(batch_silver))
    if seq:
        batch_fact = batch_fact.withColumn(seq, F.lit(0))
    return warehouse.upsert_fact(target_fact, batch_fact, config.FACT_GRAIN, seq)


def gate_batch(batch_silver: DataFrame, name: str = "increment") -> DataFrame:
    """I6 gates: the silver contract on the increment, the fact contract on its
    fact; raises ``DataQualityError``.  Returns the fact."""
    quality.gate(quality.violation_counts(batch_silver, quality.silver_salary_rules()), name)
    batch_fact = gold.build_fact(gold.salary_frame(batch_silver))
    quality.gate(quality.violation_counts(batch_fact, quality.gold_fact_rules()), f"{name}-fact")
    return batch_fact


def upsert_days(spark: SparkSession, root: str, batch_fact: DataFrame) -> list[str]:
    """I3 into the fact stored by ``date_posted`` under ``root``: only the days of
    the batch are read and overwritten.  Returns those days."""
    path = f"{root.rstrip('/')}/fact"
    batch = materialize(batch_fact, "batch-fact")
    days = [r[0] for r in batch.select("date_posted").distinct().collect()]  # a batch holds few days
    if storage.exists(spark, path):
        old = spark.read.schema(batch.schema).parquet(path)
        touched = F.col("date_posted").isin([d for d in days if d is not None])
        old = old.where(touched | F.col("date_posted").isNull() if None in days else touched)
        batch = materialize(warehouse.upsert_fact(old.select(batch.columns), batch, config.FACT_GRAIN), "merged-fact")
    (lake.clustered(batch, "date_posted").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date_posted").parquet(path))
    return days


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("inferSchema", False).parquet(f"{root.rstrip('/')}/fact") \
                .withColumn("date_posted", F.col("date_posted").cast("string"))


# ------------------------------------------------------------- watermark

def read_watermark(spark: SparkSession, root: str, start: str = config.AS_OF_DATE, mode: str = "parity") -> str:
    """The watermark of the stored log of processed days; ``start`` before the first run.

    ``parity``: the day processed last (a backfill moves it back, as in the
    reference); ``greatest``: the latest of them.
    """
    log = f"{root.rstrip('/')}/watermark"
    if mode == "parity" or not storage.committed(spark, log):
        return storage.last_entry(spark, log) or start
    return storage.entries(spark, log).agg(F.max("value")).first()[0]


def run_day(spark: SparkSession, root: str, silver: DataFrame, day: str | None = None, mode: str = "parity",
            start: str = config.AS_OF_DATE) -> str:
    """One day of ``silver`` (by default the one after the stored watermark):
    gates, silver increment, fact, gates, upsert of that day, watermark.

    A refused day changes nothing.
    """
    log = f"{root.rstrip('/')}/watermark"
    after = None
    if not day:
        after = storage.last_numbered(spark, log)[0]
        day = str(spark.sql(f"SELECT date_add(DATE'{read_watermark(spark, root, start, mode)}', 1)").first()[0])
    batch = materialize(silver.where(F.col("date_posted") == day).select(config.SALARY_COLS), "increment")
    upsert = gate_batch(batch, day)
    batch.write.mode("overwrite").parquet(f"{root.rstrip('/')}/silver_increment/{day}")
    upsert_days(spark, root, upsert)
    if storage.append_entry(spark, log, day, after) is None and day not in [r["value"] for r in storage.entries(spark, log).collect()]:
        raise RuntimeError(f"another run moved the watermark while {day} was processed")
    return day


def _stage_days(df: DataFrame, rules: list[quality.Rule], path: str) -> tuple[set[str], set[str]]:
    """Write rows by their day and whether they keep the contract; folder names of all days and of the refused ones."""
    ok = F.coalesce(functools.reduce(Column.__and__, [F.coalesce(r.ok, F.lit(False)) for r in rules]), F.lit(False))
    (lake.clustered(df.withColumn("_day", F.col("date_posted")).withColumn("_ok", ok), "_day")
         .write.partitionBy("_day", "_ok").parquet(path))
    day = lambda p: p.split("/_day=", 1)[1].split("/")[0]
    return ({day(p) for p in storage.folders(df.sparkSession, f"{path}/_day=*")},
            {day(p) for p in storage.folders(df.sparkSession, f"{path}/_day=*/_ok=false")})


def run_days(spark: SparkSession, root: str, silver: DataFrame, days: list[str] | None = None) -> tuple[list[str], list[str]]:
    """Any set of days of ``silver`` (all of it by default) in one run of four writes, however many days.

    The increment is staged by day and contract, the fact of the days without a breach likewise; a day with a
    breach in either is refused whole and put under ``quarantine/increment``.  The other days are upserted
    together, their increments kept as ``silver_increment/<day>`` and the days appended to the watermark log in
    order.  Large days are split and small ones put together on the way to the files.  Returns (days, refused).
    """
    root = root.rstrip("/")
    batch = silver.select(config.SALARY_COLS)
    if days is not None:
        batch = batch.where(F.col("date_posted").isin(days))
    staged = fresh_path(spark, "staged-increment")
    found, refused = _stage_days(batch, quality.silver_salary_rules(), staged)
    held = spark.read.schema(batch.schema.add("_day", "string").add("_ok", "boolean")).parquet(staged)
    fact = gold.build_fact(gold.salary_frame(held.where(F.col("_day").isin(sorted(found - refused))).select(batch.columns)))
    staged_fact = fresh_path(spark, "staged-fact")
    refused |= _stage_days(fact, quality.gold_fact_rules(), staged_fact)[1]
    done = sorted(found - refused)
    if done:
        good = spark.read.schema(fact.schema.add("_day", "string").add("_ok", "boolean")).parquet(staged_fact)
        upsert_days(spark, root, good.where(F.col("_day").isin(done)).select(fact.columns))
    for day in sorted(found):  # folders are renamed, no data is read
        target = f"{root}/quarantine/increment/{day}" if day in refused else f"{root}/silver_increment/{day}"
        storage.move(spark, f"{staged}/_day={day}" if day in refused else f"{staged}/_day={day}/_ok=true", target)
    for day in done:
        storage.append_entry(spark, f"{root}/watermark", day)
    for path in (staged, staged_fact):
        storage.remove(spark, path)
    return done, sorted(refused)


# ------------------------------------------------------------- hot indicators of a stream

COUNT_KEYS = ["country_iso2", "skill"]


def store_counts(spark: SparkSession, root: str, days: list[str]) -> None:
    """Facts of ``days`` folded to (day, country, skill, salary in cents): how many, and their jobs.

    Kept by day beside the fact, so a replayed day takes back what it had counted before by overwriting its
    folder; the write is the same however often it is repeated.
    """
    fact = read_fact(spark, root).where(F.col("date_posted").isin([d for d in days if d is not None]) & F.col("country_iso2").isNotNull() & F.col("skill").isNotNull())
    counts = (fact.groupBy("date_posted", *COUNT_KEYS, cents("avg_salary").alias("cents"))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("job_count").cast("bigint").alias("jobs")))
    (lake.clustered(counts, "date_posted").sortWithinPartitions("date_posted", *COUNT_KEYS).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("date_posted").parquet(f"{root.rstrip('/')}/indicator_counts"))


def publish_indicators(spark: SparkSession, root: str, countries: list[str]) -> None:
    """E8 / A16 for the given countries, from the stored counts alone: exact medians of folded values; their ``pk``
    folders of the published items are overwritten."""
    counts = (spark.read.schema("country_iso2 string, skill string, cents long, n long, jobs long, date_posted string")
                   .parquet(f"{root.rstrip('/')}/indicator_counts").where(F.col("country_iso2").isin(countries)))
    (indicators.hot_items_of_counts(counts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("pk").parquet(f"{root.rstrip('/')}/hot_items"))


HOT_ITEMS = "sk string, median_salary_eur double, avg_salary_eur double, volume long, pk string"


def read_hot_items(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(HOT_ITEMS).parquet(f"{root.rstrip('/')}/hot_items").select("pk", "sk", "median_salary_eur", "avg_salary_eur", "volume")


def stream_offers(spark: SparkSession, stream: DataFrame, root: str, checkpoint: str) -> None:
    """Fresh silver rows from a stream, through the gates, into the fact and the hot indicators under ``root``.

    Each micro-batch upserts its days, folds those days' facts again and publishes the countries it touched: the
    facts of other days are not read.  Every step overwrites what it is keyed by, so a batch that is delivered
    again after a failure leaves the same files.  A refused batch stops the stream and stays undelivered.
    """
    def handle(batch: DataFrame, epoch_id: int) -> None:
        rows = materialize(cleaners.project_contract(batch), "stream-batch")
        if rows.isEmpty():
            return
        fact = gate_batch(rows, f"stream-{epoch_id}")
        days = upsert_days(spark, root, fact)
        store_counts(spark, root, days)
        # the gate lets pass two-letter codes alone: a bounded list
        touched = rows.select("country_iso2").where("country_iso2 is not null").distinct().collect()
        publish_indicators(spark, root, [r[0] for r in touched])

    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def watermark_steps(runs: DataFrame, step: str, batch_date: str, mode: str = "parity") -> DataFrame:
    """Watermark after each run, in run order.

    ``parity``: the last processed day (a backfill of an older day moves it
    back, as in the reference); ``greatest``: the maximum day seen.  The next
    default batch is watermark + 1 day.  Runs are few (one per day), so an
    ordered window over them is cheap.
    """
    w = Window.orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    wm = F.col(batch_date) if mode == "parity" else F.max(batch_date).over(w)
    return (runs.select(step, batch_date, wm.alias("watermark"))
            .withColumn("next_batch", F.date_add(F.to_date("watermark"), 1).cast("string")))


def read_stream(spark: SparkSession, directory: str, schema, glob: str) -> DataFrame:
    """I10 source: parquet files of a directory as a stream (``pathGlobFilter``)."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(directory)


def utc_timestamp(ts_ntz) -> Column:
    """timestamp_ntz wall clock read as UTC instant (independent of session zone);
    event-time watermarks need TIMESTAMP, not TIMESTAMP_NTZ."""
    c = F.col(ts_ntz) if isinstance(ts_ntz, str) else ts_ntz
    return F.to_timestamp(F.concat(c.cast("string"), F.lit("Z")))


def daily_event_counts(stream: DataFrame, ts: str, label: str, value: str, delay: str = "1 day") -> DataFrame:
    """Event-time daily windows per label with a watermark (late data up to
    ``delay`` is still counted; older rows are dropped by the state store)."""
    t = stream.withColumn("_ts", utc_timestamp(ts)).withWatermark("_ts", delay)
    return (t.groupBy(F.window("_ts", "1 day"), F.col(label))
             .agg(F.count(F.lit(1)).alias("events"), F.sum(F.floor(F.col(value) * 100 + 0.5).cast("bigint"))
                  .alias("value_cents")))


def run_available_now(spark: SparkSession, agg: DataFrame, keys: list[str], root: str) -> DataFrame:
    """Run a streaming aggregation over what is there (``availableNow``).

    Update mode: each trigger writes the groups that changed, one folder per
    epoch, so neither the driver nor the state holds closed windows; the newest
    row of each group is the result.  State, checkpoint and output live under
    ``root``: a second call with the same folder reads the new input only.
    """
    out = f"{root.rstrip('/')}/updates"

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")  # a replayed epoch overwrites itself

    q = (agg.writeStream.outputMode("update").foreachBatch(put)
         .option("checkpointLocation", f"{root.rstrip('/')}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    updates = spark.read.schema(agg.schema.add("epoch", "long")).option("basePath", out).parquet(f"{out}/epoch=*")
    rest = [c for c in agg.columns if c not in keys]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("_last")).select(*keys, "_last.*")


def foreach_batch_upsert(spark: SparkSession, stream: DataFrame, target_root: str, checkpoint: str) -> None:
    """Each micro-batch of fresh silver rows passes the gates and is upserted
    into the fact stored by day under ``target_root``.

    ``checkpoint`` is the caller's and outlives the call: the next call delivers
    new files only.  Delivery is at least once; a replayed batch overwrites the
    same grain rows.  A refused batch stops the stream and stays undelivered.
    """
    def handle(batch: DataFrame, epoch_id: int) -> None:
        rows = materialize(cleaners.project_contract(batch), "stream-batch")
        if not rows.isEmpty():
            upsert_days(spark, target_root, gate_batch(rows, f"stream-{epoch_id}"))

    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint) \
              .trigger(availableNow=True).start()
    q.awaitTermination()
