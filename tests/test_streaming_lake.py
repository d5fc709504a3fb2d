"""Streams, micro-batches, watermarks (I6-I10) and lake monitoring."""

import pytest
from pyspark.sql import functions as F

from marketlake import config
from marketlake.operators import lake, quality
from marketlake.session import fresh_path, scratch_path
from marketlake.sources.tables import load
from marketlake.streaming import microbatch as mb

from conftest import SF_SMALL


def test_available_now_stream_then_rerun_delivers_nothing(spark):
    schema = load(spark, SF_SMALL, "events").schema
    root = fresh_path(spark, "test-events")
    for _ in range(2):  # the second call finds no new file
        stream = mb.read_stream(spark, SF_SMALL, schema, "events.parquet")
        out = mb.run_available_now(spark, mb.daily_event_counts(stream, "ts", "event_type", "value"), ["window", "event_type"], root)
        assert out.agg(F.sum("events")).first()[0] == load(spark, SF_SMALL, "events").count()


def test_watermark_modes(spark):
    runs = spark.createDataFrame([(1, "2026-06-16"), (2, "2026-06-17"), (3, "2026-06-10")],
                                 "step int, batch_date string")
    parity = [r["watermark"] for r in mb.watermark_steps(runs, "step", "batch_date", "parity").orderBy("step").collect()]
    greatest = [r["next_batch"] for r in mb.watermark_steps(runs, "step", "batch_date", "greatest").orderBy("step").collect()]
    assert parity == ["2026-06-16", "2026-06-17", "2026-06-10"]
    assert greatest == ["2026-06-17", "2026-06-18", "2026-06-18"]


def test_fresh_since(spark):
    s = spark.createDataFrame([("2026-06-15",), ("2026-06-16",), ("2026-06-17",)], "date_posted string")
    assert mb.fresh_since(s, "2026-06-15").count() == 2
    assert [r[0] for r in mb.fresh_since(s, "2026-06-15", one_day=True).collect()] == ["2026-06-16"]


def test_layer_write_manifest_and_retention(spark):
    root = scratch_path(spark, "test-lake")
    df = spark.range(10).withColumn("date_posted", F.lit("2026-06-01"))
    rec = lake.write_layer(df, root, "silver", "demo", partition_by=["date_posted"])
    assert rec["rows"] == 10 and rec["bytes"] > 0
    m = lake.record(spark, None, [rec])
    m = lake.record(spark, m, [dict(rec, rows=11)])
    assert [(r["dataset"], r["rows"]) for r in m.collect()] == [("demo", 11)]
    totals = lake.layer_totals(m).first()
    assert (totals["layer"], totals["datasets"], totals["rows"]) == ("silver", 1, 11)
    objs = spark.createDataFrame([("bronze", "2026-01-01"), ("bronze", "2026-05-20"), ("gold", "2026-01-01"),
                                  ("silver", "2026-05-01")], "layer string, written string")
    plan = lake.retention_plan(objs, "layer", "written", F.to_date(F.lit("2026-06-01")))
    assert [r["tier"] for r in plan.collect()] == ["expired", "hot", "cold", "cold"]


SILVER = ", ".join(f"{c} {'double' if 'salary' in c else 'string'}" for c in config.SALARY_COLS)


def _offer(day, salary, company="ACME"):
    return ("adzuna", day, "FR", "python", company, salary, None, None)


def test_stream_delivers_new_files_only_and_touches_their_days(spark):
    root, d, ckpt = (fresh_path(spark, f"test-stream-{n}") for n in ("root", "in", "ckpt"))

    def put(rows):
        spark.createDataFrame(rows, SILVER).coalesce(1).write.mode("append").parquet(d)
        mb.foreach_batch_upsert(spark, spark.readStream.schema(SILVER).parquet(d), root, ckpt)
        return {(r["date_posted"], r["company"]): (r["avg_salary"], r["job_count"]) for r in mb.read_fact(spark, root).collect()}

    assert put([_offer("2026-06-16", 50000.0), _offer("2026-06-17", 60000.0)]) == {
        ("2026-06-16", "ACME"): (50000.0, 1), ("2026-06-17", "ACME"): (60000.0, 1)}
    old = [r[0] for r in mb.read_fact(spark, root).where("date_posted = '2026-06-17'").select(F.input_file_name()).collect()]
    # a second file of a known day overwrites that grain, not the sum of both, and leaves the other day's files
    assert put([_offer("2026-06-16", 40000.0), _offer("2026-06-16", 44000.0, "B")]) == {
        ("2026-06-16", "ACME"): (40000.0, 1), ("2026-06-16", "B"): (44000.0, 1), ("2026-06-17", "ACME"): (60000.0, 1)}
    assert old == [r[0] for r in mb.read_fact(spark, root).where("date_posted = '2026-06-17'").select(F.input_file_name()).collect()]
    with pytest.raises(Exception, match="data quality failed"):
        put([_offer("2026-06-18", 12.0)])
    assert mb.read_fact(spark, root).where("date_posted = '2026-06-18'").count() == 0


def test_run_day_gates_and_stores_the_watermark(spark):
    root = fresh_path(spark, "test-days")
    silver = spark.createDataFrame([_offer("2026-06-16", 50000.0), _offer("2026-06-17", 12.0), _offer("2026-06-18", 52000.0)], SILVER)
    assert mb.read_watermark(spark, root) == config.AS_OF_DATE
    assert mb.run_day(spark, root, silver) == "2026-06-16"
    with pytest.raises(quality.DataQualityError):
        mb.run_day(spark, root, silver)
    assert mb.read_watermark(spark, root) == "2026-06-16"
    assert mb.run_day(spark, root, silver, "2026-06-18") == "2026-06-18"
    mb.run_day(spark, root, silver, "2026-06-16")
    assert mb.read_watermark(spark, root) == "2026-06-16"  # parity: a backfill moves it back
    assert mb.read_watermark(spark, root, mode="greatest") == "2026-06-18"
    assert mb.read_fact(spark, root).count() == 2
    assert spark.read.parquet(f"{root}/silver_increment/2026-06-18").count() == 1


def test_one_day_reads_one_folder(spark):
    from marketlake.plans import medallion as md
    day = md.silver_by_day(spark, SF_SMALL).where(F.col("date_posted") == "2001-07-01")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_posted" in plan and "2001-07-01" in plan
    assert len(day.inputFiles()) and all("date_posted=2001-07-01" in f for f in day.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


def test_hot_items_lookup_reads_one_folder(spark):
    from marketlake.operators import indicators as ind
    items = spark.createDataFrame([("country#FR", "skill#python", 1.0, 2.0, 3), ("country#DE", "skill#python", 4.0, 5.0, 6)],
                                  "pk string, sk string, median_salary_eur double, avg_salary_eur double, volume bigint")
    held = ind.hot_indicator_lookup(ind.write_hot_items(items, fresh_path(spark, "test-hot")), "de")
    assert [tuple(r) for r in held.collect()] == [("country#DE", "skill#python", 4.0, 5.0, 6)]
    assert "PartitionFilters: [isnotnull(pk" in held._jdf.queryExecution().executedPlan().toString()


def test_watermark_state_has_a_step_for_every_day(spark):
    import __spark_entry__ as entry
    from marketlake.operators import gold
    from marketlake.plans import medallion as md
    from marketlake.plans.catalog_gold import REPLAY_DATE

    days = sorted(r[0] for r in md.distinct_salary(spark, SF_SMALL, gold.distinct_dates).collect() if r[0] != config.AS_OF_DATE)
    rows = sorted(map(tuple, entry.queries()["watermark_state"](spark, SF_SMALL).select("step", "batch_date", "watermark_greatest").collect()))
    assert len(days) > 3
    assert rows == [(i, d, d) for i, d in enumerate(days, 1)] + [(len(days) + 1, REPLAY_DATE, max(days + [REPLAY_DATE]))]
