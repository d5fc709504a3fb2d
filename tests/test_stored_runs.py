"""Logs that several writers share, gated writes, runs of many days, streams into hot indicators, external tables."""

import threading

import pytest
from pyspark.sql import functions as F

from marketlake import config, storage
from marketlake.operators import gold, indicators, lake, quality, warehouse as wh
from marketlake.plans import medallion as md
from marketlake.plans import pipeline_run as pr
from marketlake.session import fresh_path
from marketlake.streaming import microbatch as mb

from conftest import SF_SMALL

SILVER = ", ".join(f"{c} {'double' if 'salary' in c else 'string'}" for c in config.SALARY_COLS)


def offer(day, salary, company="ACME", country="FR", source="adzuna"):
    return (source, day, country, "python", company, salary, None, None)


def test_writers_of_a_log_never_share_a_number(spark):
    log, got = fresh_path(spark, "test-log"), []

    def write(i):
        for k in range(5):
            got.append((storage.append_entry(spark, log, f"{i}-{k}"), f"{i}-{k}"))

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(n for n, _ in got) == list(range(1, 21))
    assert sorted((r["number"], r["value"]) for r in storage.entries(spark, log).collect()) == sorted(got)
    # compare-and-set: only the writer that saw the last number succeeds
    assert storage.append_entry(spark, log, "late", after=19) is None
    assert storage.append_entry(spark, log, "next", after=20) == 21
    assert storage.last_numbered(spark, log) == (21, "next") and storage.last_numbered(spark, log + "-none") == (0, None)


def test_concurrent_refreshes_leave_whole_snapshots(spark):
    root, made = fresh_path(spark, "test-refresh"), []

    def refresh(i):
        tables = {"a": spark.range(i * 10), "b": spark.range(i)}
        made.append((i, wh.write_snapshot(spark, tables, root, rows=(rows := {})), rows))

    threads = [threading.Thread(target=refresh, args=(i,)) for i in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(storage.committed(spark, f"{root}/pointer")) == 2
    for i, snap, rows in made:
        assert rows == {"a": i * 10, "b": i}
        assert spark.read.parquet(f"{snap}/a").count() == i * 10 and spark.read.parquet(f"{snap}/b").count() == i
    assert wh.current_snapshot(spark, root) in [s for _, s, _ in made]


def test_gated_write_commits_refuses_and_puts_aside_in_one_job(spark):
    root = fresh_path(spark, "test-gate")
    rows = [offer(f"2026-06-{1 + i % 3:02d}", 50000.0 + i) for i in range(30)] + [offer("2026-06-01", 12.0), offer("2026-06-02", None)]
    df = spark.createDataFrame(rows, SILVER)
    outside = ~F.coalesce(F.col("salary_eur").between(config.EUR_MIN, config.EUR_MAX), F.lit(False))
    sc = spark.sparkContext
    sc.setJobGroup("gated", "gated")
    try:
        record = lake.gated_write(df, quality.silver_salary_rules(), root, "silver", "x", ["date_posted"], aside=outside)
        jobs = sc.statusTracker().getJobIdsForGroup("gated")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2  # adaptive execution runs the exchange's stage as a job of its own
    assert record["rows"] == 30 and lake.read_layer(spark, root, "silver", "x").count() == 30
    assert lake.read_layer(spark, root, "silver_aside", "x").count() == 2
    # a dirty copy is refused: the dataset stays, the rows are in quarantine
    dirty = df.unionByName(spark.createDataFrame([offer("2026-06-03", 40000.0, country="FRANCE")], SILVER))
    with pytest.raises(quality.DataQualityError, match="country_iso2/str_length"):
        lake.gated_write(dirty, quality.silver_salary_rules(), root, "silver", "x", ["date_posted"], aside=outside)
    assert lake.read_layer(spark, root, "silver", "x").count() == 30
    assert [r["country_iso2"] for r in spark.read.parquet(f"{root}/quarantine/silver/x").collect()] == ["FRANCE"]
    assert storage.folders(spark, f"{root}/_staged/*") == []
    # without rows: empty datasets of the same columns
    assert lake.gated_write(df.limit(0), quality.silver_salary_rules(), root, "silver", "y", ["date_posted"], aside=outside)["rows"] == 0
    assert lake.read_layer(spark, root, "silver", "y").columns == df.columns and lake.read_layer(spark, root, "silver_aside", "y").count() == 0


def test_files_follow_bytes_not_tasks_times_days(spark):
    root = fresh_path(spark, "test-files")
    days = 80
    df = spark.range(0, 40_000, 1, 16).withColumn("date_posted", F.concat(F.lit("d"), F.pmod(F.xxhash64("id"), F.lit(days)).cast("string")))
    lake.write_layer(df, root, "silver", "many", partition_by=["date_posted"])
    files = storage.folders(spark, f"{root}/silver/many/date_posted=*/part-*")
    assert days <= len(files) <= days + 8
    assert lake.read_layer(spark, root, "silver", "many").count() == 40_000


def test_run_of_many_days_refuses_whole_days(spark):
    root = fresh_path(spark, "test-run-days")
    rows = [offer(f"2026-06-{d:02d}", 40000.0 + d, f"C{i}") for d in range(1, 21) for i in range(5)]
    rows += [offer("2026-06-07", 12.0), offer("2026-06-09", 50000.0, country="FRANCE"), offer(None, 50000.0)]
    silver = spark.createDataFrame(rows, SILVER)
    done, refused = mb.run_days(spark, root, silver)
    good = [f"2026-06-{d:02d}" for d in range(1, 21) if d not in (7, 9)]
    assert done == good and "2026-06-07" in refused and "2026-06-09" in refused and len(refused) == 3
    fact = mb.read_fact(spark, root)
    assert fact.count() == 18 * 5 and sorted(r[0] for r in fact.select("date_posted").distinct().collect()) == good
    assert [r["value"] for r in storage.entries(spark, f"{root}/watermark").orderBy("number").collect()] == good
    assert spark.read.parquet(f"{root}/silver_increment/2026-06-20").count() == 5
    assert spark.read.parquet(f"{root}/quarantine/increment/2026-06-07").count() == 6
    # mended days and a replay: the others' files stay
    old = {r[0] for r in fact.where("date_posted = '2026-06-20'").select(F.input_file_name()).collect()}
    mended = spark.createDataFrame([offer("2026-06-07", 41000.0), offer("2026-06-01", 39000.0, "C0")], SILVER)
    assert mb.run_days(spark, root, mended) == (["2026-06-01", "2026-06-07"], [])
    after = {(r["date_posted"], r["company"]): r["avg_salary"] for r in mb.read_fact(spark, root).collect()}
    assert after["2026-06-01", "C0"] == 39000.0 and after["2026-06-01", "C1"] == 40001.0 and len(after) == 91
    assert old == {r[0] for r in mb.read_fact(spark, root).where("date_posted = '2026-06-20'").select(F.input_file_name()).collect()}
    assert mb.read_watermark(spark, root) == "2026-06-07" and mb.read_watermark(spark, root, mode="greatest") == "2026-06-20"
    assert mb.run_days(spark, root, silver.limit(0)) == ([], [])


def test_stream_keeps_indicators_exact_under_replays(spark):
    root, drops, ckpt = (fresh_path(spark, f"test-hot-{n}") for n in ("store", "drops", "ckpt"))

    def deliver(rows):
        spark.createDataFrame(rows, SILVER).coalesce(1).write.mode("append").parquet(drops)
        mb.stream_offers(spark, spark.readStream.schema(SILVER).parquet(drops), root, ckpt)
        plain = indicators.hot_indicator_items(mb.read_fact(spark, root))
        key = lambda df: sorted(map(tuple, df.select("pk", "sk", "median_salary_eur", "avg_salary_eur", "volume").collect()))
        assert key(mb.read_hot_items(spark, root)) == key(plain)
        return {r["pk"]: (r["median_salary_eur"], r["volume"]) for r in plain.collect()}

    deliver([offer("2026-06-16", 40000.0 + i, f"C{i}") for i in range(4)] + [offer("2026-06-16", 30000.0, country="DE")])
    before = storage.folders(spark, f"{root}/hot_items/pk=*DE/part-*")
    # the replayed day's old values are taken back, other days and countries are not touched
    assert deliver([offer("2026-06-16", 90000.0, "C0"), offer("2026-06-17", 50000.0)])["country#FR"][1] == 5
    assert storage.folders(spark, f"{root}/hot_items/pk=*DE/part-*") == before
    with pytest.raises(Exception, match="data quality failed"):
        deliver([offer("2026-06-18", 12.0)])


def test_days_are_pruned_before_parsing(spark):
    rows = md.silver_of_days(spark, SF_SMALL, lambda d: d == "2001-07-01")
    whole = md.silver(spark, SF_SMALL)
    assert sorted(map(str, rows.collect())) == sorted(map(str, whole.where("date_posted = '2001-07-01'").collect()))
    survey = md.silver_of_days(spark, SF_SMALL, lambda d: d == config.AS_OF_DATE)
    assert survey.count() == whole.where(F.col("date_posted") == config.AS_OF_DATE).count() > 0


def test_external_table_has_partitions_and_statistics(spark):
    path = fresh_path(spark, "test-ext")
    gold.build_fact(md.salary(spark, SF_SMALL)).write.partitionBy("date_posted").parquet(path)
    pr.register_external_table(spark, "fact_ext_days", path, ["date_posted"])
    days = {r["date_posted"] for r in spark.read.option("inferSchema", False).parquet(path).select(F.col("date_posted").cast("string")).distinct().collect()}
    assert {r[0] for r in spark.sql("SHOW PARTITIONS fact_ext_days").collect()} == {f"date_posted={d}" for d in days}
    day = sorted(days)[0]
    one = spark.sql(f"SELECT * FROM fact_ext_days WHERE date_posted = '{day}'")
    assert "PartitionFilters: [isnotnull(date_posted" in one._jdf.queryExecution().executedPlan().toString() and one.count() > 0
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED fact_ext_days").collect()}
    assert "rows" in described["Statistics"]
    assert spark.sql("DESCRIBE EXTENDED fact_ext_days avg_salary").where("info_name = 'distinct_count'").first()["info_value"] != "NULL"
    spark.sql("DROP TABLE fact_ext_days")
