"""Upserts without MERGE (I1-I5, I8), snapshots (I4), quality gates (H1-H9)."""

import pytest
from pyspark.sql import functions as F

from marketlake import config
from marketlake.operators import quality, warehouse as wh
from marketlake.session import scratch_path


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_upsert_update_overwrites_with_null_by_default(spark):
    target = spark.createDataFrame([("A", "1-50", "Software"), ("B", "5000+", "Finance")],
                                   "company_name string, workforce_size string, sector string")
    batch = spark.createDataFrame([("B", None, None), ("C", None, None)], target.schema)
    assert _rows(wh.upsert_update(target, batch, ["company_name"]), ["company_name"]) == [
        ("A", "1-50", "Software"), ("B", None, None), ("C", None, None)]
    kept = wh.upsert_update(target, batch, ["company_name"], keep_known=True)
    assert _rows(kept, ["company_name"])[1] == ("B", "5000+", "Finance")


def test_upsert_ignore_keeps_existing(spark):
    target = spark.createDataFrame([("2026-06-01", 1)], "date_key string, day int")
    batch = spark.createDataFrame([("2026-06-01", 99), ("2026-06-02", 2), ("2026-06-02", 2)], target.schema)
    assert _rows(wh.upsert_ignore(target, batch, ["date_key"]), ["date_key"]) == [("2026-06-01", 1), ("2026-06-02", 2)]


def test_upsert_fact_last_wins_and_replay_is_idempotent(spark):
    cols = "date_posted string, country_iso2 string, skill string, company string, source string, " \
           "avg_salary double, min_salary double, max_salary double, job_count bigint"
    target = spark.createDataFrame([("2026-06-01", "FR", "python", "A", "adzuna", 1.0, 1.0, 1.0, 1)], cols)
    batch = spark.createDataFrame([
        ("2026-06-01", "FR", "python", "A", "adzuna", 2.0, 2.0, 2.0, 2, 0),
        ("2026-06-01", "FR", "python", "A", "adzuna", 3.0, 3.0, 3.0, 3, 1),
        (None, "FR", "python", "A", "adzuna", 4.0, 4.0, 4.0, 4, 0)], cols + ", seq int")
    once = wh.upsert_fact(target, batch, config.FACT_GRAIN, "seq")
    twice = wh.upsert_fact(once, batch, config.FACT_GRAIN, "seq")
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    got = {r["date_posted"]: r["job_count"] for r in twice.collect()}
    assert got == {"2026-06-01": 3, None: 4}


def test_snapshot_switch(spark):
    root = scratch_path(spark, "test-warehouse")
    df1 = spark.createDataFrame([(1,)], "x int")
    s1 = wh.write_snapshot(spark, {"t": df1}, root)
    assert wh.current_snapshot(spark, root) == s1
    s2 = wh.write_snapshot(spark, {"t": spark.createDataFrame([(2,), (3,)], "x int")}, root)
    assert s2 != s1 and wh.read_table(spark, root, "t").count() == 2


def test_quality_contract_and_gate(spark):
    schema = ", ".join(f"{c} {'double' if 'salary' in c else 'string'}" for c in config.SALARY_COLS)
    good = spark.createDataFrame([("adzuna", "2026-06-01", "FR", "python", "ACME", 55000.0, None, None)], schema)
    counts = quality.violation_counts(good, quality.silver_salary_rules())
    assert all(r["failures"] == 0 for r in counts.collect())
    quality.gate(counts, "good")
    bad = spark.createDataFrame([("adzuna", "2026-06-01", "FRANCE", "python", None, 12.0, None, None)], schema)
    counts = {(r["column"], r["failures"]) for r in quality.violation_counts(bad, quality.silver_salary_rules()).collect()}
    assert ("country_iso2", 1) in counts and ("salary_eur", 1) in counts
    with pytest.raises(quality.DataQualityError):
        quality.gate(quality.violation_counts(bad, quality.silver_salary_rules()), "bad")
    cases = quality.failure_cases(bad, quality.silver_salary_rules()).collect()
    assert {(c["column"], c["failure_case"]) for c in cases} == {("country_iso2", "FRANCE"), ("salary_eur", "12.0")}
    assert quality.strict_columns(bad.withColumn("extra", F.lit(1)).drop("skill"), config.SALARY_COLS) == [
        "missing:skill", "extra:extra"]


def test_fact_order_rules(spark):
    cols = "date_posted string, country_iso2 string, skill string, company string, source string, " \
           "avg_salary double, min_salary double, max_salary double, job_count bigint"
    f = spark.createDataFrame([("2026-06-01", "FR", "python", "A", "adzuna", 55000.0, 60000.0, 50000.0, 3)], cols)
    got = {r["check"]: r["failures"] for r in quality.violation_counts(f, quality.gold_fact_rules()).collect()}
    assert got["min > avg"] == 1 and got["avg > max"] == 1 and got["ge(1)"] == 0
