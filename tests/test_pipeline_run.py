"""Written runs: silver -> gold -> warehouse with metrics, external table, backfill."""

import pytest
from pyspark.sql import functions as F

from marketlake import config, storage
from marketlake.operators import gold, indicators, quality, warehouse as wh
from marketlake.plans import medallion as md
from marketlake.plans import pipeline_run as pr
from marketlake.session import fresh_path, scratch_path

from conftest import SF_SMALL


def test_run_all_matches_lazy_plans(spark):
    root = fresh_path(spark, "test-run-all")
    metrics = {r["stage"]: r for r in pr.run_all(spark, SF_SMALL, root).collect()}
    assert set(metrics) == {"bronze", "silver", "gold", "warehouse"}
    inside, aside = pr.split_band(md.silver(spark, SF_SMALL))
    assert metrics["silver"]["rows"] == inside.count() + \
        md.repositories_silver(spark, SF_SMALL).count() + md.trends_silver(spark, SF_SMALL).count()
    assert sum(spark.read.parquet(f"{root}/silver_aside/{s}").count() for s in config.SALARY_SOURCES) == aside.count()
    star = wh.read_table(spark, f"{root}/warehouse", "fact_job")
    md_rows = star.collect()
    assert star.count() == gold.build_fact(gold.salary_frame(inside)).count()
    assert star.where(F.col("id_company").isNull() | F.col("id_country").isNull()).count() == 0
    assert metrics["gold"]["datasets"] == 7
    manifest = {(r["layer"], r["dataset"]): r for r in spark.read.parquet(f"{root}/manifest").collect()}
    assert len(manifest) == 20 and all(r["bytes"] > 0 for r in manifest.values())
    assert spark.read.parquet(f"{root}/gold/dim_company").columns == ["company_name", "workforce_size", "sector"]
    # twice = once (full refresh restarts ids), and old snapshots go
    for _ in range(2):
        pr.load_star(spark, root)
    assert wh.read_table(spark, f"{root}/warehouse", "fact_job").count() == len(md_rows)
    assert len([n for n in storage.committed(spark, f"{root}/warehouse/pointer")]) == 3
    # An increment keeps old ids, adds new ones, overwrites known grains
    before = {r["id_fact"]: r for r in wh.read_table(spark, f"{root}/warehouse", "fact_job").collect()}
    one = md.silver(spark, SF_SMALL).where("salary_eur > 2000").limit(1).first().asDict()
    schema = ", ".join(f"{c} {'double' if 'salary' in c else 'string'}" for c in config.SALARY_COLS)
    batch = [tuple({**one, "date_posted": "2026-07-01", "company": "Aaa New"}[c] for c in config.SALARY_COLS)]
    for _ in range(2):  # a replay changes nothing
        pr.load_increment(spark, root, spark.createDataFrame(batch, schema))
        after = {r["id_fact"]: r for r in wh.read_table(spark, f"{root}/warehouse", "fact_job").collect()}
        assert set(after) - set(before) == {max(before) + 1} and all(after[i] == before[i] for i in before)
    companies = wh.read_table(spark, f"{root}/warehouse", "d_company").orderBy(F.desc("id_company")).collect()
    assert companies[0]["company_name"] == "Aaa New" and companies[0]["id_company"] == len(companies)
    bad = spark.createDataFrame([tuple({**one, "salary_eur": 12.0}[c] for c in config.SALARY_COLS)], schema)
    with pytest.raises(quality.DataQualityError):
        pr.load_increment(spark, root, bad)
    # a country outside the registry stops the load before the pointer moves
    held = wh.current_snapshot(spark, f"{root}/warehouse")
    lost = spark.createDataFrame([tuple({**one, "country_iso2": "PL"}[c] for c in config.SALARY_COLS)], schema)
    with pytest.raises(wh.MissingKeyError):
        pr.load_increment(spark, root, lost)
    assert wh.current_snapshot(spark, f"{root}/warehouse") == held
    # SQL over the written gold fact
    t = pr.register_external_table(spark, "fact_job_ext", f"{root}/gold/fact_job")
    assert t.count() == len(before)
    # F8: dimension values, sorted, from the dimensions
    dims = indicators.dimension_values(wh.read_table(spark, f"{root}/warehouse", "d_country"),
                                       wh.read_table(spark, f"{root}/warehouse", "d_skill"),
                                       wh.read_table(spark, f"{root}/warehouse", "d_source")).collect()
    assert [r["value"] for r in dims if r["dimension"] == "countries"] == sorted(c[0] for c in config.COUNTRIES)
    assert len([r for r in dims if r["dimension"] == "sources"]) == 6


def test_backfill_is_idempotent_per_day(spark):
    root = scratch_path(spark, "test-backfill")
    silver = md.silver(spark, SF_SMALL)
    days = [r[0] for r in silver.select("date_posted").distinct().orderBy("date_posted").limit(3).collect()]
    first = pr.backfill_days(spark, silver, days, root)
    n1 = first.count()
    again = pr.backfill_days(spark, silver, days[1:2], root)
    assert again.count() == n1
    expected = gold.build_fact(gold.salary_frame(silver.where(F.col("date_posted").isin(days)))).count()
    assert n1 == expected
