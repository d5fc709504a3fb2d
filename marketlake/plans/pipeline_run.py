"""Written medallion runs.

These functions perform writes (actions); the registered queries stay lazy.
Every write goes under a caller-given root on the shared filesystem; row
counts are observed during the writes (``Observation``), so the metrics cost
no extra pass.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config, storage
from ..operators import cleaners, gold, lake, quality, warehouse as wh
from ..sources import adapter, readers, registry
from ..sources.readers import wide_to_long
from ..streaming import microbatch as mb
from . import medallion as md


def split_band(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows inside the plausible salary band, and the others.

    The rule of a run: a salary outside the band is no reason to stop, it is put
    aside (``silver_aside/<source>``) before the gate.  Any other breach stops the run.
    """
    ok = F.coalesce(F.col("salary_eur").between(config.EUR_MIN, config.EUR_MAX), F.lit(False))
    return silver.where(ok), silver.where(~ok)


def build_bronze(spark: SparkSession, sf_dir: str, root: str) -> list[dict]:
    """Observations as delivered, by source, and the popularity and reference inputs."""
    obs = md.observations(spark, sf_dir)
    seen = Observation(f"bronze_{uuid.uuid4().hex[:8]}")
    names = config.SALARY_SOURCES
    path = f"{root}/bronze/observations"
    (obs.observe(seen, *[F.count_if(F.col("src") == s).alias(s) for s in names])
        .write.mode("overwrite").partitionBy("src").parquet(path))
    records = [lake.manifest_record("bronze", s, int(seen.get[s]), storage.folder_bytes(spark, f"{path}/src={s}")) for s in names]
    held = spark.read.parquet(path)
    return records + [lake.write_layer(df, root, "bronze", name) for name, df in (
        ("github_trending", adapter.repositories(spark, sf_dir)), ("google_trends", adapter.interest_wide(held)),
        ("reference", adapter.company_register(spark, sf_dir)))]


def _read_counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and the number of its rows that pass by when it is read."""
    seen = Observation(f"in_{uuid.uuid4().hex[:12]}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def build_silver(spark: SparkSession, sf_dir: str, root: str, gate: bool = True, rows_in: list | None = None) -> list[dict]:
    """M7: clean every registered source of the written bronze, put rows outside
    the salary band aside, gate the rest on its contract and write it as
    ``silver/<source>`` by date, all in one pass a source; popularity sources are
    written ungated.  Returns manifest records; ``rows_in`` receives the rows read."""
    records, counted = [], []
    obs = spark.read.parquet(f"{root}/bronze/observations")
    outside = ~F.coalesce(F.col("salary_eur").between(config.EUR_MIN, config.EUR_MAX), F.lit(False))
    for name in config.SALARY_SOURCES:
        mine, seen = _read_counted(obs.where(F.col("src") == name))
        counted.append(seen)
        part = registry.silver_source(mine, name, valid=True)
        if gate:
            extra = quality.strict_columns(part, config.SALARY_COLS)
            if extra:
                raise quality.DataQualityError(f"silver:{name}: {extra}")
            records.append(lake.gated_write(part, quality.silver_salary_rules(), root, "silver", name, ["date_posted"], aside=outside))
        else:
            records.append(lake.write_layer(part, root, "silver", name, partition_by=["date_posted"]))

    def read(name: str) -> DataFrame:
        df, seen = _read_counted(lake.read_layer(spark, root, "bronze", name))
        counted.append(seen)
        return df

    records.append(lake.write_layer(cleaners.clean_repositories(read("github_trending")), root, "silver", "github_popularity"))
    long = wide_to_long(read("google_trends"), ["date", "country"], adapter.SKILL_DISPLAY)
    records.append(lake.write_layer(cleaners.clean_trends(long), root, "silver", "google_trends"))
    if rows_in is not None:
        rows_in.append(sum(int(o.get["rows"]) for o in counted))
    return records


def build_gold(spark: SparkSession, root: str, gate: bool = True, rows_in: list | None = None) -> list[dict]:
    """M8: the seven gold datasets from the written silver layer: the fact (gated on
    its contract and on a unique grain), five dimensions and the popularity table."""
    fact, counted = None, []
    for s in config.SALARY_SOURCES:
        p, seen = _read_counted(lake.read_layer(spark, root, "silver", s))
        counted.append(seen)
        p = p.withColumn("date_posted", F.col("date_posted").cast("string"))
        f = gold.build_fact(gold.salary_frame(p.select(*config.SALARY_COLS)))
        fact = f if fact is None else fact.unionByName(f)
    recs = [lake.write_layer(fact, root, "gold", "fact_job")]
    f = lake.read_layer(spark, root, "gold", "fact_job")
    dates, names = md.dims_from_fact(f)
    register = readers.with_na_tokens(lake.read_layer(spark, root, "bronze", "reference"))
    company = names.join(register, "company_name", "left")
    if gate:
        quality.gate(quality.violation_counts(f, quality.gold_fact_rules()), "gold:fact_job")
        for name, df, keys in (("fact_job", f, config.FACT_GRAIN), ("dim_company", company, ["company_name"]), ("dim_date", dates, ["date_key"])):
            if twice := quality.duplicate_keys(df, keys).limit(5).collect():
                raise quality.DataQualityError(f"gold:{name}: keys occur more than once: {twice}")
    repos, seen_repos = _read_counted(lake.read_layer(spark, root, "silver", "github_popularity"))
    trends, seen_trends = _read_counted(lake.read_layer(spark, root, "silver", "google_trends"))
    counted += [seen_repos, seen_trends]
    popularity = gold.skill_popularity(repos, trends)
    for name, df in (("dim_date", dates), ("dim_company", company), ("dim_country", wh.d_country(spark).drop("id_country")),
                     ("dim_skill", wh.d_skill(spark).drop("id_skill")), ("dim_source", wh.d_source(spark).drop("id_source")),
                     ("skill_popularity", popularity)):
        recs.append(lake.write_layer(df, root, "gold", name))
    if rows_in is not None:
        rows_in.append(sum(int(o.get["rows"]) for o in counted))
    return recs


def load_star(spark: SparkSession, root: str, rows: dict | None = None) -> str:
    """Full refresh of the warehouse from the written gold layer = a new
    snapshot of the five dimensions and the fact.  A fact without its dimension
    row stops the load before the pointer moves."""
    read = lambda name: lake.read_layer(spark, root, "gold", name)
    countries, skills, sources = wh.d_country(spark), wh.d_skill(spark), wh.d_source(spark)
    companies = wh.d_company(read("dim_company"))
    tables = {"d_date": read("dim_date"), "d_country": countries, "d_company": companies, "d_skill": skills, "d_source": sources,
              "fact_job": wh.fact_job(read("fact_job"), countries, companies, skills, sources)}
    return wh.write_snapshot(spark, tables, f"{root}/warehouse", check=lambda snap: wh.check_keys(spark.read.parquet(f"{snap}/fact_job")), rows=rows)


def load_increment(spark: SparkSession, root: str, batch_silver: DataFrame) -> str:
    """One batch of silver rows through the gates into the loaded warehouse, as a new snapshot with stable ids."""
    batch = mb.gate_batch(batch_silver)
    names = ["d_date", "d_country", "d_company", "d_skill", "d_source", "fact_job"]
    star = {n: wh.read_table(spark, f"{root}/warehouse", n) for n in names}
    star = wh.increment_star(star, batch, gold.company_increment(gold.salary_frame(batch_silver)))
    return wh.write_snapshot(spark, star, f"{root}/warehouse", check=lambda snap: wh.check_keys(spark.read.parquet(f"{snap}/fact_job")))


DIMS = {"dim_date", "dim_company", "dim_country", "dim_skill", "dim_source"}


def run_layers(spark: SparkSession, sf_dir: str, root: str) -> tuple[list[dict], list[tuple]]:
    """Bronze, silver and gold of a run: manifest records, and (stage, datasets, rows read, rows written, sizes
    of the dimensions, seconds).  Bronze reads no layer, so its rows read are null."""
    records, metrics = [], []
    for stage, build in (("bronze", lambda seen: build_bronze(spark, sf_dir, root)), ("silver", lambda seen: build_silver(spark, sf_dir, root, rows_in=seen)),
                         ("gold", lambda seen: build_gold(spark, root, rows_in=seen))):
        began, seen = time.perf_counter(), []
        made = build(seen)
        dims = {r["dataset"]: r["rows"] for r in made if r["dataset"] in DIMS}
        metrics.append((stage, len(made), seen[0] if seen else None, sum(r["rows"] for r in made), dims, time.perf_counter() - began))
        records += made
    lake.record(spark, None, records).write.mode("overwrite").parquet(f"{root}/manifest")
    return records, metrics


def run_all(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """K3: bronze -> silver -> gold -> warehouse with per-stage metrics ``(stage, datasets, rows_in, rows, dims,
    seconds)``, counted while rows are read and written, and the manifest (K1) written."""
    records, metrics = run_layers(spark, sf_dir, root)
    began, rows = time.perf_counter(), {}
    load_star(spark, root, rows)
    read = sum(r["rows"] for r in records if r["layer"] == "gold" and r["dataset"] in {"fact_job", "dim_date", "dim_company"})
    metrics.append(("warehouse", len(rows), read, sum(rows.values()), {k: n for k, n in rows.items() if k != "fact_job"}, time.perf_counter() - began))
    return spark.createDataFrame([(s, n, i, r, d, round(t, 3)) for s, n, i, r, d, t in metrics],
                                 "stage string, datasets int, rows_in bigint, rows bigint, dims map<string,bigint>, seconds double")


def register_external_table(spark: SparkSession, name: str, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Expose a parquet dataset as a SQL table over its location (the
    schema comes from the files).  Point it at the directory that is actually
    written (the reference's table prefix and upload path disagree).

    With ``partition_by`` the folders become partitions of the table, and table and column statistics are
    gathered for the optimiser.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if not partition_by:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
        return spark.table(name)
    held = spark.read.parquet(path)
    columns = ", ".join(f"`{f.name}` {'string' if f.name in partition_by else f.dataType.simpleString()}" for f in held.schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.table(name)


def backfill_days(spark: SparkSession, silver: DataFrame, days: list[str], root: str) -> DataFrame:
    """(re)run any days by key, in one job.  A day's batch fact overwrites only its
    own ``date_posted`` partition (dynamic partition overwrite), so re-running
    a day is idempotent and never touches other days."""
    path = f"{root}/fact_by_day"
    batch = silver.where(F.col("date_posted").isin(list(days)))  # partition pruning on a date-partitioned silver
    (lake.clustered(gold.build_fact(gold.salary_frame(batch)), "date_posted").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("date_posted").parquet(path))
    return spark.read.parquet(path)
