"""Star-schema warehouse on parquet tables.

PostgreSQL's UPSERT is re-expressed as set operations (stock Spark cannot
MERGE INTO a parquet table): ``batch ∪ (target ⟕anti batch)`` for updates,
``target ∪ (batch ⟕anti target)`` for insert-if-absent.  Both shuffle once on
the natural key; duplicates inside a batch are resolved by a mergeable
``max_by`` on a sequence column (partial-aggregated, so a hot key is not
collected into one task).  A full refresh writes a new snapshot directory and
adds a numbered pointer last, so readers never see a half-written warehouse.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config, storage
from ..functions import date_parts
from .ranking import global_index

FACT_MEASURES = ["avg_salary", "min_salary", "max_salary", "job_count"]


# ------------------------------------------------------------ dimensions

def registry_dim(spark: SparkSession, rows: list[tuple], schema: str, id_col: str) -> DataFrame:
    """F7 for registry dims: ids follow insertion (registry) order, from 1."""
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], f"{id_col} int, {schema}")


def d_country(spark: SparkSession) -> DataFrame:
    return registry_dim(spark, config.COUNTRIES,
                        "iso2 string, country_name string, region string, monnaie_iso3 string", "id_country")


def d_skill(spark: SparkSession) -> DataFrame:
    return registry_dim(spark, config.SKILLS, "tech_label string, skill_group string", "id_skill")


def d_source(spark: SparkSession) -> DataFrame:
    return registry_dim(spark, [(s,) for s in config.ALL_SOURCES], "source_name string", "id_source")


def d_company(dim_company: DataFrame) -> DataFrame:
    """company ids in name order (the load inserts companies sorted)."""
    return global_index(dim_company, [F.col("company_name"), F.col("workforce_size"), F.col("sector")],
                        "id_company").select(F.col("id_company").cast("int"), "company_name",
                                             "workforce_size", "sector")


# ------------------------------------------------------------------ fact

def fact_job(fact: DataFrame, countries: DataFrame, companies: DataFrame, skills: DataFrame,
             sources: DataFrame) -> DataFrame:
    """D2 + F7: natural keys -> surrogate ids; ``id_fact`` in grain order.

    Country, skill and source dims are fixed registries (proven tiny):
    broadcast.  The company dim grows with the data: a plain equi-join, Spark
    broadcasts it only under its measured size threshold.  A key missing from
    its dimension leaves a null id: ``fk_violations`` reports it and
    ``check_keys`` stops the load (the reference raises ``KeyError``).  Facts
    without a known company share one name, so they get its id from a row of
    their own instead of meeting in one task of the company join.
    """
    f = (fact
         .join(F.broadcast(countries.select("iso2", "id_country")), fact["country_iso2"] == F.col("iso2"), "left")
         .join(F.broadcast(skills.select("tech_label", "id_skill")), fact["skill"] == F.col("tech_label"), "left")
         .join(F.broadcast(sources.select("source_name", "id_source")), fact["source"] == F.col("source_name"), "left")
         .join(companies.select("company_name", "id_company"), F.when(fact["company"] != config.UNKNOWN_COMPANY, fact["company"])
               .otherwise(F.concat(F.lit("\\0"), F.xxhash64(*[fact[c] for c in config.FACT_GRAIN]).cast("string"))) == F.col("company_name"), "left"))
    # at most one row: the name is unique
    unknown = F.broadcast(companies.where(F.col("company_name") == config.UNKNOWN_COMPANY).select(
        F.col("company_name").alias("_unknown"), F.col("id_company").alias("_unknown_id")).limit(1))
    f = f.join(unknown, fact["company"] == F.col("_unknown"), "left").withColumn("id_company", F.coalesce("id_company", "_unknown_id"))
    f = global_index(f, [F.col(c).asc_nulls_first() for c in config.FACT_GRAIN], "id_fact")
    return f.select(
        F.col("id_fact").cast("bigint"), F.col("date_posted").alias("date_key"),
        "id_country", "id_company", "id_skill", "id_source", *FACT_MEASURES)


def star_natural(fact_job_df: DataFrame, countries: DataFrame, companies: DataFrame, skills: DataFrame,
                 sources: DataFrame, dates: DataFrame) -> DataFrame:
    """D3: fact ⋈ date, country, skill, source (inner), plus company, back to
    natural keys and date parts, for filtering and grouping."""
    return (fact_job_df
            .join(dates.select("date_key", "year", "month"), "date_key")
            .join(F.broadcast(countries.select("id_country", "iso2")), "id_country")
            .join(F.broadcast(skills.select("id_skill", "tech_label")), "id_skill")
            .join(F.broadcast(sources.select("id_source", "source_name")), "id_source")
            .join(companies.select("id_company", "company_name"), "id_company")
            .select(F.col("date_key").alias("date_posted"), F.col("iso2").alias("country_iso2"),
                    F.col("tech_label").alias("skill"), F.col("company_name").alias("company"),
                    F.col("source_name").alias("source"), "year", "month", *FACT_MEASURES))


def fk_violations(fact_job_df: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per declared FK, fact rows whose key is null or absent from the
    dimension (left anti joins), long form ``(fk, violations)``."""
    parts = []
    for fk, (dim, key) in dims.items():
        anti = fact_job_df.select(fk).join(dim.select(F.col(key).alias(fk)), fk, "left_anti")
        parts.append(anti.agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
                     .select(F.lit(fk).alias("fk"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each warehouse table, long form."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class MissingKeyError(ValueError):
    """A fact refers to a dimension row that does not exist."""


def check_keys(fact_job_df: DataFrame) -> None:
    """Stop the load when a surrogate key was not found (one aggregation)."""
    ids = ["id_country", "id_company", "id_skill", "id_source"]
    lost = fact_job_df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ids]).first()
    if any(lost[c] for c in ids):
        raise MissingKeyError(f"facts without a dimension row: {({c: lost[c] for c in ids if lost[c]})}")


def increment_star(star: dict[str, DataFrame], batch_fact: DataFrame, batch_companies: DataFrame) -> dict[str, DataFrame]:
    """One batch into a loaded star schema.

    Known companies and facts keep their ids (attributes and measures are
    overwritten); new ones get ``max(id) +`` their place in natural order; dates
    are added where absent.  The registry dimensions do not change.
    """
    companies = star["d_company"]
    top = companies.agg(F.coalesce(F.max("id_company"), F.lit(0))).first()[0]
    names = batch_companies.select("company_name", "workforce_size", "sector").dropDuplicates(["company_name"])
    fresh = global_index(names.join(companies, "company_name", "left_anti"), [F.col("company_name")], "id_company", start=top + 1)
    known = companies.select("id_company", "company_name").join(names, "company_name")
    columns = companies.columns
    companies = (companies.join(names, "company_name", "left_anti").select(columns)
                 .unionByName(known.select(columns)).unionByName(fresh.select(F.col("id_company").cast("int"), *columns[1:])))
    parts = date_parts("date_posted")
    dates = upsert_ignore(star["d_date"], batch_fact.select(F.col("date_posted").alias("date_key"), *[v.alias(k) for k, v in parts.items()])
                          .where("date_key is not null"), ["date_key"])
    keys = ["date_key", "id_country", "id_company", "id_skill", "id_source"]
    batch = fact_job(batch_fact, star["d_country"], companies, star["d_skill"], star["d_source"]).drop("id_fact")
    old = star["fact_job"]
    top = old.agg(F.coalesce(F.max("id_fact"), F.lit(0))).first()[0]
    ids = old.select("id_fact", *[F.col(k).alias(f"_o_{k}") for k in keys])
    met = batch.join(ids, [batch[k].eqNullSafe(F.col(f"_o_{k}")) for k in keys], "left").select("id_fact", *batch.columns)
    new = _null_safe_anti(batch, old, keys)
    order = (new.join(star["d_country"].select("id_country", "iso2"), "id_country", "left").join(star["d_skill"].select("id_skill", "tech_label"), "id_skill", "left")
             .join(companies.select("id_company", "company_name"), "id_company", "left").join(star["d_source"].select("id_source", "source_name"), "id_source", "left"))
    new = global_index(order, [F.col(c).asc_nulls_first() for c in ("date_key", "iso2", "tech_label", "company_name", "source_name")], "id_fact", start=top + 1)
    facts = (_null_safe_anti(old, batch, keys).unionByName(met.where("id_fact is not null").select(old.columns))
             .unionByName(new.select(F.col("id_fact").cast("bigint"), *old.columns[1:])))
    return {**star, "d_company": companies, "d_date": dates, "fact_job": facts}


# --------------------------------------------------------------- upserts

def dedupe_last(batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Last row per key by ``seq`` wins (``max_by``: mergeable, map-side combined)."""
    cols = [c for c in batch.columns if c not in keys and c != seq]
    agg = batch.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(seq)).alias("_last"))
    return agg.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in cols])


def _null_safe_anti(target: DataFrame, batch_keys: DataFrame, keys: list[str]) -> DataFrame:
    bk = batch_keys.select(*[F.col(k).alias(f"_b_{k}") for k in keys]).distinct()
    cond = [target[k].eqNullSafe(bk[f"_b_{k}"]) for k in keys]
    return target.join(bk, cond, "left_anti")


def upsert_update(target: DataFrame, batch: DataFrame, keys: list[str], seq: str | None = None,
                  keep_known: bool = False) -> DataFrame:
    """Insert new keys, overwrite the non-key columns of known keys.

    Parity default: attributes are overwritten even by null (the reference's
    ``DO UPDATE SET x = EXCLUDED.x``).  ``keep_known=True`` keeps a known
    non-null value where the batch brings null.
    """
    b = dedupe_last(batch, keys, seq) if seq else batch
    b = b.select(*target.columns)
    if keep_known:
        cols = [c for c in target.columns if c not in keys]
        t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols])
        cond = [b[k].eqNullSafe(t[k]) for k in keys]
        b = b.join(t, cond, "left").select(*[b[k] for k in keys],
                                           *[F.coalesce(b[c], F.col(f"_t_{c}")).alias(c) for c in cols])
    return _null_safe_anti(target, b, keys).unionByName(b)


def upsert_ignore(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Insert only keys not present yet (``ON CONFLICT DO NOTHING``)."""
    b = batch.select(*target.columns).dropDuplicates(keys)
    return target.unionByName(_null_safe_anti(b, target, keys))


def upsert_fact(target: DataFrame, batch: DataFrame, grain: list[str], seq: str | None = None) -> DataFrame:
    """Overwrite the four measures at the grain; last batch row wins."""
    return upsert_update(target, batch, grain, seq)


# ------------------------------------------------------- snapshot refresh

def write_snapshot(spark: SparkSession, tables: dict[str, DataFrame], root: str, check=None, keep: int = 2, rows: dict | None = None) -> str:
    """I4: full refresh = write every table into a new snapshot folder, then add
    a numbered pointer to it.  Readers follow the highest committed pointer, so
    a failed refresh, or one that ``check(snapshot folder)`` refuses, leaves the
    previous snapshot in place.  Two refreshes at once leave two whole snapshots;
    the pointer written later is the current one.  ``rows`` receives the number of
    rows written to each table.  The last ``keep`` snapshots stay.  All writes go
    through Spark, so ``root`` may be any shared filesystem."""
    root = root.rstrip("/")
    snap = f"{root}/snapshot-{uuid.uuid4().hex[:12]}"
    for name, df in tables.items():
        seen = Observation(f"rows_{name}_{uuid.uuid4().hex[:8]}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{snap}/{name}")
        if rows is not None:
            rows[name] = int(seen.get["rows"])
    if check:
        check(snap)
    storage.append_entry(spark, f"{root}/pointer", snap)
    old = [r["value"] for r in storage.entries(spark, f"{root}/pointer").orderBy("number").collect()][:-keep]
    for path in old:
        storage.remove(spark, path)
    return snap


def current_snapshot(spark: SparkSession, root: str) -> str:
    return storage.last_entry(spark, f"{root.rstrip('/')}/pointer")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{current_snapshot(spark, root)}/{name}")
