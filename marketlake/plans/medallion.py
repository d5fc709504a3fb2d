"""Canonical medallion plans, lazily composed from the driver tables.

``observations -> bronze shapes -> silver (M1-M4, C1) -> gold fact (E1)``.
``silver``, ``salary`` and ``fact`` run no action: each returns a plan that
Catalyst optimises as a whole, with every scan pruned to the columns it needs.
``fact_once`` and ``star`` write the fact while the plan is built, since several
consumers read it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import cleaners, gold, lake
from ..sources import adapter, registry
from ..sources.readers import with_na_tokens
from ..session import fresh_path, materialize


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.observations(spark, sf_dir)


def silver_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All registered salary sources, cleaned in one pass, before the quality filter."""
    return registry.silver_all(observations(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 (salary part): silver after C1, all sources in one pass."""
    return registry.silver_all(observations(spark, sf_dir), valid=True)


def silver_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written once by ``date_posted``, as a run keeps it: a day's rows are one folder."""
    rows = silver(spark, sf_dir)
    path = fresh_path(spark, "silver-by-day")
    lake.clustered(rows, "date_posted").write.partitionBy("date_posted").parquet(path)
    return spark.read.schema(rows.schema).parquet(path).select(rows.columns)


def silver_of_days(spark: SparkSession, sf_dir: str, wanted: Callable[[Column], Column]) -> DataFrame:
    """Silver of the days that ``wanted`` picks: observations of other days are dropped before they are parsed
    (the survey's rows all have its own fixed date, whatever the observation's)."""
    day = F.when(F.col("src") == "so_survey", F.lit(config.AS_OF_DATE)).otherwise(F.col("date_posted"))
    rows = registry.silver_all(observations(spark, sf_dir).where(wanted(day)), valid=True)
    return rows.where(wanted(F.col("date_posted")))


def salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold input: silver with B12 applied."""
    return gold.salary_frame(silver(spark, sf_dir))


def silver_parts(spark: SparkSession, sf_dir: str, filtered: bool = True) -> list[DataFrame]:
    """Silver of each registered source on its own (after C1 unless
    ``filtered=False``), for results reported per source."""
    obs = observations(spark, sf_dir)
    return [registry.silver_source(obs, s.name, valid=filtered) for s in registry.REGISTRY]


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 core: the gold fact table.

    One join, one pass of every source's parser, C1 folded into the
    aggregation, one hash aggregation on the grain (partial aggregation before
    the shuffle).
    """
    rows = gold.salary_frame(registry.silver_all(observations(spark, sf_dir)))
    return gold.build_fact(rows, valid=cleaners.quality_rule())


def repositories_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaners.clean_repositories(adapter.repositories(spark, sf_dir))


def trends_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.readers import wide_to_long
    wide = adapter.interest_wide(observations(spark, sf_dir))
    long = wide_to_long(wide, ["date", "country"], adapter.SKILL_DISPLAY)
    return cleaners.clean_trends(long)


def company_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_na_tokens(adapter.company_register(spark, sf_dir))


def distinct_salary(spark: SparkSession, sf_dir: str, fn) -> DataFrame:
    """``fn(salary).distinct()``: partial de-duplication before the shuffle."""
    return fn(salary(spark, sf_dir)).distinct()


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 over every source's dates."""
    dates = distinct_salary(spark, sf_dir, gold.distinct_dates)
    return gold.build_dim_date(dates)


def dim_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies present in the facts, left-joined to the register."""
    names = distinct_salary(spark, sf_dir, gold.distinct_companies)
    return names.join(company_register(spark, sf_dir), "company_name", "left")


def fact_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact, computed once and written to the shared checkpoint folder,
    for plans that read it several times (star schema, upserts)."""
    return materialize(fact(spark, sf_dir), "fact")


def dims_from_fact(f: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F1 and the F5 key set from the (small, aggregated) fact instead of a
    second pass over silver: the fact holds exactly the silver dates and the
    B12-filled companies."""
    dates = gold.build_dim_date(f.select("date_posted").where("date_posted is not null").distinct())
    names = f.select(F.col("company").alias("company_name")).where("company_name is not null").distinct()
    return dates, names


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """M9: the star schema (five dimensions with surrogate ids + fact_job)."""
    return star_of(spark, sf_dir, fact_once(spark, sf_dir))


def star_of(spark: SparkSession, sf_dir: str, f: DataFrame) -> dict[str, DataFrame]:
    """The star schema of a (stored) fact."""
    from ..operators import warehouse as wh
    countries, skills, sources = wh.d_country(spark), wh.d_skill(spark), wh.d_source(spark)
    dates, names = dims_from_fact(f)
    companies = wh.d_company(names.join(company_register(spark, sf_dir), "company_name", "left"))
    return {
        "d_date": dates, "d_country": countries, "d_company": companies,
        "d_skill": skills, "d_source": sources,
        "fact_job": wh.fact_job(f, countries, companies, skills, sources),
    }
