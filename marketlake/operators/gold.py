"""Gold layer: fact table, dimensions, popularity.

The fact is one hash aggregation over the 5-column grain with map-side
partial aggregation (integer cent sums, min, max, counts are all mergeable),
so a hot grain key collapses to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import avg_cents, avg_tenths, date_parts, fill_unknown_company, round2


def salary_frame(silver: DataFrame) -> DataFrame:
    """Union of silver salary sources with B12 applied (null/'' -> Unknown)."""
    return silver.withColumn("company", fill_unknown_company("company"))


def build_fact(salary: DataFrame, valid: Column | None = None) -> DataFrame:
    """Group by the grain, null keys kept.

    ``avg/min/max`` of ``salary_eur`` skip nulls; ``job_count`` counts rows,
    null salaries included; measures rounded to cents.

    ``valid`` (e.g. the C1 quality rule) restricts the rows aggregated; a group
    without any valid row is dropped.  Folding the row filter into the
    aggregation gives the same rows as filtering first, but the rule is
    evaluated once per row: a plain filter would be pushed below the cleaning
    projections with every parsing expression substituted into it.
    """
    if valid is None:
        return (salary.groupBy(*config.FACT_GRAIN)
                .agg(avg_cents("salary_eur").alias("avg_salary"),
                     round2(F.min("salary_eur")).alias("min_salary"),
                     round2(F.max("salary_eur")).alias("max_salary"),
                     F.count(F.lit(1)).alias("job_count")))
    ok = F.col("_valid")
    v = F.when(ok, F.col("salary_eur"))
    return (salary.withColumn("_valid", F.coalesce(valid, F.lit(False)))
            .groupBy(*config.FACT_GRAIN)
            .agg(avg_cents(v).alias("avg_salary"),
                 round2(F.min(v)).alias("min_salary"),
                 round2(F.max(v)).alias("max_salary"),
                 F.count_if(ok).alias("job_count"))
            .where(F.col("job_count") > 0))


def distinct_dates(salary: DataFrame) -> DataFrame:
    """Distinct non-null posting dates."""
    return salary.select("date_posted").where(F.col("date_posted").isNotNull()).distinct()


def build_dim_date(salary: DataFrame) -> DataFrame:
    """distinct dates with day, month, quarter, year, weekday (Mon = 0)."""
    d = distinct_dates(salary)
    parts = date_parts("date_posted")
    return d.select(F.col("date_posted").alias("date_key"), *[v.alias(k) for k, v in parts.items()])


def build_dim_country(spark: SparkSession) -> DataFrame:
    """the country registry."""
    return spark.createDataFrame(config.COUNTRIES, "iso2 string, country_name string, region string, monnaie_iso3 string")


def build_dim_skill(spark: SparkSession) -> DataFrame:
    """the skill registry."""
    return spark.createDataFrame(config.SKILLS, "tech_label string, skill_group string")


def build_dim_source(spark: SparkSession) -> DataFrame:
    """all sources, popularity ones included."""
    return spark.createDataFrame([(s,) for s in config.ALL_SOURCES], "source_name string")


def distinct_companies(salary: DataFrame) -> DataFrame:
    """Distinct non-null companies appearing in the facts."""
    return salary.select(F.col("company").alias("company_name")).where("company_name is not null").distinct()


def distinct_values(salary: DataFrame) -> DataFrame:
    """``(kind, value)`` of the non-null posting dates and companies, in one pass over the rows."""
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in (("date", "date_posted"), ("company", "company"))]
    return salary.select(F.inline(F.array(*kinds))).where(F.col("value").isNotNull()).distinct()


def company_increment(batch: DataFrame) -> DataFrame:
    """companies of a micro-batch, attributes null (they overwrite known ones)."""
    return distinct_companies(batch).select(
        "company_name", F.lit(None).cast("string").alias("workforce_size"),
        F.lit(None).cast("string").alias("sector"))


def repo_popularity(repos_silver: DataFrame) -> DataFrame:
    """Stars and forks summed per skill (null skills dropped, as pandas does)."""
    return (repos_silver.where(F.col("skill").isNotNull()).groupBy("skill")
            .agg(F.sum("stars").cast("bigint").alias("total_stars"),
                 F.sum("forks").cast("bigint").alias("total_forks")))


def search_interest(trends_silver: DataFrame) -> DataFrame:
    """Mean interest per skill, 1 dp."""
    return (trends_silver.where(F.col("skill").isNotNull()).groupBy("skill")
            .agg(avg_tenths(F.col("interest").cast("double")).alias("avg_interest")))


def skill_popularity(repos_silver: DataFrame, trends_silver: DataFrame) -> DataFrame:
    """Repository stats full-outer-joined with search interest on skill."""
    return repo_popularity(repos_silver).join(search_interest(trends_silver), "skill", "full_outer")
