"""Registered queries over silver and gold: filters (C), joins and the star
schema (D, F), aggregations (E), arrays/sort/limit (G), data quality (H),
upserts and micro-batches (I), lake monitoring (K), streams (I10)."""

from __future__ import annotations

import functools

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import cents, split_skill_list, to_decimal_12_2
from ..operators import cleaners, gold, lake, quality, warehouse as wh
from ..operators import indicators as ind
from ..operators.quantiles import grouped_percentiles
from ..operators.ranking import global_index
from ..sources import adapter
from ..sources.tables import load
from ..streaming import microbatch as mb
from .. import storage
from . import medallion as md
from . import oracle as o
from ..session import fresh_path, materialize
from .catalog import query
from .pipeline_run import load_star, register_external_table, run_all, run_layers, split_band
from .catalog_sources import REPO_SILVER_SQL, TRENDS_SILVER_SQL

# Parameters of the incremental scenarios: the batch day and a replayed day.
BATCH_DATE = "2001-07-01"
REPLAY_DATE = "2001-06-01"
WATERMARK = "2001-01-01"

SILVER_SQL = o.with_ctes(o.OBS, o.SILVER_RAW, o.SILVER)
SALARY_SQL = o.with_ctes(o.OBS, o.SILVER_RAW, o.SILVER, o.SALARY)


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------- C

@query("reject_rate", o.with_ctes(o.OBS, o.SILVER_RAW) + """SELECT source,
  CAST(count(*) AS BIGINT) AS rows_before,
  CAST(count(*) FILTER (WHERE country_iso2 IS NOT NULL AND skill IS NOT NULL AND salary_eur IS NOT NULL
                        AND salary_eur > 0) AS BIGINT) AS rows_kept,
  CAST(count(*) FILTER (WHERE NOT (country_iso2 IS NOT NULL AND skill IS NOT NULL AND salary_eur IS NOT NULL
                        AND salary_eur > 0)) AS BIGINT) AS rows_rejected
FROM silver_raw GROUP BY source""")
def q_reject_rate(spark, sf):
    """Rows before, kept and rejected by the quality filter, per source, one pass."""
    return cleaners.reject_rate(md.silver_raw(spark, sf))


@query("filter_common", o.fact_sql("""SELECT * FROM fact WHERE country_iso2 = 'US' AND skill = 'python'
  AND source = 'indeed'"""))
def q_filter_common(spark, sf):
    """Optional equality filters on the fact (case-folded literals)."""
    return ind.filter_common(md.fact(spark, sf), country="us", skill="PYTHON", source="Indeed")


@query("case_fold_filters", o.fact_sql(f"""SELECT date_posted AS date, {o.avgc('avg_salary')} AS avg_salary,
  CAST(sum(job_count) AS BIGINT) AS job_count FROM fact
  WHERE country_iso2 = 'GB' AND skill = 'sql' AND source = 'adzuna' GROUP BY date_posted"""))
def q_case_fold_filters(spark, sf):
    """Country upper-cased, skill and source lower-cased before filtering."""
    return ind.salary_daily(md.fact(spark, sf), country="gb", skill="SQL", source="ADZUNA")


@query("fresh_since_watermark", SILVER_SQL + f"""SELECT 'after' AS mode, date_posted, source,
  CAST(count(*) AS BIGINT) AS rows FROM silver WHERE date_posted > '{WATERMARK}' GROUP BY 2, 3
UNION ALL SELECT 'next_day', date_posted, source, CAST(count(*) AS BIGINT) FROM silver
  WHERE date_posted = CAST(CAST('{REPLAY_DATE}' AS DATE) - INTERVAL 1 DAY + INTERVAL 1 DAY AS DATE)::VARCHAR
  GROUP BY 2, 3""")
def q_fresh_since_watermark(spark, sf):
    """Offers newer than the watermark, and exactly the next day."""
    before = str(date.fromisoformat(REPLAY_DATE) - timedelta(days=1))
    # one pass over the days that either mode wants; other days are not parsed
    days = md.silver_of_days(spark, sf, lambda d: (d > WATERMARK) | (d == REPLAY_DATE))
    held = days.groupBy("date_posted", "source").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
    return _union([mb.fresh_since(held, WATERMARK).withColumn("mode", F.lit("after")),
                   mb.fresh_since(held, before, one_day=True).withColumn("mode", F.lit("next_day"))]).select("mode", "date_posted", "source", "rows")


_HOT_ITEMS_SQL = f"""SELECT 'country#' || country_iso2 AS pk, 'skill#' || skill AS sk,
  {o.pct2('avg_salary', 0.5)} AS median_salary_eur, {o.avgc('avg_salary')} AS avg_salary_eur,
  CAST(sum(job_count) AS BIGINT) AS volume FROM fact
  WHERE country_iso2 IS NOT NULL AND skill IS NOT NULL GROUP BY country_iso2, skill"""


@query("hot_indicator_items", o.fact_sql(_HOT_ITEMS_SQL))
def q_hot_indicator_items(spark, sf):
    """Key-value items keyed ``country#XX`` / ``skill#yy``."""
    return ind.hot_indicator_items(md.fact(spark, sf))


@query("hot_indicator_lookup", o.fact_sql(f"SELECT * FROM ({_HOT_ITEMS_SQL}) WHERE pk = 'country#FR' AND sk = 'skill#python'"))
def q_hot_indicator_lookup(spark, sf):
    """A16 + C7: items stored by pk, then a lookup with the default keys (FR, python) that reads one folder."""
    items = ind.write_hot_items(ind.hot_indicator_items(md.fact(spark, sf)), fresh_path(spark, "hot-items"))
    return ind.hot_indicator_lookup(items)


@query("minimise_columns", o.fact_sql("""SELECT country_iso2, skill, source, avg_salary, job_count FROM fact"""))
def q_minimise_columns(spark, sf):
    """K5: publish only the aggregate columns the indicators need."""
    return md.fact(spark, sf).select("country_iso2", "skill", "source", "avg_salary", "job_count")


@query("to_decimal_12_2", o.fact_sql("""SELECT date_posted, country_iso2, skill, company, source,
  CAST(CAST(avg_salary AS DECIMAL(12,2)) AS VARCHAR) AS avg_salary_dec FROM fact"""))
def q_to_decimal_12_2(spark, sf):
    """Measures as the warehouse stores them (NUMERIC(12,2)), shown as text."""
    f = md.fact(spark, sf)
    return f.select(*config.FACT_GRAIN, to_decimal_12_2("avg_salary").cast("string").alias("avg_salary_dec"))


# --------------------------------------------------------------- D / F

@query("dim_company_join", o.with_ctes(*o.UP_TO_FACT, o.REG, o.DIM_COMPANY) + "SELECT * FROM dim_company")
def q_dim_company_join(spark, sf):
    """Companies present in facts left-joined to the register."""
    return md.dim_company(spark, sf)


@query("dim_date", o.with_ctes(*o.UP_TO_FACT, o.DIM_DATE) + "SELECT * FROM dim_date")
def q_dim_date(spark, sf):
    """Distinct dates with day, month, quarter, year, weekday (Mon=0)."""
    return md.dim_date(spark, sf)


@query("surrogate_keys", o.star_sql("SELECT * FROM d_company"))
def q_surrogate_keys(spark, sf):
    """dense company ids in name order, without a single-task window."""
    return md.star(spark, sf)["d_company"]


@query("star_fact", o.star_sql("SELECT * FROM fact_job"))
def q_star_fact(spark, sf):
    """Fact with surrogate ids looked up from the dimensions."""
    return md.star(spark, sf)["fact_job"]


@query("star_cube_cs", o.fact_sql(f"""SELECT country_iso2 AS country, skill, {o.avgc('avg_salary')} AS avg_salary,
  {o.pct2('avg_salary', 0.5)} AS median_salary, CAST(sum(job_count) AS BIGINT) AS job_count
  FROM fact GROUP BY country_iso2, skill"""))
def q_star_cube_cs(spark, sf):
    """D3: the country x skill cube answered through the star joins."""
    s = md.star(spark, sf)
    nat = wh.star_natural(s["fact_job"], s["d_country"], s["d_company"], s["d_skill"], s["d_source"], s["d_date"])
    return ind.salary_cube(nat, "country,skill")


def _not_in(col: str, values: str) -> str:
    return f"coalesce(NOT list_contains({values}, {col}), true)"


@query("dq_fact_integrity", o.fact_sql(f"""SELECT CAST(count(*) AS BIGINT) AS fact_rows,
  CAST(count(*) FILTER (WHERE {_not_in('country_iso2', o.ISO2_LIST)}) AS BIGINT) AS orphans,
  count(*) > 0 AND count(*) FILTER (WHERE {_not_in('country_iso2', o.ISO2_LIST)}) = 0 AS passed FROM fact"""))
def q_dq_fact_integrity(spark, sf):
    """Fact non-empty and no fact without its country (left anti join)."""
    s = md.star(spark, sf)
    return quality.fact_integrity(s["fact_job"], s["d_country"], "id_country", "id_country")


@query("fk_check_all", o.fact_sql(f"""SELECT 'date_key' AS fk, CAST(count(*) FILTER (WHERE date_posted IS NULL) AS BIGINT) AS violations FROM fact
UNION ALL SELECT 'id_country', CAST(count(*) FILTER (WHERE {_not_in('country_iso2', o.ISO2_LIST)}) AS BIGINT) FROM fact
UNION ALL SELECT 'id_company', CAST(count(*) FILTER (WHERE company IS NULL) AS BIGINT) FROM fact
UNION ALL SELECT 'id_skill', CAST(count(*) FILTER (WHERE {_not_in('skill', o.SKILL_LIST)}) AS BIGINT) FROM fact
UNION ALL SELECT 'id_source', CAST(count(*) FILTER (WHERE {_not_in('source', o.SOURCE_LIST)}) AS BIGINT) FROM fact"""))
def q_fk_check_all(spark, sf):
    """The five declared foreign keys, checked by left anti joins."""
    s = md.star(spark, sf)
    return wh.fk_violations(s["fact_job"], {
        "date_key": (s["d_date"], "date_key"), "id_country": (s["d_country"], "id_country"),
        "id_company": (s["d_company"], "id_company"), "id_skill": (s["d_skill"], "id_skill"),
        "id_source": (s["d_source"], "id_source")})


@query("table_counts", o.star_sql(f"""SELECT 'd_date' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM dim_date
UNION ALL SELECT 'd_country', CAST({len(config.COUNTRIES)} AS BIGINT)
UNION ALL SELECT 'd_company', CAST(count(*) AS BIGINT) FROM d_company
UNION ALL SELECT 'd_skill', CAST({len(config.SKILLS)} AS BIGINT)
UNION ALL SELECT 'd_source', CAST({len(config.ALL_SOURCES)} AS BIGINT)
UNION ALL SELECT 'fact_job', CAST(count(*) AS BIGINT) FROM fact_job"""))
def q_table_counts(spark, sf):
    """Row count of each warehouse table."""
    return wh.table_counts(md.star(spark, sf))


@query("dim_company_increment", SALARY_SQL + f"""SELECT DISTINCT company AS company_name,
  CAST(NULL AS VARCHAR) AS workforce_size, CAST(NULL AS VARCHAR) AS sector
  FROM salary WHERE date_posted = '{BATCH_DATE}' AND company IS NOT NULL""")
def q_dim_company_increment(spark, sf):
    """companies of one day's batch, attributes null."""
    day = gold.salary_frame(md.silver_of_days(spark, sf, lambda d: d == BATCH_DATE))
    names = gold.distinct_companies(day)
    return names.select("company_name", F.lit(None).cast("string").alias("workforce_size"),
                        F.lit(None).cast("string").alias("sector"))


# ------------------------------------------------------------------- E

@query("repo_popularity", f"""SELECT skill, CAST(sum(stars) AS BIGINT) AS total_stars,
  CAST(sum(forks) AS BIGINT) AS total_forks FROM ({REPO_SILVER_SQL}) WHERE skill IS NOT NULL GROUP BY skill""")
def q_repo_popularity(spark, sf):
    """Stars and forks per skill; null skills dropped."""
    return gold.repo_popularity(md.repositories_silver(spark, sf))


_INTEREST_SQL = f"""SELECT skill, floor(CAST(sum(CAST(floor(CAST(interest AS DOUBLE)*10+0.5) AS BIGINT)) AS DOUBLE)
  / count(interest) + 0.5) / 10 AS avg_interest FROM ({TRENDS_SILVER_SQL}) WHERE skill IS NOT NULL GROUP BY skill"""


@query("search_interest", _INTEREST_SQL)
def q_search_interest(spark, sf):
    """Mean search interest per skill, 1 dp."""
    return gold.search_interest(md.trends_silver(spark, sf))


@query("skill_popularity", f"""SELECT coalesce(r.skill, t.skill) AS skill, r.total_stars, r.total_forks, t.avg_interest
FROM (SELECT skill, CAST(sum(stars) AS BIGINT) AS total_stars, CAST(sum(forks) AS BIGINT) AS total_forks
      FROM ({REPO_SILVER_SQL}) WHERE skill IS NOT NULL GROUP BY skill) r
FULL OUTER JOIN ({_INTEREST_SQL}) t ON r.skill = t.skill""")
def q_skill_popularity(spark, sf):
    """Repository stats full-outer-joined with search interest."""
    return gold.skill_popularity(md.repositories_silver(spark, sf), md.trends_silver(spark, sf))


_PROBS = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


@query("percentile_cont", o.fact_sql("SELECT source, " + ", ".join(
    f"{o.pct2('avg_salary', p)} AS {k}" for k, p in _PROBS.items())
    + ", CAST(count(*) AS BIGINT) AS n FROM fact GROUP BY source"))
def q_percentile_cont(spark, sf):
    """Ordered-set percentiles (linear interpolation) per source."""
    f = md.fact(spark, sf).select("source", cents("avg_salary").cast("double").alias("_cv"))
    r = grouped_percentiles(f, ["source"], "_cv", {f"_{k}": p for k, p in _PROBS.items()}, {"n": ("sum", F.lit(1).cast("bigint"))})
    return r.select("source", *[(F.floor(F.col(f"_{k}") + 0.5) / 100).alias(k) for k in _PROBS], F.col("n").cast("bigint").alias("n"))


@query("distinct_keys", SALARY_SQL + """SELECT DISTINCT 'date' AS kind, date_posted AS value FROM salary
  WHERE date_posted IS NOT NULL
UNION ALL SELECT DISTINCT 'company', company FROM salary WHERE company IS NOT NULL""")
def q_distinct_keys(spark, sf):
    """Distinct non-null dates and companies."""
    return md.distinct_salary(spark, sf, gold.distinct_values)


@query("median_by_country_ranked", o.fact_sql(f"""SELECT country_iso2 AS country, {o.avgc('avg_salary')} AS avg_salary,
  {o.pct2('avg_salary', 0.5)} AS median_salary, CAST(sum(job_count) AS BIGINT) AS job_count
  FROM fact WHERE skill = 'python' GROUP BY country_iso2"""))
def q_median_by_country_ranked(spark, sf):
    """One skill's cube on country, by median descending."""
    return ind.median_by_country_ranked(md.fact(spark, sf), "python")


@query("salary_cube_subtotals", o.fact_sql(f"""SELECT country_iso2 AS country, source,
  {o.avgc('avg_salary')} AS avg_salary, CAST(sum(job_count) AS BIGINT) AS job_count,
  CAST(GROUPING(country_iso2, source) AS INTEGER) AS grouping_id
  FROM fact GROUP BY CUBE (country_iso2, source)"""))
def q_salary_cube_subtotals(spark, sf):
    """Extension (not in the reference): CUBE with subtotals."""
    return ind.salary_cube_subtotals(md.fact(spark, sf), ["country", "source"])


# ------------------------------------------------------------------- G

@query("split_explode_skills", o.with_ctes(o.OBS) + """SELECT lower(sk) AS skill, CAST(count(*) AS BIGINT) AS rows
FROM (SELECT unnest([skill_label, skill2_label]) AS sk FROM obs WHERE src = 'so_survey') GROUP BY 1""")
def q_split_explode_skills(spark, sf):
    """G1 / C4: 'a;;+++;b' lists: empty parts dropped, labels normalised,
    null labels dropped, repeats kept."""
    s = adapter.survey_rows(md.observations(spark, sf))
    noisy = F.replace(F.col("LanguageHaveWorkedWith"), F.lit(";"), F.lit(";;+++;"))
    e = s.select(F.explode(split_skill_list(noisy)).alias("skill")).where(F.col("skill").isNotNull())
    return e.groupBy("skill").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


@query("paginate", o.fact_sql(f"""SELECT * FROM (SELECT country_iso2 AS country, skill, source, year,
  {o.avgc('avg_salary')} AS avg_salary, {o.pct2('avg_salary', 0.5)} AS median_salary,
  CAST(sum(job_count) AS BIGINT) AS job_count, CAST(count(*) OVER () AS BIGINT) AS total_count
  FROM factx GROUP BY country_iso2, skill, source, year) ORDER BY country, skill, source, year
  LIMIT 20 OFFSET 10""", extended=True))
def q_paginate(spark, sf):
    """Page 2 (offset 10, limit 20) of the cube, with the total count."""
    c = ind.salary_cube(md.fact(spark, sf), "country,skill,source,year")
    return ind.paginate(c, ["country", "skill", "source", "year"], limit=20, offset=10)


# ------------------------------------------------------------------- H

_SILVER_RULES_SQL = [
    ("source", "str_length(min=2)", "length(source) >= 2"),
    ("date_posted", "str_matches(date)", r"regexp_matches(date_posted, '^\d{4}-\d{2}-\d{2}$')"),
    ("country_iso2", "str_length(2,2)", "length(country_iso2) = 2"),
    ("skill", "str_length(min=1)", "length(skill) >= 1"),
    ("salary_eur", "in_range(1000,500000)", "salary_eur BETWEEN 1000 AND 500000"),
]
_FACT_RULES_SQL = [
    ("date_posted", "str_matches(date)", r"regexp_matches(date_posted, '^\d{4}-\d{2}-\d{2}$')"),
    ("country_iso2", "str_length(2,2)", "length(country_iso2) = 2"),
    ("skill", "str_length(min=1)", "length(skill) >= 1"),
    ("company", "str_length(min=1)", "length(company) >= 1"),
    ("source", "str_length(min=2)", "length(source) >= 2"),
    ("avg_salary", "in_range(1000,500000)", "avg_salary BETWEEN 1000 AND 500000"),
    ("min_salary", "in_range(1000,500000)", "min_salary BETWEEN 1000 AND 500000"),
    ("max_salary", "in_range(1000,500000)", "max_salary BETWEEN 1000 AND 500000"),
    ("job_count", "ge(1)", "job_count >= 1"),
    ("*", "min > avg", "min_salary <= avg_salary"),
    ("*", "avg > max", "avg_salary <= max_salary"),
]


def _counts_sql(rules, table: str, dataset: str | None) -> str:
    ds = f"{dataset} AS dataset, " if dataset else ""
    grp = f" GROUP BY {dataset}" if dataset else ""
    return "\nUNION ALL ".join(
        f"SELECT {ds}'{c}' AS \"column\", '{k}' AS \"check\", "
        f"CAST(count(*) FILTER (WHERE NOT coalesce({cond}, false)) AS BIGINT) AS failures FROM {table}{grp}"
        for c, k, cond in rules)


@query("dq_silver_salary", SILVER_SQL + _counts_sql(_SILVER_RULES_SQL, "silver", "source"))
def q_dq_silver_salary(spark, sf):
    """H1: failures per rule of the silver contract, per source, one pass each."""
    return quality.violation_counts(md.silver(spark, sf), quality.silver_salary_rules(), "source")


@query("dq_gold_fact", o.fact_sql(_counts_sql(_FACT_RULES_SQL, "fact", None)))
def q_dq_gold_fact(spark, sf):
    """H2: failures per rule of the fact contract (range, lengths, order)."""
    return quality.violation_counts(md.fact(spark, sf), quality.gold_fact_rules())


@query("dq_row_order", o.fact_sql("""SELECT * FROM (SELECT date_posted, country_iso2, skill, company, source, avg_salary,
  CASE WHEN skill = 'go' THEN avg_salary + 1 ELSE min_salary END AS min_salary,
  CASE WHEN source = 'indeed' AND skill = 'rust' THEN avg_salary - 1 ELSE max_salary END AS max_salary, job_count FROM fact)
  WHERE NOT (min_salary <= avg_salary AND avg_salary <= max_salary)"""))
def q_dq_row_order(spark, sf):
    """H3: fact rows breaking min <= avg <= max, on a copy with such faults."""
    skill, avg = F.col("skill"), F.col("avg_salary")
    f = md.fact(spark, sf)
    f = f.withColumn("min_salary", F.when(skill == "go", avg + 1).otherwise(F.col("min_salary"))) \
         .withColumn("max_salary", F.when((F.col("source") == "indeed") & (skill == "rust"), avg - 1).otherwise(F.col("max_salary")))
    return f.where(~((F.col("min_salary") <= avg) & (avg <= F.col("max_salary"))))


#: Columns of the raw records and their declared types, for each source.
_DECLARED = {
    "adzuna": {"title": "string", "company": "string", "location": "string", "salary_min": "double", "salary_max": "double",
               "category": "string", "country": "string", "created": "timestamp"},
    "indeed": {"Intitulé": "string", "Entreprise": "string", "Lieu": "string", "Salaire annoncé": "string", "Requête": "string",
               "Zone": "int", "Date": "date"},
    "glassdoor": {"Rôle": "string", "Ville": "string", "Pays": "string", "Niveau": "string", "skill": "string",
                  "salary_range": "string", "date_posted": "date"},
    "so_survey": {"Country": "string", "ConvertedCompYearly": "bigint", "LanguageHaveWorkedWith": "string"},
}
#: Conditions on the observations under which a raw value cannot be cast; any other column has none.
_UNCASTABLE = {
    ("adzuna", "created"): f"TRY_CAST(date_posted || '{adapter.STAMP}' AS TIMESTAMP) IS NULL",
    ("indeed", "Date"): "TRY_CAST(date_posted AS DATE) IS NULL",
    ("indeed", "Zone"): "TRY_CAST(country_name AS INTEGER) IS NULL",
    ("glassdoor", "date_posted"): "TRY_CAST(date_posted AS DATE) IS NULL",
    ("so_survey", "ConvertedCompYearly"): "l_orderkey % 50 IN (1, 2) AND (l_orderkey % 50 = 2 OR price >= 1000)",
}


@query("dq_coerce", o.with_ctes(o.OBS) + " UNION ALL ".join(
    f"""SELECT '{s}' AS source, '{c}' AS "column", '{t}' AS type,
  CAST(count(*) FILTER (WHERE src = '{s}' AND ({_UNCASTABLE.get((s, c), 'false')})) AS BIGINT) AS failures FROM obs"""
    for s, types in _DECLARED.items() for c, t in types.items()))
def q_dq_coerce(spark, sf):
    """H5: values present but not castable to the declared type, for every column of every source."""
    named = "struct<display_name: string>"
    offer = F.from_json(F.to_json(adapter.dump_record()), f"struct<title: string, company: {named}, location: {named}, salary_min: string, "
                        "salary_max: string, category: struct<tag: string>, country: string, created: string>")
    nested = {"company": "display_name", "location": "display_name", "category": "tag"}
    value = lambda s, c: F.col(f"_{s}")[c][nested[c]] if s == "adzuna" and c in nested else F.col(f"_{s}")[c]
    records = {"adzuna": offer, **{s: F.struct(*[fields[c].alias(c) for c in columns]) for s, (columns, fields) in adapter.csv_sources().items()}}
    # every observation as the record of its own source: one pass and one aggregation for all sources
    raw = md.observations(spark, sf).select(*[F.when(F.col("src") == s, r).alias(f"_{s}") for s, r in records.items()])
    flat = raw.select(*[value(s, c).alias(f"{s}/{c}") for s, types in _DECLARED.items() for c in types])
    counts = quality.coerce_failures(flat, {f"{s}/{c}": t for s, types in _DECLARED.items() for c, t in types.items()})
    return counts.select(F.split("column", "/")[0].alias("source"), F.split("column", "/")[1].alias("column"), "type", "failures")


_CASES_SQL = SILVER_SQL + """SELECT source AS dataset, 'salary_eur' AS "column", 'in_range(1000,500000)' AS "check",
  salary_eur AS failure_case FROM silver WHERE NOT coalesce(salary_eur BETWEEN 1000 AND 500000, false)"""


def _failure_cases(spark, sf) -> DataFrame:
    return quality.failure_cases(md.silver(spark, sf), quality.silver_salary_rules(), "source")


@query("dq_failure_cases", _CASES_SQL)
def q_dq_failure_cases(spark, sf):
    """H6: every failing (row, rule) as (dataset, column, check, failure_case)."""
    return _failure_cases(spark, sf).withColumn("failure_case", F.col("failure_case").cast("double"))


@query("top_failures", f"""SELECT * FROM ({_CASES_SQL}) ORDER BY dataset, "column", "check", failure_case LIMIT 10""")
def q_top_failures(spark, sf):
    """The first 10 failing cases in a total order (distributed top-k)."""
    cases = _failure_cases(spark, sf).withColumn("failure_case", F.col("failure_case").cast("double"))
    return quality.top_failures(cases, 10)


@query("dq_unique_grain", o.with_ctes(*o.UP_TO_FACT, o.REG, o.DIM_COMPANY, o.DIM_DATE) + f"""
SELECT 'fact_job' AS dataset, CAST(0 AS BIGINT) AS keys_twice
UNION ALL SELECT 'fact_job_replayed', CAST(count(*) AS BIGINT) FROM fact WHERE date_posted = '{REPLAY_DATE}'
UNION ALL SELECT 'dim_date', CAST(count(*) - count(DISTINCT date_key) AS BIGINT) FROM dim_date
UNION ALL SELECT 'dim_company', CAST(count(*) - count(DISTINCT company_name) AS BIGINT) FROM dim_company
UNION ALL SELECT 'silver', CAST(count(*) AS BIGINT) FROM (SELECT 1 FROM salary GROUP BY date_posted, country_iso2, skill, company, source HAVING count(*) > 1)""")
def q_dq_unique_grain(spark, sf):
    """H8: keys that occur more than once, in the fact, the same with a day loaded
    twice, the dimensions, and silver (which the fact collapses)."""
    rows = materialize(md.salary(spark, sf), "salary")  # parsed once, for silver's own keys and for the fact
    f = materialize(gold.build_fact(rows), "fact")
    dates, names = md.dims_from_fact(f)
    company = names.join(md.company_register(spark, sf), "company_name", "left")
    twice = lambda name, df, keys: quality.duplicate_keys(df, keys).agg(F.count(F.lit(1)).cast("bigint").alias("keys_twice")) \
        .select(F.lit(name).alias("dataset"), "keys_twice")
    return _union([twice("fact_job", f, config.FACT_GRAIN),
                   twice("fact_job_replayed", f.unionByName(f.where(F.col("date_posted") == REPLAY_DATE)), config.FACT_GRAIN),
                   twice("dim_date", dates, ["date_key"]), twice("dim_company", company, ["company_name"]),
                   twice("silver", rows, config.FACT_GRAIN)])


_FAULTY_FACT_SQL = """(SELECT id_fact, CASE WHEN id_skill = 1 THEN NULL ELSE date_key END AS date_key, CASE WHEN id_skill = 2 THEN NULL ELSE id_country END AS id_country,
  CASE WHEN id_skill = 3 THEN NULL ELSE id_company END AS id_company, id_skill, CASE WHEN id_skill = 4 THEN NULL ELSE id_source END AS id_source,
  avg_salary, CASE WHEN id_skill = 5 THEN max_salary + 1 ELSE min_salary END AS min_salary, max_salary,
  CASE WHEN id_skill = 6 THEN -job_count WHEN id_skill = 7 THEN NULL ELSE job_count END AS job_count FROM fact_job)"""


@query("dq_checks", o.star_sql("""SELECT '*' AS "column", 'ck_salary_order' AS "check",
  CAST(count(*) FILTER (WHERE NOT (min_salary IS NULL OR max_salary IS NULL OR min_salary <= max_salary)) AS BIGINT) AS failures FROM """ + _FAULTY_FACT_SQL + """
UNION ALL SELECT 'job_count', 'ck_job_count_positive', CAST(count(*) FILTER (WHERE NOT coalesce(job_count >= 0, false)) AS BIGINT) FROM """ + _FAULTY_FACT_SQL + "\n" + "\n".join(f"UNION ALL SELECT '{c}', 'not_null', CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) FROM {_FAULTY_FACT_SQL}"
               for c in ("date_key", "id_country", "id_company", "id_skill", "id_source", "job_count"))))
def q_dq_checks(spark, sf):
    """H9: the warehouse CHECK and NOT NULL constraints on a copy of fact_job with a fault of each kind."""
    skill = F.col("id_skill")
    f = md.star(spark, sf)["fact_job"]
    for k, c in ((1, "date_key"), (2, "id_country"), (3, "id_company"), (4, "id_source")):
        f = f.withColumn(c, F.when(~(skill == k), F.col(c)))
    f = f.withColumn("min_salary", F.when(skill == 5, F.col("max_salary") + 1).otherwise(F.col("min_salary"))) \
         .withColumn("job_count", F.when(skill == 6, -F.col("job_count")).when(~(skill == 7), F.col("job_count")))
    return quality.violation_counts(f, quality.warehouse_fact_rules())


@query("dq_freshness", """SELECT event_type, CAST(max(ts) AS VARCHAR) AS updated_at,
  floor(CAST(date_diff('microsecond', max(ts), (SELECT max(ts) FROM events)) AS DOUBLE) / 3.6e9 * 100 + 0.5) / 100 AS age_hours,
  floor(CAST(date_diff('microsecond', max(ts), (SELECT max(ts) FROM events)) AS DOUBLE) / 3.6e9 * 100 + 0.5) / 100 < 25 AS passed
FROM events GROUP BY event_type""")
def q_dq_freshness(spark, sf):
    """Hours since each event type's last update, against a fixed 'now' (the
    latest event); pass when under 25 h.  The newest event of each type is
    aggregated once; 'now' is the maximum of those few rows."""
    last = load(spark, sf, "events", "event_type", "ts").groupBy("event_type").agg(F.max("ts").alias("ts"))
    now = F.max("ts").over(Window.partitionBy())  # one row for each event type
    return quality.freshness(last.withColumn("_now", now), "event_type", "ts", "_now")


# ------------------------------------------------------------------- I

def _fact_without_batch(f: DataFrame) -> DataFrame:
    return f.where(F.col("date_posted") != BATCH_DATE)


def _batch_fact(f: DataFrame) -> DataFrame:
    return f.where(F.col("date_posted").isin(BATCH_DATE, REPLAY_DATE))


FULL_FACT_SQL = o.fact_sql("SELECT * FROM fact")


@query("upsert_fact", FULL_FACT_SQL)
def q_upsert_fact(spark, sf):
    """The batch day (new) and a replayed day upserted into the fact; inside
    the batch a stale copy (seq 0) loses to the fresh one (seq 1).  Equals the
    full refresh."""
    f = md.fact_once(spark, sf)
    b = _batch_fact(f)
    stale = b.withColumn("job_count", F.col("job_count") + 1000).withColumn("_seq", F.lit(0))
    fresh = b.withColumn("_seq", F.lit(1))
    return wh.upsert_fact(_fact_without_batch(f), stale.unionByName(fresh), config.FACT_GRAIN, "_seq")


@query("replay_idempotent", FULL_FACT_SQL)
def q_replay_idempotent(spark, sf):
    """I8: upserting the same batch twice leaves the result unchanged."""
    f = md.fact_once(spark, sf)
    once = wh.upsert_fact(_fact_without_batch(f), _batch_fact(f), config.FACT_GRAIN)
    return wh.upsert_fact(once, _batch_fact(f), config.FACT_GRAIN)


@query("micro_batch_day", FULL_FACT_SQL)
def q_micro_batch_day(spark, sf):
    """One day's silver rows -> batch fact -> upsert into the fact of the other days
    (``backfill_fact`` has the gates and the store)."""
    target, batch = (gold.build_fact(gold.salary_frame(md.silver_of_days(spark, sf, c))) for c in (lambda d: d != BATCH_DATE, lambda d: d == BATCH_DATE))
    return wh.upsert_fact(target, materialize(batch, "batch-day"), config.FACT_GRAIN)


@query("load_increment", o.with_ctes(*o.UP_TO_FACT, o.REG) + f"""
, f0 AS (SELECT * FROM fact WHERE date_posted <> '{BATCH_DATE}'), fb AS (SELECT * FROM fact WHERE date_posted = '{BATCH_DATE}'),
c0 AS (SELECT row_number() OVER (ORDER BY company) AS id, company FROM (SELECT DISTINCT company FROM f0)),
c1 AS (SELECT (SELECT max(id) FROM c0) + row_number() OVER (ORDER BY company) AS id, company
       FROM (SELECT DISTINCT company FROM fb WHERE company NOT IN (SELECT company FROM c0))),
c AS (SELECT * FROM c0 UNION ALL SELECT * FROM c1),
n AS (SELECT row_number() OVER (ORDER BY date_posted, country_iso2, skill, company, source) AS id_fact, * FROM f0
      UNION ALL SELECT (SELECT count(*) FROM f0) + row_number() OVER (ORDER BY date_posted, country_iso2, skill, company, source), * FROM fb)
SELECT CAST(id_fact AS BIGINT) AS id_fact, date_posted AS date_key, CAST(list_position({o.ISO2_LIST}, country_iso2) AS INTEGER) AS id_country,
  CAST(c.id AS INTEGER) AS id_company, CAST(list_position({o.SKILL_LIST}, skill) AS INTEGER) AS id_skill,
  CAST(list_position({o.SOURCE_LIST}, source) AS INTEGER) AS id_source, avg_salary, min_salary, max_salary, job_count
FROM n JOIN c ON c.company = n.company""")
def q_load_increment(spark, sf):
    """A warehouse loaded without the batch day, then that day as an increment,
    part of it loaded before: old ids stay, new keys count on from the largest."""
    f = md.fact_once(spark, sf)
    base, batch = _fact_without_batch(f), f.where(F.col("date_posted") == BATCH_DATE)
    star = md.star_of(spark, sf, base)
    again = batch.unionByName(base.where(F.col("date_posted") == REPLAY_DATE))  # known facts: measures overwritten by the same
    companies = again.select(F.col("company").alias("company_name"), F.lit(None).cast("string").alias("workforce_size"), F.lit(None).cast("string").alias("sector"))
    return wh.increment_star(star, again, companies)["fact_job"]


_UPSERT_COMPANY_SQL = o.with_ctes(*o.UP_TO_FACT, o.REG, o.DIM_COMPANY) + f"""SELECT * FROM dim_company
  WHERE company_name NOT IN (SELECT company FROM salary WHERE date_posted = '{BATCH_DATE}')
UNION ALL SELECT DISTINCT company, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM salary
  WHERE date_posted = '{BATCH_DATE}'"""


@query("upsert_update", _UPSERT_COMPANY_SQL)
def q_upsert_update(spark, sf):
    """Company increment upserted into the company dimension; known
    companies lose their attributes (overwritten by null, as the reference does)."""
    inc = q_dim_company_increment(spark, sf)
    return wh.upsert_update(md.dim_company(spark, sf), inc, ["company_name"])


@query("upsert_ignore", o.with_ctes(*o.UP_TO_FACT, o.DIM_DATE) + "SELECT * FROM dim_date")
def q_upsert_ignore(spark, sf):
    """Batch dates inserted only when absent (replayed day ignored)."""
    d = materialize(md.dim_date(spark, sf), "dim-date")  # both sides are taken from it
    target = d.where(F.col("date_key") != BATCH_DATE)
    batch = d.where(F.col("date_key").isin(BATCH_DATE, REPLAY_DATE))
    return wh.upsert_ignore(target, batch, ["date_key"])


@query("watermark_state", SALARY_SQL + f"""SELECT step, batch_date, batch_date AS watermark_parity,
  max(batch_date) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS watermark_greatest,
  CAST(CAST(batch_date AS DATE) + INTERVAL 1 DAY AS DATE)::VARCHAR AS next_batch
FROM (SELECT CAST(row_number() OVER (ORDER BY date_posted) AS BIGINT) AS step, date_posted AS batch_date
      FROM (SELECT DISTINCT date_posted FROM salary WHERE date_posted <> '{config.AS_OF_DATE}')
      UNION ALL SELECT CAST(count(DISTINCT date_posted) + 1 AS BIGINT), '{REPLAY_DATE}' FROM salary
      WHERE date_posted <> '{config.AS_OF_DATE}')""")
def q_watermark_state(spark, sf):
    """Watermark after each daily run (in date order, then a backfill of
    an older day): parity mode moves back, greatest mode does not."""
    dates = md.distinct_salary(spark, sf, gold.distinct_dates).where(F.col("date_posted") != config.AS_OF_DATE)
    dates = materialize(dates, "days")  # read for the steps and for their number
    runs = global_index(dates, [F.col("date_posted")], "step").select("step", F.col("date_posted").alias("batch_date"))
    backfill = dates.agg((F.count(F.lit(1)) + 1).cast("bigint").alias("step")) \
                    .select("step", F.lit(REPLAY_DATE).alias("batch_date"))
    runs = runs.unionByName(backfill)
    parity = mb.watermark_steps(runs, "step", "batch_date", "parity")
    greatest = mb.watermark_steps(runs, "step", "batch_date", "greatest").select(
        F.col("step").alias("_s"), F.col("watermark").alias("watermark_greatest"))
    return (parity.join(greatest, parity["step"] == greatest["_s"])
            .select("step", "batch_date", F.col("watermark").alias("watermark_parity"), "watermark_greatest",
                    F.date_add(F.to_date("batch_date"), 1).cast("string").alias("next_batch")))


@query("stream_daily_events", """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type,
  CAST(count(*) AS BIGINT) AS events, CAST(sum(CAST(floor(value*100+0.5) AS BIGINT)) AS BIGINT) AS value_cents
FROM events GROUP BY 1, 2""")
def q_stream_daily_events(spark, sf):
    """I10 / 2.J: events read as a file stream (availableNow), event-time daily
    windows per type with a watermark, run to completion."""
    schema = load(spark, sf, "events").schema
    stream = mb.read_stream(spark, sf, schema, "events.parquet")
    agg = mb.daily_event_counts(stream, "ts", "event_type", "value")
    out = mb.run_available_now(spark, agg, ["window", "event_type"], fresh_path(spark, "daily-events"))
    day = F.date_from_unix_date(F.floor(F.unix_micros(F.col("window.start")) / F.lit(86_400_000_000)).cast("int"))
    return out.select(day.cast("string").alias("day"), "event_type", F.col("events").cast("bigint"),
                      F.col("value_cents").cast("bigint"))


# ------------------------------------------------------------------- K

def _manifest(spark, sf) -> DataFrame:
    """K1: the manifest that a run has written, with observed row counts and stored bytes."""
    root = fresh_path(spark, "run")
    run_layers(spark, sf, root)
    return spark.read.parquet(f"{root}/manifest")


_BAND_CTES = (o.OBS, o.SILVER_RAW, o.SILVER, f"band AS (SELECT * FROM silver WHERE salary_eur BETWEEN {config.EUR_MIN} AND {config.EUR_MAX})",
              o.SALARY.replace("FROM silver", "FROM band"), o.FACT)
_MANIFEST_SQL = o.with_ctes(*_BAND_CTES, o.REG, o.DIM_COMPANY, o.DIM_DATE) + f"""
, m AS (
  SELECT 'bronze' AS layer, src AS dataset, CAST(count(*) AS BIGINT) AS rows FROM obs GROUP BY src
  UNION ALL SELECT 'bronze', 'github_trending', CAST(count(*) AS BIGINT) FROM part
  UNION ALL SELECT 'bronze', 'google_trends', CAST(count(DISTINCT (date_posted, iso2)) AS BIGINT) FROM obs
  UNION ALL SELECT 'bronze', 'reference', CAST(count(*) AS BIGINT) FROM supplier
  UNION ALL SELECT 'silver', source, CAST(count(*) AS BIGINT) FROM band GROUP BY source
  UNION ALL SELECT 'silver', 'github_popularity', CAST(count(*) AS BIGINT) FROM part
  UNION ALL SELECT 'silver', 'google_trends', CAST(count(DISTINCT (date_posted, skill_label, iso2)) AS BIGINT) FROM obs
  UNION ALL SELECT 'gold', 'fact_job', CAST(count(*) AS BIGINT) FROM fact
  UNION ALL SELECT 'gold', 'dim_date', CAST(count(*) AS BIGINT) FROM dim_date
  UNION ALL SELECT 'gold', 'dim_company', CAST(count(*) AS BIGINT) FROM dim_company
  UNION ALL SELECT 'gold', 'dim_country', CAST({len(config.COUNTRIES)} AS BIGINT)
  UNION ALL SELECT 'gold', 'dim_skill', CAST({len(config.SKILLS)} AS BIGINT)
  UNION ALL SELECT 'gold', 'dim_source', CAST({len(config.ALL_SOURCES)} AS BIGINT)
  UNION ALL SELECT 'gold', 'skill_popularity', CAST(count(DISTINCT k) AS BIGINT) FROM (
    SELECT lower(skill_label) AS k FROM obs
    UNION ALL SELECT CASE WHEN p_partkey % 13 <> 0 THEN lower(({o.lst(adapter.SKILL_DISPLAY)})[p_partkey % 12 + 1]) END FROM part))
"""


@query("layer_totals", _MANIFEST_SQL + """SELECT layer, CAST(count(*) AS BIGINT) AS datasets,
  CAST(sum(coalesce(rows, 0)) AS BIGINT) AS rows FROM m GROUP BY layer""")
def q_layer_totals(spark, sf):
    """Datasets and rows per layer."""
    return lake.layer_totals(_manifest(spark, sf))


@query("manifest_report", _MANIFEST_SQL + """SELECT m.layer, t.datasets, t.layer_rows, m.dataset, m.rows,
  true AS stored, 'parquet' AS format
FROM m JOIN (SELECT layer, CAST(count(*) AS BIGINT) AS datasets, CAST(sum(coalesce(rows, 0)) AS BIGINT) AS layer_rows
             FROM m GROUP BY layer) t ON m.layer = t.layer ORDER BY m.layer, m.dataset""")
def q_manifest_report(spark, sf):
    """K1 + K2: the written manifest, upserted once more on (layer, dataset) (a re-run
    must not duplicate datasets), reported per layer then dataset; ``stored``: the
    file system holds bytes for it."""
    m = _manifest(spark, sf)
    m = wh.upsert_update(m.limit(5), m, ["layer", "dataset"])
    return lake.manifest_report(m).withColumn("stored", F.col("kb") > 0).drop("kb")


@query("retention_plan", f"""SELECT layer, tier, CAST(count(*) AS BIGINT) AS objects FROM (
  SELECT ({o.lst(['bronze', 'silver', 'gold'])})[o_orderkey % 3 + 1] AS layer,
         date_diff('day', CAST(o_orderdate AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS age
  FROM orders) x,
  LATERAL (SELECT CASE
    WHEN layer = 'bronze' THEN CASE WHEN age >= 90 THEN 'expired' WHEN age >= 30 THEN 'cold' ELSE 'hot' END
    WHEN layer = 'silver' THEN CASE WHEN age >= 30 THEN 'cold' ELSE 'hot' END
    ELSE CASE WHEN age >= 90 THEN 'cold' ELSE 'hot' END END AS tier)
GROUP BY layer, tier""")
def q_retention_plan(spark, sf):
    """K4: storage tier of stored objects at 'now' (the latest write): bronze
    cold at 30 d and expired at 90 d, silver cold at 30 d, gold cold at 90 d."""
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderdate")
    objs = orders.select(adapter.pick(["bronze", "silver", "gold"], F.col("o_orderkey") % 3).alias("layer"),
                         F.to_date("o_orderdate").alias("written"))
    # counted by layer and day first; 'now' is the maximum over those few rows
    days = objs.groupBy("layer", "written").agg(F.count(F.lit(1)).alias("n"))
    plan = lake.retention_plan(days.withColumn("_now", F.max("written").over(Window.partitionBy())), "layer", "written", F.col("_now"))
    return plan.groupBy("layer", "tier").agg(F.sum("n").cast("bigint").alias("objects"))


# ------------------------------------------------------------ stored runs

_INSIDE = f"salary_eur BETWEEN {config.EUR_MIN} AND {config.EUR_MAX}"
#: Rows outside the salary band are put aside, but in March they stay and their days are refused.
_RUN_CTES = (o.OBS, o.SILVER_RAW, o.SILVER, f"""run AS (SELECT * FROM silver WHERE {_INSIDE} OR substr(date_posted, 6, 2) = '03'),
refused AS (SELECT DISTINCT date_posted FROM run WHERE NOT ({_INSIDE})),
good AS (SELECT * FROM run WHERE date_posted NOT IN (SELECT date_posted FROM refused))""", o.SALARY.replace("FROM silver", "FROM good"), o.FACT)


def _stored_run(spark, sf) -> str:
    """All days of silver in one run, then one of them again as a backfill; returns the store's folder."""
    root = fresh_path(spark, "days")
    inside = F.col("salary_eur").between(config.EUR_MIN, config.EUR_MAX)
    silver = md.silver_by_day(spark, sf).where(inside | (F.substring("date_posted", 6, 2) == "03"))
    mb.run_days(spark, root, silver)
    mb.run_days(spark, root, silver, [REPLAY_DATE])
    return root


@query("backfill_fact", o.with_ctes(*_RUN_CTES) + "SELECT * FROM fact")
def q_backfill_fact(spark, sf):
    """Every day gated, staged and upserted into the stored fact in one run, one day replayed; days
    that break the contract are refused whole."""
    return mb.read_fact(spark, _stored_run(spark, sf)).select(*config.FACT_GRAIN, "avg_salary", "min_salary", "max_salary", "job_count")


@query("watermark_log", o.with_ctes(*_RUN_CTES) + f"""SELECT number, day, day AS watermark_parity,
  max(day) OVER (ORDER BY number) AS watermark_greatest FROM (
    SELECT CAST(row_number() OVER (ORDER BY date_posted) AS INTEGER) AS number, date_posted AS day FROM (SELECT DISTINCT date_posted FROM good)
    UNION ALL SELECT CAST(count(DISTINCT date_posted) + 1 AS INTEGER), '{REPLAY_DATE}' FROM good)""")
def q_watermark_log(spark, sf):
    """The stored log of processed days: refused days are not in it, a backfill adds an entry; after each entry
    the watermark in both modes.  The log has an entry a day, so one ordered window over it is small."""
    log = storage.entries(spark, f"{_stored_run(spark, sf)}/watermark").withColumnRenamed("value", "day")
    greatest = F.max("day").over(Window.orderBy("number"))
    return log.select("number", "day", F.col("day").alias("watermark_parity"), greatest.alias("watermark_greatest"))


@query("stream_hot_indicators", o.with_ctes(*_BAND_CTES) + _HOT_ITEMS_SQL)
def q_stream_hot_indicators(spark, sf):
    """Silver delivered as files in two drops to one checkpoint; the first holds a stale copy of a day that
    the second replays.  The published items equal those of the whole fact."""
    root, drops, checkpoint = (fresh_path(spark, f"stream-{n}") for n in ("store", "drops", "checkpoint"))
    inside, _ = split_band(md.silver_by_day(spark, sf))
    stale = F.when(F.col("date_posted") == REPLAY_DATE, F.lit(1.0)).otherwise(F.lit(0.0))
    late = F.col("date_posted").isin(BATCH_DATE, REPLAY_DATE)
    first = inside.where(F.col("date_posted") != BATCH_DATE).select(*[(F.col(c) + stale if c.endswith("_eur") else F.col(c)).alias(c) for c in inside.columns])
    for rows in (first, inside.where(late)):
        rows.write.mode("append").parquet(drops)
        mb.stream_offers(spark, spark.readStream.schema(inside.schema).parquet(drops), root, checkpoint)
    return mb.read_hot_items(spark, root)


@query("loaded_star", o.with_ctes(*_BAND_CTES) + """SELECT date_posted, country_iso2, skill, company, source,
  CAST(year(CAST(date_posted AS DATE)) AS INTEGER) AS year, CAST(month(CAST(date_posted AS DATE)) AS INTEGER) AS month,
  avg_salary, min_salary, max_salary, job_count FROM fact""")
def q_loaded_star(spark, sf):
    """A run's gold layer loaded as a snapshot of six tables twice, and the current snapshot read back to natural keys."""
    root = fresh_path(spark, "run")
    run_layers(spark, sf, root)
    for _ in range(2):  # the second refresh replaces the first by one entry
        load_star(spark, root)
    t = {n: wh.read_table(spark, f"{root}/warehouse", n) for n in ("fact_job", "d_country", "d_company", "d_skill", "d_source", "d_date")}
    return wh.star_natural(t["fact_job"], t["d_country"], t["d_company"], t["d_skill"], t["d_source"], t["d_date"])


@query("external_table", o.with_ctes(*_RUN_CTES) + f"""SELECT country_iso2, source, CAST(count(*) AS BIGINT) AS facts,
  CAST(sum(job_count) AS BIGINT) AS jobs FROM fact WHERE date_posted >= '{REPLAY_DATE}' GROUP BY ALL""")
def q_external_table(spark, sf):
    """The stored fact as a SQL table with a partition for each day and statistics, asked in SQL for the days from one on."""
    name = f"fact_job_{uuid.uuid4().hex[:12]}"
    register_external_table(spark, name, f"{_stored_run(spark, sf)}/fact", ["date_posted"])
    return spark.sql(f"""SELECT country_iso2, source, count(*) AS facts, CAST(sum(job_count) AS BIGINT) AS jobs
        FROM {name} WHERE date_posted >= '{REPLAY_DATE}' GROUP BY country_iso2, source""")


@query("pipeline_metrics", _MANIFEST_SQL + f""", s AS (SELECT layer, count(*) AS datasets, sum(coalesce(rows, 0)) AS rows FROM m GROUP BY layer),
d AS (SELECT layer, dataset, rows FROM m WHERE layer = 'gold' AND dataset LIKE 'dim_%'),
r AS (SELECT layer, dataset, rows FROM m WHERE layer = 'gold' AND dataset IN ('fact_job', 'dim_date', 'dim_company')),
w AS (SELECT 'd_' || substr(dataset, 5) AS dim, CAST(rows AS BIGINT) AS size FROM d)
SELECT 'bronze' AS stage, CAST(datasets AS INTEGER) AS datasets, CAST(NULL AS BIGINT) AS rows_in, CAST(rows AS BIGINT) AS rows,
  CAST(NULL AS VARCHAR) AS dim, CAST(NULL AS BIGINT) AS size FROM s WHERE layer = 'bronze'
UNION ALL SELECT 'silver', CAST(datasets AS INTEGER), CAST((SELECT sum(rows) FROM m WHERE layer = 'bronze' AND dataset <> 'reference') AS BIGINT),
  CAST(rows AS BIGINT), NULL, NULL FROM s WHERE layer = 'silver'
UNION ALL SELECT 'gold', CAST(datasets AS INTEGER), CAST((SELECT sum(rows) FROM m WHERE layer = 'silver') AS BIGINT), CAST(s.rows AS BIGINT), d.dataset,
  CAST(d.rows AS BIGINT) FROM s, d WHERE s.layer = 'gold'
UNION ALL SELECT 'warehouse', 6, CAST((SELECT sum(rows) FROM r) AS BIGINT),
  CAST((SELECT sum(size) FROM w) + (SELECT rows FROM r WHERE dataset = 'fact_job') AS BIGINT), dim, size FROM w""")
def q_pipeline_metrics(spark, sf):
    """K3: rows read and written, datasets and sizes of the dimensions of each stage of a run (its seconds left out)."""
    m = run_all(spark, sf, fresh_path(spark, "run"))
    return m.select("stage", "datasets", "rows_in", "rows", F.explode_outer("dims").alias("dim", "size"))
