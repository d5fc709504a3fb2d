"""DuckDB oracle SQL for the registered queries.

The oracle derives expected values directly from the numbers of the driver
tables (it never parses the rendered salary texts), so it checks our parsers
rather than repeating them.  Rounding and averages follow the engine-neutral
rules of ``functions.money`` (half-up cents, integer-cent sums).
"""

from __future__ import annotations

from .. import config
from ..sources import adapter


def r2(x: str) -> str:
    return f"(floor(({x})*100+0.5)/100)"


def r1(x: str) -> str:
    return f"(floor(({x})*10+0.5)/10)"


def avgc(x: str, n: str | None = None) -> str:
    n = n or f"count({x})"
    return f"(floor(cast(sum(cast(floor(({x})*100+0.5) as bigint)) as double)/{n}+0.5)/100)"


def lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def d(x) -> str:
    return f"CAST({x} AS DOUBLE)"


RATE_SQL = ("CASE iso2 WHEN 'GB' THEN CAST(1.17 AS DOUBLE) WHEN 'US' THEN CAST(0.92 AS DOUBLE) "
            "WHEN 'CA' THEN CAST(0.92 AS DOUBLE) WHEN 'AU' THEN CAST(0.92 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END")

OBS = f"""obs AS (
  SELECT l_orderkey, l_linenumber,
    ({lst(config.SALARY_SOURCES)})[l_linenumber % 4 + 1] AS src,
    CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS date_posted,
    ({lst(adapter.ISO2)})[n_nationkey % 9 + 1] AS iso2,
    ({lst(adapter.NAMES)})[n_nationkey % 9 + 1] AS country_name,
    ({lst(adapter.SKILL_DISPLAY)})[p_partkey % 12 + 1] AS skill_label,
    ({lst(adapter.SKILL_DISPLAY)})[p_size % 12 + 1] AS skill2_label,
    s_name, l_extendedprice AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey)"""

SILVER_ADZUNA = f"""SELECT 'adzuna' AS source, date_posted, iso2 AS country_iso2, lower(skill_label) AS skill,
         s_name AS company,
         {r2(f"({r2('price*' + d(adapter.LOW))} + {r2('price*' + d(adapter.HIGH))})/2")} AS salary_eur,
         {r2('price*' + d(adapter.LOW))} AS min_salary_eur, {r2('price*' + d(adapter.HIGH))} AS max_salary_eur
  FROM obs WHERE src = 'adzuna'"""

SILVER_INDEED = f"""SELECT 'indeed' AS source, date_posted, iso2 AS country_iso2, lower(skill_label) AS skill,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE s_name END AS company,
         {r2(f"floor(price/1000)*1000*{RATE_SQL}")} AS salary_eur,
         CAST(NULL AS DOUBLE) AS min_salary_eur, CAST(NULL AS DOUBLE) AS max_salary_eur
  FROM obs WHERE src = 'indeed'"""

SILVER_GLASSDOOR = f"""SELECT 'glassdoor' AS source, date_posted, iso2 AS country_iso2, lower(skill_label) AS skill,
         CAST(NULL AS VARCHAR) AS company, {r2('(lo+hi)/2')} AS salary_eur, lo AS min_salary_eur, hi AS max_salary_eur
  FROM (SELECT *, floor(price*{d(adapter.LOW)}/1000)*1000 AS lo, floor(price*{d(adapter.HIGH)}/1000)*1000 AS hi
        FROM obs WHERE src = 'glassdoor')"""

SILVER_SURVEY = f"""SELECT 'so_survey' AS source, '{config.AS_OF_DATE}' AS date_posted, iso2 AS country_iso2,
         lower(sk) AS skill, CAST(NULL AS VARCHAR) AS company,
         CASE WHEN l_orderkey % 50 <> 2 THEN {r2(f"CAST(CAST(floor(price) AS BIGINT) AS DOUBLE)*{d(0.92)}")} END AS salary_eur,
         CAST(NULL AS DOUBLE) AS min_salary_eur, CAST(NULL AS DOUBLE) AS max_salary_eur
  FROM (SELECT *, unnest([skill_label, skill2_label]) AS sk FROM obs WHERE src = 'so_survey')"""

SILVER_RAW = f"""silver_raw AS (
  {SILVER_ADZUNA}
  UNION ALL {SILVER_INDEED}
  UNION ALL {SILVER_GLASSDOOR}
  UNION ALL {SILVER_SURVEY})"""

SILVER = """silver AS (SELECT * FROM silver_raw
  WHERE country_iso2 IS NOT NULL AND skill IS NOT NULL AND salary_eur IS NOT NULL AND salary_eur > 0)"""

SALARY = f"""salary AS (SELECT source, date_posted, country_iso2, skill,
  coalesce(nullif(company, ''), '{config.UNKNOWN_COMPANY}') AS company, salary_eur, min_salary_eur, max_salary_eur
  FROM silver)"""

FACT = f"""fact AS (
  SELECT date_posted, country_iso2, skill, company, source,
         {avgc('salary_eur')} AS avg_salary, {r2('min(salary_eur)')} AS min_salary,
         {r2('max(salary_eur)')} AS max_salary, CAST(count(*) AS BIGINT) AS job_count
  FROM salary GROUP BY date_posted, country_iso2, skill, company, source)"""

FACTX = """factx AS (SELECT *, CAST(year(CAST(date_posted AS DATE)) AS INTEGER) AS year,
  CAST(month(CAST(date_posted AS DATE)) AS INTEGER) AS month FROM fact)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


UP_TO_FACT = (OBS, SILVER_RAW, SILVER, SALARY, FACT)


def fact_sql(body: str, extended: bool = False) -> str:
    ctes = UP_TO_FACT + ((FACTX,) if extended else ())
    return with_ctes(*ctes) + body


def pct2(x: str, p: float) -> str:
    """Percentile to cents, interpolated between whole cents: half a cent is exact then."""
    return f"(floor(quantile_cont(CAST(floor({x}*100+0.5) AS DOUBLE), {p})+0.5)/100)"


REG = f"""reg AS (SELECT s_name AS company_name,
  ({lst(config.WORKFORCE_SIZES)})[s_suppkey % 5 + 1] AS workforce_size,
  ({lst(config.SECTORS)})[s_suppkey % 7 + 1] AS sector FROM supplier)"""

DIM_COMPANY = """dim_company AS (SELECT c.company_name, reg.workforce_size, reg.sector
  FROM (SELECT DISTINCT company AS company_name FROM salary WHERE company IS NOT NULL) c
  LEFT JOIN reg ON c.company_name = reg.company_name)"""

D_COMPANY = """d_company AS (SELECT CAST(row_number() OVER (ORDER BY company_name, workforce_size, sector) AS INTEGER)
  AS id_company, company_name, workforce_size, sector FROM dim_company)"""

DIM_DATE = """dim_date AS (SELECT date_posted AS date_key,
  CAST(dayofmonth(CAST(date_posted AS DATE)) AS INTEGER) AS day, CAST(month(CAST(date_posted AS DATE)) AS INTEGER) AS month,
  CAST(quarter(CAST(date_posted AS DATE)) AS INTEGER) AS quarter, CAST(year(CAST(date_posted AS DATE)) AS INTEGER) AS year,
  CAST(isodow(CAST(date_posted AS DATE)) - 1 AS INTEGER) AS day_week
  FROM (SELECT DISTINCT date_posted FROM salary WHERE date_posted IS NOT NULL))"""

ISO2_LIST = lst([c[0] for c in config.COUNTRIES])
SKILL_LIST = lst([s[0] for s in config.SKILLS])
SOURCE_LIST = lst(config.ALL_SOURCES)

FACT_JOB = f"""fact_job AS (SELECT CAST(row_number() OVER (ORDER BY date_posted NULLS FIRST, country_iso2 NULLS FIRST,
    skill NULLS FIRST, company NULLS FIRST, source NULLS FIRST) AS BIGINT) AS id_fact,
  date_posted AS date_key, CAST(nullif(list_position({ISO2_LIST}, country_iso2), 0) AS INTEGER) AS id_country,
  d_company.id_company, CAST(nullif(list_position({SKILL_LIST}, skill), 0) AS INTEGER) AS id_skill,
  CAST(nullif(list_position({SOURCE_LIST}, source), 0) AS INTEGER) AS id_source,
  avg_salary, min_salary, max_salary, job_count
  FROM fact LEFT JOIN d_company ON fact.company = d_company.company_name)"""

STAR = UP_TO_FACT + (REG, DIM_COMPANY, D_COMPANY, DIM_DATE, FACT_JOB)


def star_sql(body: str) -> str:
    return with_ctes(*STAR) + body
