"""Registered queries: one per operator of the inventory, with its oracle SQL.

``QUERIES[key] = fn(spark, sf_dir) -> DataFrame``; ``ORACLE[key]`` is the
DuckDB SQL over the driver tables that must give the same rows.  Queries
without an oracle are checked rows-only (and by unit tests).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import indicators as ind
from . import medallion as md
from . import oracle as o

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str | Callable[[], str]] = {}  # a function where the SQL needs the running JVM's tables


def query(key: str, sql: str | Callable[[], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# ------------------------------------------------------------------ E1 fact

@query("build_fact", o.fact_sql("SELECT * FROM fact"))
def q_build_fact(spark, sf):
    return md.fact(spark, sf)


# ----------------------------------------------------------- E5 stats

def _stats_sql(where: str = "") -> str:
    return o.fact_sql(f"""SELECT {o.pct2('avg_salary', 0.5)} AS median, {o.pct2('avg_salary', 0.25)} AS p25,
  {o.pct2('avg_salary', 0.75)} AS p75, {o.avgc('avg_salary')} AS avg,
  CAST(count(*) AS BIGINT) AS sample_size FROM fact {where}""")


@query("salary_stats", _stats_sql())
def q_salary_stats(spark, sf):
    return ind.salary_stats(md.fact(spark, sf))


@query("salary_stats_fr_python", _stats_sql("WHERE country_iso2 = 'FR' AND skill = 'python'"))
def q_salary_stats_fr_python(spark, sf):
    return ind.salary_stats(md.fact(spark, sf), country="fr", skill="Python")


@query("salary_stats_empty", _stats_sql("WHERE country_iso2 = 'ZZ'"))
def q_salary_stats_empty(spark, sf):
    return ind.salary_stats(md.fact(spark, sf), country="zz")


# ----------------------------------------------------------- E6 daily

def _daily_sql(where: str = "") -> str:
    return o.fact_sql(f"""SELECT date_posted AS date, {o.avgc('avg_salary')} AS avg_salary,
  CAST(sum(job_count) AS BIGINT) AS job_count FROM fact {where} GROUP BY date_posted ORDER BY date_posted""")


@query("salary_daily", _daily_sql())
def q_salary_daily(spark, sf):
    return ind.salary_daily(md.fact(spark, sf))


@query("salary_daily_us", _daily_sql("WHERE country_iso2 = 'US'"))
def q_salary_daily_us(spark, sf):
    return ind.salary_daily(md.fact(spark, sf), country="us")


# ----------------------------------------------------------- E7 cube

_DIMCOL = {"country": "country_iso2", "skill": "skill", "source": "source", "year": "year", "month": "month"}


def _cube_sql(dims: list[str], where: str = "") -> str:
    sel = ", ".join(f"{_DIMCOL[x]} AS {x}" for x in dims)
    grp = ", ".join(_DIMCOL[x] for x in dims)
    return o.fact_sql(f"""SELECT {sel}, {o.avgc('avg_salary')} AS avg_salary,
  {o.pct2('avg_salary', 0.5)} AS median_salary, CAST(sum(job_count) AS BIGINT) AS job_count
  FROM factx {where} GROUP BY {grp} ORDER BY {grp}""", extended=True)


@query("salary_cube_cs", _cube_sql(["country", "skill"]))
def q_cube_cs(spark, sf):
    return ind.salary_cube(md.fact(spark, sf), "country,skill")


@query("salary_cube_cssy", _cube_sql(["country", "skill", "source", "year"]))
def q_cube_cssy(spark, sf):
    return ind.salary_cube(md.fact(spark, sf), "country,skill,source,year")


@query("salary_cube_month", _cube_sql(["month"]))
def q_cube_month(spark, sf):
    return ind.salary_cube(md.fact(spark, sf), "month")


@query("salary_cube_default", _cube_sql(["country", "skill"]))
def q_cube_default(spark, sf):
    return ind.salary_cube(md.fact(spark, sf), "region, nonsense")


@query("salary_cube_repeats", _cube_sql(["skill", "source"], "WHERE source = 'indeed'"))
def q_cube_repeats(spark, sf):
    return ind.salary_cube(md.fact(spark, sf), "skill, skill,source, bogus,source", source="INDEED")


# ----------------------------------------------------------- E8 hot indicators

_HOT_SQL = f"""SELECT country_iso2, skill, {o.pct2('avg_salary', 0.5)} AS median,
  {o.avgc('avg_salary')} AS avg, CAST(sum(job_count) AS BIGINT) AS volume
  FROM fact WHERE country_iso2 IS NOT NULL AND skill IS NOT NULL GROUP BY country_iso2, skill"""


@query("hot_indicators", o.fact_sql(_HOT_SQL))
def q_hot_indicators(spark, sf):
    return ind.hot_indicators(md.fact(spark, sf))


# ----------------------------------------------------------- E14 latency

_LAT_SQL = """WITH r AS (
  SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS k,
         count(*) OVER (PARTITION BY event_type) AS n,
         sum(CAST(floor(value*100+0.5) AS BIGINT)) OVER (PARTITION BY event_type) AS sc,
         max(value) OVER (PARTITION BY event_type) AS mx
  FROM events WHERE value IS NOT NULL)
SELECT event_type, CAST(n AS BIGINT) AS n,
  {p50} AS p50, {p95} AS p95, {p99} AS p99,
  floor(CAST(sc AS DOUBLE)/n/10+0.5)/10 AS mean, floor(mx*10+0.5)/10 AS max
FROM r GROUP BY event_type, n, sc, mx"""


def _nearest(p: float) -> str:
    k = f"least(greatest(floor({p}*(n-1)+0.5), 0), n-1)"
    return f"floor(max(CASE WHEN k = {k} THEN value END)*10+0.5)/10"


@query("latency_summary", _LAT_SQL.format(p50=_nearest(0.5), p95=_nearest(0.95), p99=_nearest(0.99)))
def q_latency_summary(spark, sf):
    from ..sources.tables import load
    return ind.latency_summary(load(spark, sf, "events", "event_type", "value"), "event_type", "value")


# The other query groups register themselves on import.
from . import catalog_sources  # noqa: E402,F401
from . import catalog_gold  # noqa: E402,F401
