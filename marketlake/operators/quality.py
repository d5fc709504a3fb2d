"""Data-quality contracts.

A contract is a list of named row rules.  All rules of a dataset are checked
in ONE aggregation (``count_if`` per rule, partial-aggregated map-side), not
one job per rule; failing cases come from one explode of the violated-rule
array.  The gate is the only action, and only counts reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config

DATE_RE = r"^\d{4}-\d{2}-\d{2}$"


class DataQualityError(RuntimeError):
    """A dataset violates its contract."""


@dataclass(frozen=True)
class Rule:
    column: str
    check: str
    ok: Column          # true when the row passes; null counts as a failure


def _len_ge(c: str, n: int) -> Column:
    return F.length(F.col(c)) >= n


def _in_range(c: str) -> Column:
    return F.col(c).between(config.EUR_MIN, config.EUR_MAX)


def silver_salary_rules() -> list[Rule]:
    """H1: the silver salary contract (company/min/max nullable)."""
    return [
        Rule("source", "str_length(min=2)", _len_ge("source", 2)),
        Rule("date_posted", "str_matches(date)", F.col("date_posted").rlike(DATE_RE)),
        Rule("country_iso2", "str_length(2,2)", F.length("country_iso2") == 2),
        Rule("skill", "str_length(min=1)", _len_ge("skill", 1)),
        Rule("salary_eur", "in_range(1000,500000)", _in_range("salary_eur")),
    ]


def gold_fact_rules() -> list[Rule]:
    """H2 + H3: the fact contract, row order min <= avg <= max included."""
    return [
        Rule("date_posted", "str_matches(date)", F.col("date_posted").rlike(DATE_RE)),
        Rule("country_iso2", "str_length(2,2)", F.length("country_iso2") == 2),
        Rule("skill", "str_length(min=1)", _len_ge("skill", 1)),
        Rule("company", "str_length(min=1)", _len_ge("company", 1)),
        Rule("source", "str_length(min=2)", _len_ge("source", 2)),
        Rule("avg_salary", "in_range(1000,500000)", _in_range("avg_salary")),
        Rule("min_salary", "in_range(1000,500000)", _in_range("min_salary")),
        Rule("max_salary", "in_range(1000,500000)", _in_range("max_salary")),
        Rule("job_count", "ge(1)", F.col("job_count") >= 1),
        Rule("*", "min > avg", F.col("min_salary") <= F.col("avg_salary")),
        Rule("*", "avg > max", F.col("avg_salary") <= F.col("max_salary")),
    ]


def warehouse_fact_rules() -> list[Rule]:
    """H9: the warehouse CHECK / NOT NULL constraints of the fact table."""
    return [
        Rule("*", "ck_salary_order", F.col("min_salary").isNull() | F.col("max_salary").isNull()
             | (F.col("min_salary") <= F.col("max_salary"))),
        Rule("job_count", "ck_job_count_positive", F.col("job_count") >= 0),
        *[Rule(c, "not_null", F.col(c).isNotNull())
          for c in ("date_key", "id_country", "id_company", "id_skill", "id_source", "job_count")],
    ]


def _fails(rule: Rule) -> Column:
    return ~F.coalesce(rule.ok, F.lit(False))


def violation_counts(df: DataFrame, rules: list[Rule], dataset: Column | str | None = None) -> DataFrame:
    """Failures per rule, long form ``(dataset, column, check, failures)``.

    One pass: a single (optionally grouped) aggregation computes every count."""
    keys = [dataset.alias("dataset") if isinstance(dataset, Column) else
            F.col(dataset).alias("dataset")] if dataset is not None else []
    aggs = [F.count_if(_fails(r)).alias(f"r{i}") for i, r in enumerate(rules)]
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(r.column).alias("column"), F.lit(r.check).alias("check"),
                 F.col(f"r{i}").cast("bigint").alias("failures"))
        for i, r in enumerate(rules)])).alias("v")
    cols = ["dataset"] if keys else []
    return wide.select(*cols, stack).select(*cols, "v.*")


def failure_cases(df: DataFrame, rules: list[Rule], dataset: str | None = None,
                  value_cols: dict[str, str] | None = None) -> DataFrame:
    """H6: every failing (row, rule) as ``(dataset, column, check, failure_case)``.

    The failing value is shown as text (the row's column value, or the row's
    grain for table-wide rules)."""
    def case_value(r: Rule) -> Column:
        if r.column == "*":
            return F.concat_ws("|", *[F.col(c).cast("string") for c in (value_cols or {}).get("*", "").split(",") if c])
        return F.col(r.column).cast("string")

    arr = F.filter(F.array(*[
        F.when(_fails(r), F.struct(F.lit(r.column).alias("column"), F.lit(r.check).alias("check"),
                                   case_value(r).alias("failure_case")))
        for r in rules]), lambda x: x.isNotNull())
    ds = F.col(dataset) if dataset else F.lit(None).cast("string")
    return df.select(ds.alias("dataset"), F.explode(arr).alias("f")).select("dataset", "f.*")


def top_failures(cases: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` failing cases in a total order (distributed top-k)."""
    return cases.orderBy("dataset", "column", "check", "failure_case").limit(n)


def gate(counts: DataFrame, name: str) -> None:
    """H7: raise ``DataQualityError`` when any rule fails (one small action)."""
    bad = counts.where(F.col("failures") > 0).limit(10).collect()
    if bad:
        raise DataQualityError(f"data quality failed on '{name}': "
                               + "; ".join(f"{r['column']}/{r['check']}={r['failures']}" for r in bad))


def strict_columns(df: DataFrame, expected: list[str]) -> list[str]:
    """H4: missing and extra columns (driver-side schema comparison, no data)."""
    have = df.schema.fieldNames()
    return [f"missing:{c}" for c in expected if c not in have] + [f"extra:{c}" for c in have if c not in expected]


def coerce_failures(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """H5: per column, values present but not castable to the declared type."""
    aggs = [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull()).cast("bigint").alias(c)
            for c, t in types.items()]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`").alias("failures"))
        for c, t in types.items()])).alias("v")).select("v.*")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """H8: key values occurring more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def fact_integrity(fact: DataFrame, dim_country: DataFrame, key: str = "country_iso2",
                   dim_key: str = "iso2") -> DataFrame:
    """Fact non-empty and no fact whose country is missing from the
    dimension (only country is checked).  One row."""
    orphans = fact.join(dim_country, fact[key] == dim_country[dim_key], "left_anti")
    n = fact.agg(F.count(F.lit(1)).alias("fact_rows")).withColumn("_one", F.lit(1))
    o = orphans.agg(F.count(F.lit(1)).alias("orphans")).withColumn("_one", F.lit(1))
    return n.join(o, "_one").select(
        "fact_rows", "orphans", ((F.col("fact_rows") > 0) & (F.col("orphans") == 0)).alias("passed"))


def freshness(updates: DataFrame, label: str, ts: str, now: str) -> DataFrame:
    """Per dataset, hours since its last update (2 dp) and pass if < 25 h.
    ``now`` names a column holding the reference instant (a parameter, so the
    check is deterministic)."""
    last = updates.groupBy(label).agg(F.max(ts).alias("updated_at"), F.max(now).alias("_now"))
    age_us = F.expr("timestampdiff(MICROSECOND, updated_at, _now)")
    hours = F.floor(age_us.cast("double") / 3.6e9 * 100 + 0.5) / 100
    return last.select(label, F.col("updated_at").cast("string").alias("updated_at"), hours.alias("age_hours"),
                       (hours < config.FRESHNESS_MAX_HOURS).alias("passed"))
