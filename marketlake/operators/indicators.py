"""Indicator queries over the gold fact.

Medians and quartiles are exact (``quantiles.grouped_percentiles``), averages
are integer-cent sums, so results do not depend on partitioning.  Statistics
are unweighted over fact rows (a median of averages), as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import avg_cents, cents, date_parts, fold_country, fold_lower, indicator_pk, indicator_sk, round1
from ..session import materialize
from .quantiles import grouped_percentiles

# public cube dimension -> fact column
CUBE_COLUMNS = {"country": "country_iso2", "skill": "skill", "source": "source",
                "year": "year", "month": "month"}


def _mean_parts() -> dict:
    """Mean of ``avg_salary`` in mergeable parts (see ``avg_cents``), and the row count."""
    x = F.col("avg_salary")
    return {"_cents": ("sum", cents(x)), "_values": ("sum", x.isNotNull().cast("bigint")), "_rows": ("sum", F.lit(1).cast("bigint"))}


def _whole_cents(fact: DataFrame) -> DataFrame:
    """``_cv``: the salary in whole cents, between which percentiles interpolate (half a cent is exact)."""
    return fact.withColumn("_cv", cents("avg_salary").cast("double"))


def _euros(c: str) -> Column:
    return F.floor(F.col(c) + 0.5) / 100


def _mean() -> Column:
    return F.floor(F.col("_cents").cast("double") / F.col("_values") + 0.5) / 100


def with_date_parts(fact: DataFrame) -> DataFrame:
    parts = date_parts("date_posted")
    return fact.withColumn("year", parts["year"]).withColumn("month", parts["month"])


def filter_common(fact: DataFrame, country: str | None = None, skill: str | None = None,
                  source: str | None = None) -> DataFrame:
    """C3 + B19: optional equality filters; empty value = no filter.  Country is
    upper-cased, skill and source lower-cased.  The predicates reach the
    parquet scan when the fact is read from storage."""
    if country:
        fact = fact.where(F.col("country_iso2") == F.lit(fold_country(country)))
    if skill:
        fact = fact.where(F.col("skill") == F.lit(fold_lower(skill)))
    if source:
        fact = fact.where(F.col("source") == F.lit(fold_lower(source)))
    return fact


def salary_stats(fact: DataFrame, **filters) -> DataFrame:
    """E5: median, p25, p75, mean of ``avg_salary`` and fact-row count; one row,
    nulls and 0 on empty input."""
    f = filter_common(fact, **filters)
    r = grouped_percentiles(_whole_cents(f), [], "_cv", {"_median": 0.5, "_p25": 0.25, "_p75": 0.75}, _mean_parts())
    return r.select(_euros("_median").alias("median"), _euros("_p25").alias("p25"), _euros("_p75").alias("p75"),
                    _mean().alias("avg"), F.coalesce("_rows", F.lit(0)).cast("bigint").alias("sample_size"))


def salary_daily(fact: DataFrame, **filters) -> DataFrame:
    """Per date, mean of ``avg_salary`` and total ``job_count``, by date."""
    f = filter_common(fact, **filters)
    return (f.groupBy(F.col("date_posted").alias("date"))
            .agg(avg_cents("avg_salary").alias("avg_salary"),
                 F.sum("job_count").cast("bigint").alias("job_count"))
            .orderBy("date"))


def cube_dimensions(requested: str | None) -> list[str]:
    """E7 parameter rule: split on commas, trim, drop unknown names, collapse
    repeats (first position wins); none left -> ``country, skill``."""
    req = [d.strip() for d in (requested if requested is not None else "country,skill").split(",")]
    dims: list[str] = []
    for d in req:
        if d in CUBE_COLUMNS and d not in dims:
            dims.append(d)
    return dims or ["country", "skill"]


def salary_cube(fact: DataFrame, dimensions: str | None = None, **filters) -> DataFrame:
    """One GROUP BY over the requested dimensions (no subtotals): mean and
    median of ``avg_salary`` and total ``job_count``, ordered by the dims.
    ``month`` without ``year`` merges months of different years."""
    dims = cube_dimensions(dimensions)
    f = with_date_parts(filter_common(fact, **filters))
    f = f.select(*[F.col(CUBE_COLUMNS[d]).alias(d) for d in dims], "avg_salary", "job_count")
    r = grouped_percentiles(_whole_cents(f), dims, "_cv", {"_median": 0.5}, {**_mean_parts(), "_jobs": ("sum", F.col("job_count"))})
    return r.select(*dims, _mean().alias("avg_salary"), _euros("_median").alias("median_salary"), F.col("_jobs").cast("bigint").alias("job_count")) \
            .orderBy(*dims)


def salary_cube_subtotals(fact: DataFrame, dims: list[str]) -> DataFrame:
    """Extension (not in the reference): CUBE with subtotals; mean and total only."""
    f = with_date_parts(fact).select(*[F.col(CUBE_COLUMNS[d]).alias(d) for d in dims],
                                     "avg_salary", "job_count")
    return (f.cube(*dims).agg(avg_cents("avg_salary").alias("avg_salary"),
                              F.sum("job_count").cast("bigint").alias("job_count"),
                              F.grouping_id().cast("int").alias("grouping_id")))


def hot_indicators(fact: DataFrame) -> DataFrame:
    """Per country x skill (null keys dropped, as pandas does): median and
    mean of ``avg_salary``, total ``job_count`` as ``volume``."""
    f = fact.where(F.col("country_iso2").isNotNull() & F.col("skill").isNotNull())
    r = grouped_percentiles(_whole_cents(f), ["country_iso2", "skill"], "_cv", {"_median": 0.5}, {**_mean_parts(), "_jobs": ("sum", F.col("job_count"))})
    return r.select("country_iso2", "skill", _euros("_median").alias("median"), _mean().alias("avg"), F.col("_jobs").cast("bigint").alias("volume"))


def hot_indicator_items(fact: DataFrame) -> DataFrame:
    """Key-value items ``(pk, sk)`` -> median, mean, volume (unique on pk, sk)."""
    h = hot_indicators(fact)
    return h.select(indicator_pk("country_iso2").alias("pk"), indicator_sk("skill").alias("sk"),
                    F.col("median").alias("median_salary_eur"), F.col("avg").alias("avg_salary_eur"),
                    "volume")


def hot_items_of_counts(counts: DataFrame) -> DataFrame:
    """A16 from folded facts ``(country_iso2, skill, cents, n, jobs)``: as ``hot_indicator_items`` over the facts themselves."""
    held = F.col("cents").isNotNull()
    r = grouped_percentiles(counts.withColumn("_cv", F.col("cents").cast("double")), ["country_iso2", "skill"], "_cv", {"_median": 0.5},
                            {"_cents": ("sum", F.col("cents") * F.col("n")), "_values": ("sum", F.when(held, F.col("n")).otherwise(0)),
                             "_jobs": ("sum", F.col("jobs"))}, weight="n")
    return r.select(indicator_pk("country_iso2").alias("pk"), indicator_sk("skill").alias("sk"), _euros("_median").alias("median_salary_eur"),
                    _mean().alias("avg_salary_eur"), F.col("_jobs").cast("bigint").alias("volume"))


def write_hot_items(items: DataFrame, path: str) -> DataFrame:
    """The items stored by ``pk``, one folder for each, so a lookup reads one."""
    items.write.mode("overwrite").partitionBy("pk").parquet(path)
    return items.sparkSession.read.schema(items.schema).parquet(path).select(items.columns)


def hot_indicator_lookup(items: DataFrame, country: str | None = None, skill: str | None = None) -> DataFrame:
    """Point lookup; defaults FR / python; no row when missing.  With items
    stored ``partitionBy('pk')`` the pk predicate prunes partitions."""
    c = (country or "FR").upper()
    s = (skill or "python").lower()
    return items.where((F.col("pk") == f"country#{c}") & (F.col("sk") == f"skill#{s}"))


def median_by_country_ranked(fact: DataFrame, skill: str) -> DataFrame:
    """Cube on country for one skill, by median descending (null as 0),
    ties by country."""
    c = salary_cube(fact, "country", skill=skill)
    return c.orderBy(F.coalesce("median_salary", F.lit(0.0)).desc(), "country")


def latency_summary(df: DataFrame, label: str, value: str) -> DataFrame:
    """Per label, p50/p95/p99 by nearest rank ``k = round(p*(n-1))``,
    mean and max, one decimal; plus n."""
    v = F.col(value)
    r = grouped_percentiles(df, [label], value, {"_p50": 0.5, "_p95": 0.95, "_p99": 0.99}, mode="nearest", aggs={
        "n": ("sum", v.isNotNull().cast("bigint")), "_sum_c": ("sum", cents(v)), "_max": ("max", v)})
    return r.select(
        label, F.col("n").cast("bigint").alias("n"),
        round1("_p50").alias("p50"), round1("_p95").alias("p95"), round1("_p99").alias("p99"),
        (F.floor(F.col("_sum_c").cast("double") / F.col("n") / 10 + 0.5) / 10).alias("mean"),
        round1("_max").alias("max"))


def dimension_values(dim_country: DataFrame, dim_skill: DataFrame, dim_source: DataFrame) -> DataFrame:
    """F8: sorted dimension values from the dimensions (not the facts), long form."""
    return (dim_country.select(F.lit("countries").alias("dimension"), F.col("iso2").alias("value"))
            .unionByName(dim_skill.select(F.lit("skills").alias("dimension"), F.col("tech_label").alias("value")))
            .unionByName(dim_source.select(F.lit("sources").alias("dimension"), F.col("source_name").alias("value")))
            .orderBy("dimension", "value"))


def paginate(df: DataFrame, order: list[Column | str], limit: int | None = None,
             offset: int = 0) -> DataFrame:
    """limit/offset page (default 50, max 500) over a total order, with the
    total row count on every row (the API returns it beside the page).

    ``df`` is computed once, into the shared folder; the total is the row count
    of what was written, a constant for the plan.  The page is a distributed
    top-k and is sorted last."""
    lim = min(limit or config.PAGE_DEFAULT_LIMIT, config.PAGE_MAX_LIMIT)
    rows = materialize(df, "page")
    total = F.lit(rows.count()).cast("bigint").alias("total_count")
    return rows.select("*", total).orderBy(*order).offset(offset).limit(lim)
