"""Per-source cleaners (M1-M6): bronze shape -> silver contract.

Every cleaner is a projection of native Column functions plus one generator
(``inline``) that emits a record's silver rows: one per API result, one per
CSV row, one per survey skill (G1).  No cleaner shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..sources import readers
from ..functions.country import with_country_iso2
from ..functions.money import with_normalized_currency, with_salary_range
from ..functions import (
    map_country_iso2, normalize_skill_label,
    range_midpoint_strict, row_mean_skipna, thousands_int, fill_zero_int,
    timestamp_to_date_coerce, usd_prefix_amount,
)


SILVER_TYPES = {"source": "string", "date_posted": "string", "country_iso2": "string", "skill": "string",
                "company": "string", "salary_eur": "double", "min_salary_eur": "double",
                "max_salary_eur": "double"}


def _null(type_: str):
    return F.lit(None).cast(type_)


def project_contract(df: DataFrame) -> DataFrame:
    """Select the 8-column silver contract, in order, with its types."""
    return df.select(*[F.col(c).cast(SILVER_TYPES[c]).alias(c) for c in config.SALARY_COLS])


def silver_row(**cols: Column) -> Column:
    """B15 for one row: a struct in contract order and types (missing -> null)."""
    return F.struct(*[(cols[c] if c in cols else _null(SILVER_TYPES[c])).cast(SILVER_TYPES[c]).alias(c)
                      for c in config.SALARY_COLS])


# Each ``parse_*`` takes a frame and the fields of a bronze record in it,
# ``rec`` (columns by name, null on rows of other sources), and returns the
# frame with its parse stages added, an array Column with an item for each
# silver row (None: one row a record), and ``finish(df, item)``, which adds the
# stages of an emitted item and gives the row's columns by name.
# The rows carry the *raw* country and skill text: ``finish_rows`` resolves
# both once, after the generator, in one projection for every source.  Items
# are emitted raw and parsed after the generator: what an array lambda or a
# generator computes is interpreted, a projection is compiled.  Multi-step
# parsers are staged as their own columns, so every regexp runs once per row.
# The same functions serve one source (``_clean``) and the single pass over
# all registered sources (``sources.registry.silver_all``).

Finish = Callable[[DataFrame, Column | None], tuple[DataFrame, dict[str, Column]]]
Parsed = tuple[DataFrame, Column | None, Finish]


def emit_rows(df: DataFrame, parsed: dict[str, tuple[Column | None, Finish]], src: Column) -> DataFrame:
    """One row for each item of a record's own source (``src`` names it), in contract order."""
    own = {name: f"_i_{name}" for name, (items, _) in parsed.items() if items is not None}
    single = [name for name in parsed if name not in own]
    if own:
        arrays = [F.when(src == name, parsed[name][0]).alias(i) for name, i in own.items()]
        types = df.select(*arrays).schema
        arrays = [F.coalesce(c, F.array().cast(types[i].dataType)) for c, i in zip(arrays, own.values())]
        arrays.append(F.when(src.isin(single), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
        staged = [f"_items_{i}" for i in range(len(arrays))]
        df = df.select("*", *[c.alias(i) for c, i in zip(arrays, staged)])
        # zipped in the generator: of a column alone Catalyst would infer a filter and parse again for it
        df = df.select("*", F.inline(F.arrays_zip(*staged)).alias(*own.values(), "_one")).drop(*staged, "_one")
    out: dict[str, Column] = {}
    for name, (_, finish) in parsed.items():
        df, row = finish(df, F.col(own[name]) if name in own else None)
        for c, v in row.items():
            v = v.cast(SILVER_TYPES[c])
            out[c] = out[c].when(src == name, v) if c in out else F.when(src == name, v)
    df = df.where(src.isin(list(parsed)))
    return df.select(*[out.get(c, _null(SILVER_TYPES[c])).alias(c) for c in config.SALARY_COLS])


def finish_rows(rows: DataFrame) -> DataFrame:
    """B3 on the country text and B5 on the skill text of parsed rows; the
    result is the silver contract."""
    return with_country_iso2(rows, "country_iso2", "country_iso2").select(
        *[(normalize_skill_label(F.col(c)) if c == "skill" else F.col(c)).alias(c) for c in config.SALARY_COLS])


def offer_columns(o: Column, source: str, lo: Column, hi: Column) -> dict[str, Column]:
    """M1 for one bronze offer record (company/category structs) with its salaries as doubles."""
    return dict(
        source=F.lit(source),
        date_posted=timestamp_to_date_coerce(o["created"]),
        country_iso2=o["country"], skill=o["category"]["tag"],
        company=o["company"]["display_name"],
        salary_eur=row_mean_skipna(lo, hi), min_salary_eur=lo, max_salary_eur=hi,
    )


def offer_row(o: Column, source: str = "adzuna") -> Column:
    """M1 for one bronze offer record as a struct."""
    return silver_row(**offer_columns(o, source, o["salary_min"].cast("double"), o["salary_max"].cast("double")))


def parse_api_pages(df: DataFrame, rec: dict[str, Column], source: str = "adzuna") -> Parsed:
    """A9 + M1: an API response ``(request_country, payload)`` -> one row per result."""
    def finish(df: DataFrame, m: Column) -> tuple[DataFrame, dict[str, Column]]:
        cat, lo, hi = (f"_{source}_{x}" for x in ("category", "lo", "hi"))
        offer = readers.api_offer(m, rec["request_country"], F.col(cat))
        df = df.withColumn(cat, readers.api_category(m)).withColumn(lo, offer["salary_min"]).withColumn(hi, offer["salary_max"])
        return df, offer_columns(offer, source, F.col(lo), F.col(hi))

    return df, readers.payload_results(rec["payload"]), finish


def parse_board(df: DataFrame, rec: dict[str, Column], source: str = "indeed") -> Parsed:
    """M2: job-board CSV row (salary as local-currency text)."""
    eur = f"_{source}_eur"
    df = with_normalized_currency(df, rec["Salaire annoncé"], eur)
    return df, None, lambda df, _: (df, dict(
        source=F.lit(source), date_posted=rec["Date"], country_iso2=rec["Zone"], skill=rec["Requête"],
        company=rec["Entreprise"], salary_eur=F.col(eur)))


def parse_ranges(df: DataFrame, rec: dict[str, Column], source: str = "glassdoor") -> Parsed:
    """M3: salary-site CSV row (range text); midpoint strict, no company."""
    lo, hi = f"_{source}_lo", f"_{source}_hi"
    df = with_salary_range(df, rec["salary_range"], lo, hi)
    return df, None, lambda df, _: (df, dict(
        source=F.lit(source), date_posted=rec["date_posted"], country_iso2=rec["Pays"], skill=rec["skill"],
        salary_eur=range_midpoint_strict(lo, hi), min_salary_eur=F.col(lo), max_salary_eur=F.col(hi)))


def parse_survey(df: DataFrame, rec: dict[str, Column], source: str = "so_survey") -> Parsed:
    """M4 + G1: one row per respondent x skill.

    The amount is read as USD whatever the respondent's currency; empty list
    parts are dropped, and so are parts whose label normalises to null (C4:
    no ASCII letter or digit once lower-cased); the salary repeats on each
    skill row; the date is the fixed survey date.
    """
    eur = f"_{source}_eur"
    df = df.withColumn(eur, usd_prefix_amount(rec["ConvertedCompYearly"]))
    parts = F.filter(F.split(F.coalesce(rec["LanguageHaveWorkedWith"], F.lit("")), ";", -1),
                     lambda x: F.lower(x).rlike("[a-z0-9]"))
    return df, parts, lambda df, sk: (df, dict(
        source=F.lit(source), date_posted=F.lit(config.AS_OF_DATE),
        country_iso2=rec["Country"], skill=sk, salary_eur=F.col(eur)))


def _clean(df: DataFrame, parse, source: str) -> DataFrame:
    """Run one parser over a bronze frame (its columns are the record)."""
    b, items, finish = parse(df, {c: F.col(f"`{c}`") for c in df.columns}, source)
    return finish_rows(emit_rows(b, {source: (items, finish)}, F.lit(source)))


def clean_offers(records: DataFrame, source: str = "adzuna") -> DataFrame:
    """M1: nested offer records (company/category structs) -> silver."""
    rec = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    return finish_rows(records.select(offer_row(rec, source).alias("s")).select("s.*"))


def clean_board(rows: DataFrame, source: str = "indeed") -> DataFrame:
    """M2: job-board CSV (salary as local-currency text) -> silver."""
    return _clean(rows, parse_board, source)


def clean_ranges(rows: DataFrame, source: str = "glassdoor") -> DataFrame:
    """M3: salary-site CSV (range text) -> silver."""
    return _clean(rows, parse_ranges, source)


def clean_survey(rows: DataFrame, source: str = "so_survey") -> DataFrame:
    """M4: survey CSV -> silver, one row per respondent x skill (G1)."""
    return _clean(rows, parse_survey, source)


def clean_compensation(records: DataFrame, source: str = "wttj") -> DataFrame:
    """Example extra source with nested organisation/office/compensation."""
    lo, hi = F.col("compensation.min"), F.col("compensation.max")
    return project_contract(records.select(
        F.col("organization.name").alias("company"),
        normalize_skill_label("profession").alias("skill"),
        map_country_iso2("office.country").alias("country_iso2"),
        lo.alias("min_salary_eur"), hi.alias("max_salary_eur"),
        row_mean_skipna(lo, hi).alias("salary_eur"),
        timestamp_to_date_coerce("published_at").alias("date_posted"),
        F.lit(source).alias("source"),
    ))


def clean_repositories(repos: DataFrame) -> DataFrame:
    """M5: trending repositories -> (skill, stars, forks, source)."""
    return repos.select(
        normalize_skill_label("language").alias("skill"),
        thousands_int("stars").alias("stars"),
        fill_zero_int("forks").alias("forks"),
        F.lit("github_trending").alias("source"),
    )


def clean_trends(long: DataFrame) -> DataFrame:
    """M6: search interest (long form) -> (date, skill, country_iso2, interest, source).
    The country passes unchanged."""
    return long.select(
        F.col("date").cast("string").alias("date"),
        normalize_skill_label("keyword").alias("skill"),
        F.col("country").alias("country_iso2"),
        F.col("interest").cast("bigint").alias("interest"),
        F.lit("google_trends").alias("source"),
    )


def quality_rule(row: Column | None = None) -> Column:
    """C1 as a predicate: country, skill and salary present, salary > 0.
    Over the frame's columns, or over the fields of a silver-row struct."""
    get = F.col if row is None else (lambda c: row[c])
    return (get("country_iso2").isNotNull() & get("skill").isNotNull()
            & get("salary_eur").isNotNull() & (get("salary_eur") > 0))


def quality_filter(df: DataFrame) -> DataFrame:
    """Drop rows without country, skill or salary; keep salary > 0.

    Written as a generator (``inline`` of a one-element array that is null
    for rejected rows) rather than a ``where``: Catalyst pushes a filter below
    the cleaning projections and substitutes every parsing expression into
    the predicate (evaluated twice, and the generated code outgrows the JVM
    method limit).  The generator is evaluated once, on the cleaned columns.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.inline(F.when(quality_rule(), F.array(row))))


def reject_rate(silver_raw: DataFrame) -> DataFrame:
    """Per source, rows before, kept and rejected by the quality filter, in one pass."""
    ok = quality_rule()
    return (silver_raw.groupBy("source")
            .agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(ok).alias("rows_kept"))
            .withColumn("rows_rejected", F.col("rows_before") - F.col("rows_kept")))
