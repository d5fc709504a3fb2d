"""Adapter: driver tables -> salary observations -> source-shaped bronze frames.

The reference generates its bronze dumps; we derive them from the driver's
tables instead, so every query's work grows with the data.  One lineitem row
is one salary observation:

* source     by ``l_linenumber % 4`` (adzuna, indeed, glassdoor, so_survey)
* date       month of ``o_orderdate``
* country    registry country by ``n_nationkey % 9`` (customer's nation)
* skill      registry skill by ``p_partkey % 12`` (a second one by ``p_size % 12``)
* company    ``s_name`` for the two sources that publish one
* salary     ``l_extendedprice``

Each source is then rendered in its own native shape (nested JSON pages,
French CSV columns with salary text, range text, USD amounts with a skill
list), and the source cleaners parse those shapes back.  The same rules are
written in SQL for the DuckDB oracle (``plans/oracle.py``).

Joins are left to Catalyst/AQE: lineitem x orders is a shuffle join at scale,
the dimension-sized sides go broadcast only when Spark's size check allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import month_start, round2
from ..functions._util import lit_array, lit_map
from ..session import keep_compiled
from .tables import load

# FIXED VALUES: display labels of the registry skills as sources print them
# (they normalise to the registry labels), and currency symbols per country.
SKILL_DISPLAY = ["Python", "JavaScript", "TypeScript", "Java", "Go", "Rust",
                 "SQL", "React", "Django", "Docker", "Kubernetes", "AWS"]
SYMBOL_BY_COUNTRY = {"GB": "£", "US": "$", "CA": "$", "AU": "$"}

ISO2 = [c[0] for c in config.COUNTRIES]
NAMES = [c[1] for c in config.COUNTRIES]
PAGE_ORDERS = 64  # orders per API page / CSV chunk: bounds every collected group
TASK_LINES = 100_000  # lines that one task renders and parses, about

# Made-up values of the rendered sources.
LOW, HIGH = 0.85, 1.15            # bounds of an advertised range around the price
PAY_LOW, PAY_HIGH = 0.95, 1.05    # bounds of a compensation record
TITLE_A, TITLE_B, TITLE_C = " specialist", " builder", " analyst"
STAMP = "T06:30:00Z"
PLACE, LEVEL = "Harbour", "L3"
NBSP = "\u00a0"


def pick(values: list, index: Column) -> Column:
    """values[index] for a 0-based integer Column (a literal array lookup)."""
    return F.element_at(lit_array(values), (index + 1).cast("int"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep_compiled(spark)  # rendering and parsing generate long methods
    # dealt by the key of the first (shuffle) join, however few splits the scan has; to tasks by rows, since a row is
    # few bytes but much work: dealt by bytes, Spark would leave hardly more tasks than cores, and a second wave of few
    li = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    li = li.repartition(li.count() // TASK_LINES + 1, "l_orderkey")
    o = load(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = load(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = load(spark, sf_dir, "nation", "n_nationkey")
    p = load(spark, sf_dir, "part", "p_partkey", "p_size")
    s = load(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, o.o_custkey == c.c_custkey)
           .join(n, c.c_nationkey == n.n_nationkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(s, li.l_suppkey == s.s_suppkey))
    nat = F.col("n_nationkey") % 9
    return j.select(
        "l_orderkey", "l_linenumber",
        pick(config.SALARY_SOURCES, F.col("l_linenumber") % 4).alias("src"),
        month_start("o_orderdate").alias("date_posted"),
        pick(ISO2, nat).alias("iso2"),
        pick(NAMES, nat).alias("country_name"),
        pick(SKILL_DISPLAY, F.col("p_partkey") % 12).alias("skill_label"),
        pick(SKILL_DISPLAY, F.col("p_size") % 12).alias("skill2_label"),
        "s_name",
        F.col("l_extendedprice").alias("price"),
    )


def _of(obs: DataFrame, source: str) -> DataFrame:
    return obs.where(F.col("src") == source)


def _page() -> Column:
    return F.floor(F.col("l_orderkey") / PAGE_ORDERS)


# ---------------------------------------------------------------- adzuna (API)

def offer_record() -> Column:
    """One offer as the API returns it; ``country`` is omitted on some rows and
    ``category`` carries a ``label`` instead of a ``tag`` on others."""
    category = F.when(F.col("l_orderkey") % 3 == 0, F.create_map(F.lit("label"), F.col("skill_label"))) \
                .otherwise(F.create_map(F.lit("tag"), F.col("skill_label")))
    return F.struct(
        F.concat(F.col("skill_label"), F.lit(TITLE_A)).alias("title"),
        F.struct(F.col("s_name").alias("display_name")).alias("company"),
        F.struct(F.col("country_name").alias("display_name")).alias("location"),
        round2(F.col("price") * LOW).alias("salary_min"),
        round2(F.col("price") * HIGH).alias("salary_max"),
        category.alias("category"),
        F.when(F.col("l_orderkey") % 5 != 0, F.lower("iso2")).alias("country"),
        F.concat(F.col("date_posted"), F.lit(STAMP)).alias("created"),
    )


def api_page_fields() -> dict[str, Column]:
    """One API response per order (an order carries at most one offer of this
    source): ``request_country, page, payload``."""
    return {
        "request_country": F.lower("iso2"),
        "page": F.col("l_orderkey"),
        "payload": F.to_json(F.struct(F.lit(1).cast("bigint").alias("count"),
                                      F.array(offer_record()).alias("results"))),
    }


def offers_api_pages(obs: DataFrame) -> DataFrame:
    """API responses ``(request_country, page, payload)``.  A pure projection:
    no aggregation, so it streams at scan speed."""
    return _of(obs, "adzuna").select(*[v.alias(k) for k, v in api_page_fields().items()])


def dump_record() -> Column:
    """One offer of the bronze dump, aligned on the bronze contract (tag and country set)."""
    return F.struct(
        F.concat(F.col("skill_label"), F.lit(TITLE_A)).alias("title"),
        F.struct(F.col("s_name").alias("display_name")).alias("company"),
        F.struct(F.col("country_name").alias("display_name")).alias("location"),
        round2(F.col("price") * LOW).alias("salary_min"),
        round2(F.col("price") * HIGH).alias("salary_max"),
        F.struct(F.col("skill_label").alias("tag")).alias("category"),
        F.lower("iso2").alias("country"),
        F.concat(F.col("date_posted"), F.lit(STAMP)).alias("created"),
    )


def offers_json_arrays(obs: DataFrame) -> DataFrame:
    """Bronze JSON dump as JSON-array texts, one per page (``page, json``)."""
    return _of(obs, "adzuna").groupBy(_page().alias("page")).agg(F.to_json(F.collect_list(dump_record())).alias("json"))


# ---------------------------------------------------------------- indeed (CSV)

def _salary_text() -> Column:
    """'€81k'; on a share of rows with a no-break space, or in full with separators ('€ 81,000')."""
    sym = F.coalesce(F.try_element_at(lit_map(SYMBOL_BY_COUNTRY.items()), F.col("iso2")), F.lit("€"))
    thousands = F.floor(F.col("price") / 1000)
    v = F.col("l_orderkey") % 10
    return (F.when(v == 1, F.concat(sym, F.lit(NBSP), thousands.cast("string"), F.lit("k")))
             .when(v == 2, F.concat(sym, F.lit(" "), F.format_number(thousands * 1000, 0)))
             .otherwise(F.concat(sym, thousands.cast("string"), F.lit("k"))))


def board_fields() -> dict[str, Column]:
    """Job-board CSV columns (French headers); the company is blank on some rows."""
    return {
        "Intitulé": F.concat(F.col("skill_label"), F.lit(TITLE_B)),
        "Entreprise": F.when(F.col("l_orderkey") % 97 == 0, F.lit("")).otherwise(F.col("s_name")),
        "Lieu": F.concat(F.lit(PLACE + ", "), F.col("country_name")),
        "Salaire annoncé": _salary_text(),
        "Requête": F.col("skill_label"),
        "Zone": F.col("country_name"),
        "Date": F.col("date_posted"),
    }


def board_rows(obs: DataFrame) -> DataFrame:
    """Job-board CSV rows, keyed by ``l_orderkey, l_linenumber``."""
    return _of(obs, "indeed").select("l_orderkey", "l_linenumber",
                                     *[v.alias(k) for k, v in board_fields().items()])


BOARD_COLUMNS = ["Intitulé", "Entreprise", "Lieu", "Salaire annoncé", "Requête", "Zone", "Date"]


def board_csv_lines(obs: DataFrame) -> DataFrame:
    """Job-board rows rendered as CSV text lines (``to_csv``), one per row."""
    b = board_rows(obs)
    return b.select("l_orderkey", "l_linenumber", F.to_csv(F.struct(*[F.col(c) for c in BOARD_COLUMNS])).alias("line"))


def board_csv_chunks(obs: DataFrame) -> DataFrame:
    """Whole CSV texts (header + rows) per page, as raw bronze bytes would be."""
    return csv_chunks(board_rows(obs), BOARD_COLUMNS)


def csv_chunks(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one source rendered as whole CSV texts (header + rows) per page."""
    lines = rows.select(_page().alias("page"), F.to_csv(F.struct(*[F.col(c) for c in columns])).alias("line"))
    return (lines.groupBy("page")
                 .agg(F.concat(F.lit(",".join(columns) + "\n"),
                               F.concat_ws("\n", F.collect_list("line")), F.lit("\n")).alias("csv")))


# ------------------------------------------------------------- glassdoor (CSV)

def range_fields() -> dict[str, Column]:
    """Salary-site CSV columns: the salary is a range text, on a share of rows with
    no-break spaces, a plus sign, or in full."""
    lo, hi = F.floor(F.col("price") * LOW / 1000).cast("string"), F.floor(F.col("price") * HIGH / 1000).cast("string")
    v = F.col("l_orderkey") % 10
    text = (F.when(v == 1, F.concat(lo, F.lit(NBSP + "k€–" + NBSP), hi, F.lit(NBSP + "k€")))
             .when(v == 2, F.concat(F.lit("+"), lo, F.lit("k–+"), hi, F.lit("K")))
             .when(v == 3, F.concat(lo, F.lit("000" + NBSP + "–" + NBSP), hi, F.lit("000")))
             .otherwise(F.concat(lo, F.lit("k–"), hi, F.lit("k€"))))
    return {
        "Rôle": F.concat(F.col("skill_label"), F.lit(TITLE_C)),
        "Ville": F.lit(PLACE),
        "Pays": F.col("country_name"),
        "Niveau": F.lit(LEVEL),
        "skill": F.col("skill_label"),
        "salary_range": text,
        "date_posted": F.col("date_posted"),
    }


def range_rows(obs: DataFrame) -> DataFrame:
    return _of(obs, "glassdoor").select("l_orderkey", "l_linenumber",
                                        *[v.alias(k) for k, v in range_fields().items()])


# ----------------------------------------------------------- so_survey (CSV)

def survey_fields() -> dict[str, Column]:
    """Survey CSV columns: USD amount as text (on a share of rows with separators, or
    no amount at all) and a ';'-separated skill list."""
    amount, v = F.floor(F.col("price")).cast("bigint"), F.col("l_orderkey") % 50
    return {
        "Country": F.col("country_name"),
        "ConvertedCompYearly": F.when(v == 1, F.format_number(amount, 0)).when(v == 2, F.lit("unpaid")).otherwise(amount.cast("string")),
        "LanguageHaveWorkedWith": F.concat_ws(";", F.col("skill_label"), F.col("skill2_label")),
    }


def survey_rows(obs: DataFrame) -> DataFrame:
    return _of(obs, "so_survey").select("l_orderkey", "l_linenumber",
                                        *[v.alias(k) for k, v in survey_fields().items()])


# ---------------------------------------------------- raw texts of all sources

RANGE_COLUMNS = ["Rôle", "Ville", "Pays", "Niveau", "skill", "salary_range", "date_posted"]
SURVEY_COLUMNS = ["Country", "ConvertedCompYearly", "LanguageHaveWorkedWith"]


def csv_sources() -> dict[str, tuple[list[str], dict[str, Column]]]:
    """Columns and fields of the sources that come as CSV."""
    return {"indeed": (BOARD_COLUMNS, board_fields()), "glassdoor": (RANGE_COLUMNS, range_fields()), "so_survey": (SURVEY_COLUMNS, survey_fields())}


def raw_texts(obs: DataFrame) -> DataFrame:
    """The raw texts of every source as delivered, ``(source, format, page, text)``: JSON arrays and headed CSV.

    Each observation is rendered as a record of its own source and the records of a page are put together, so
    all sources come from one pass over the observations and one shuffle.
    """
    src = F.col("src")
    line = F.when(src == "adzuna", F.to_json(dump_record()))
    header = F.lit("")
    for name, (columns, fields) in csv_sources().items():
        line = line.when(src == name, F.to_csv(F.struct(*[fields[c].alias(c) for c in columns])))
        header = F.when(F.col("source") == name, F.lit(",".join(columns) + "\n")).otherwise(header)
    pages = obs.select(src.alias("source"), _page().alias("page"), line.alias("line")).groupBy("source", "page").agg(F.collect_list("line").alias("lines"))
    is_json = F.col("source") == "adzuna"
    text = F.when(is_json, F.concat(F.lit("["), F.concat_ws(",", "lines"), F.lit("]"))) \
            .otherwise(F.concat(header, F.concat_ws("\n", "lines"), F.lit("\n")))
    return pages.select("source", F.when(is_json, "json").otherwise("csv").alias("format"), "page", text.alias("text"))


FILE_ORDERS = 16384  # orders a delivered file holds at most: bounds a file's text


def _deliver(obs: DataFrame, line: Column, text, path: str) -> None:
    """One file of raw text for each run of ``FILE_ORDERS`` orders."""
    files = obs.groupBy(F.floor(F.col("l_orderkey") / FILE_ORDERS).alias("chunk")).agg(text(F.collect_list(line)).alias("value"))
    files.write.partitionBy("chunk").text(path)


def deliver_json(obs: DataFrame, path: str) -> None:
    """Offers as files of one JSON array each, a record a line; on a share of rows the lower salary is no number."""
    damaged = F.when(F.col("l_orderkey") % 50 == 3, F.lit("n/a")).otherwise(round2(F.col("price") * LOW).cast("string"))
    rec = dump_record()
    line = F.to_json(F.struct(*[(damaged if c == "salary_min" else rec[c]).alias(c) for c in (
        "title", "company", "location", "salary_min", "salary_max", "category", "country", "created")]))
    _deliver(_of(obs, "adzuna"), line, lambda lines: F.concat(F.lit("[\n"), F.concat_ws(",\n", lines), F.lit("\n]")), path)


def deliver_csv(obs: DataFrame, path: str) -> None:
    """Job-board rows as headed CSV files, all fields quoted, with line breaks and quotes inside fields; on a
    share of rows the record is damaged by a field too many."""
    fields = board_fields()
    title = F.when(F.col("l_orderkey") % 7 == 0, F.concat(fields["Intitulé"], F.lit('\n"'), F.col("l_linenumber"), F.lit('", x'))).otherwise(fields["Intitulé"])
    cells = [F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), title, *[fields[c] for c in BOARD_COLUMNS[1:]]]
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in cells]
    line = F.concat(F.concat_ws(",", *quoted), F.when(F.col("l_orderkey") % 40 == 1, F.lit(',"one too many"')).otherwise(F.lit("")))
    header = ",".join(["l_orderkey", "l_linenumber", *BOARD_COLUMNS])
    _deliver(_of(obs, "indeed"), line, lambda lines: F.concat(F.lit(header + "\n"), F.concat_ws("\n", lines)), path)


# ------------------------------------------------- extra source (nested JSON)

def compensation_records(obs: DataFrame) -> DataFrame:
    """Records of the example extra source: organisation, office, compensation."""
    return obs.select(
        F.struct(F.col("s_name").alias("name")).alias("organization"),
        F.struct(F.col("country_name").alias("country")).alias("office"),
        F.col("skill_label").alias("profession"),
        F.struct(round2(F.col("price") * PAY_LOW).alias("min"), round2(F.col("price") * PAY_HIGH).alias("max"),
                 F.lit("EUR").alias("currency"), F.lit("yearly").alias("period")).alias("compensation"),
        F.col("date_posted").alias("published_at"),
    )


# ------------------------------------------------------- popularity sources

def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trending repositories, one per part: stars as '1,234' text, forks
    missing on some rows, a blank language on others (its skill is null)."""
    p = load(spark, sf_dir, "part", "p_partkey", "p_name", "p_size", "p_retailprice")
    return p.select(
        F.col("p_name").alias("repo"),
        F.concat(F.lit("Repository "), F.col("p_partkey").cast("string")).alias("description"),
        F.format_number(F.floor(F.col("p_retailprice") * 10).cast("bigint"), 0).alias("stars"),
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_size").cast("bigint")).alias("forks"),
        F.when(F.col("p_partkey") % 13 != 0, pick(SKILL_DISPLAY, F.col("p_partkey") % 12))
         .otherwise(F.lit("")).alias("language"),
        F.lit("daily").alias("period"),
    )


def interest_wide(obs: DataFrame) -> DataFrame:
    """Search interest in wide form: one row per (date, country), one column per
    keyword holding the number of observations; a keyword with none is empty."""
    return (obs.groupBy(F.col("date_posted").alias("date"), F.col("iso2").alias("country"))
               .pivot("skill_label", SKILL_DISPLAY)
               .agg(F.count(F.lit(1)).cast("int")))


def company_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company register ``company_name, workforce_size, sector`` from suppliers."""
    s = load(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    return s.select(
        F.col("s_name").alias("company_name"),
        pick(config.WORKFORCE_SIZES, F.col("s_suppkey") % 5).alias("workforce_size"),
        pick(config.SECTORS, F.col("s_suppkey") % 7).alias("sector"),
    )
