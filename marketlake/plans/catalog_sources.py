"""Registered queries: scans and payload shapes (A), scalar functions (B),
per-source cleaners (M1-M6).  Each reads the driver tables through the
adapter; each oracle derives the expected values from the numbers."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import (
    map_country_iso2, normalize_skill_label, resolve_countries, resolve_with_table,
    round1, round2, row_mean_skipna, thousands_int, fill_zero_int, timestamp_to_date_coerce,
    usd_prefix_amount, nan_to_null, cents,
)
from ..functions import iso3166
from ..functions.country import alias_rows
from ..functions.money import with_normalized_currency, with_salary_range, rate_to_eur
from ..operators import cleaners
from ..sources import adapter, readers
from ..session import fresh_path
from ..sources.tables import load
from . import medallion as md
from . import oracle as o
from .catalog import query

OBS = o.with_ctes(o.OBS)
R2, D = o.r2, o.d
SYM_SQL = "CASE iso2 WHEN 'GB' THEN '£' WHEN 'US' THEN '$' WHEN 'CA' THEN '$' WHEN 'AU' THEN '$' ELSE '€' END"
BOARD_TEXT_SQL = f"""CASE l_orderkey % 10 WHEN 1 THEN {SYM_SQL} || chr(160) || CAST(CAST(floor(price/1000) AS BIGINT) AS VARCHAR) || 'k'
  WHEN 2 THEN {SYM_SQL} || ' ' || format('{{:,}}', CAST(floor(price/1000) AS BIGINT) * 1000)
  ELSE {SYM_SQL} || CAST(CAST(floor(price/1000) AS BIGINT) AS VARCHAR) || 'k' END"""
CUR_SQL = ("CASE iso2 WHEN 'GB' THEN 'GBP' WHEN 'US' THEN 'USD' WHEN 'CA' THEN 'CAD' "
           "WHEN 'AU' THEN 'AUD' ELSE 'EUR' END")
CODE_RATE_SQL = ("CASE iso2 WHEN 'GB' THEN CAST(1.17 AS DOUBLE) WHEN 'US' THEN CAST(0.92 AS DOUBLE) "
                 "WHEN 'CA' THEN CAST(0.68 AS DOUBLE) WHEN 'AU' THEN CAST(0.62 AS DOUBLE) "
                 "ELSE CAST(1.0 AS DOUBLE) END")
CURRENCY_BY_ISO2 = {iso2: cur for iso2, _n, _r, cur in config.COUNTRIES}


def _obs(spark, sf):
    return md.observations(spark, sf)


def _of(spark, sf, src):
    return _obs(spark, sf).where(F.col("src") == src)


# ------------------------------------------------------------------ A: scans

_REC_COLS = ["title", "company_name", "location", "salary_min", "salary_max", "tag", "country", "created"]


def _records_out(r):
    return r.select("title", F.col("company.display_name").alias("company_name"),
                    F.col("location.display_name").alias("location"), "salary_min", "salary_max",
                    F.col("category.tag").alias("tag"), "country", "created")


def _records_sql(tag: str) -> str:
    return OBS + f"""SELECT skill_label || '{adapter.TITLE_A}' AS title, s_name AS company_name, country_name AS location,
  {R2('price*' + D(adapter.LOW))} AS salary_min, {R2('price*' + D(adapter.HIGH))} AS salary_max, {tag} AS tag,
  lower(iso2) AS country, date_posted || '{adapter.STAMP}' AS created FROM obs WHERE src = 'adzuna'"""


@query("scan_json_nested", _records_sql("skill_label"))
def q_scan_json_nested(spark, sf):
    """A1: JSON-array dumps parsed under an explicit nested schema."""
    arrays = adapter.offers_json_arrays(_obs(spark, sf))
    recs = arrays.select(F.explode(readers.parse_json_records("json", readers.OFFER_SCHEMA)).alias("r")).select("r.*")
    return _records_out(recs)


@query("api_payload_flatten", _records_sql("CASE WHEN l_orderkey % 3 = 0 THEN lower(skill_label) ELSE skill_label END"))
def q_api_payload_flatten(spark, sf):
    """API responses -> offer records (country from the request when absent,
    tag from lower(label) when absent)."""
    return _records_out(readers.flatten_api_payload(adapter.offers_api_pages(_obs(spark, sf))))


@query("scan_json_flat", f"""SELECT p_name AS repo, 'Repository ' || CAST(p_partkey AS VARCHAR) AS description,
  format('{{:,}}', CAST(floor(p_retailprice*10) AS BIGINT)) AS stars,
  CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size AS BIGINT) END AS forks,
  CASE WHEN p_partkey % 13 <> 0 THEN ({o.lst(adapter.SKILL_DISPLAY)})[p_partkey % 12 + 1] ELSE '' END AS language,
  'daily' AS period FROM part""")
def q_scan_json_flat(spark, sf):
    """A2: repository JSON arrays (64 parts per file) parsed flat."""
    repos = adapter.repositories(spark, sf).withColumn("_chunk", F.floor(F.monotonically_increasing_id() / 64))
    texts = repos.groupBy("_chunk").agg(F.to_json(F.collect_list(F.struct(
        *[F.col(c) for c in ["repo", "description", "stars", "forks", "language", "period"]]))).alias("json"))
    return texts.select(F.explode(readers.parse_json_records("json", readers.REPO_SCHEMA)).alias("r")).select("r.*")


_BOARD_SQL = OBS + f"""SELECT l_orderkey, l_linenumber, skill_label || '{adapter.TITLE_B}' AS "Intitulé",
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE s_name END AS "Entreprise",
  '{adapter.PLACE}, ' || country_name AS "Lieu", {BOARD_TEXT_SQL} AS "Salaire annoncé",
  skill_label AS "Requête", country_name AS "Zone", date_posted AS "Date"
FROM obs WHERE src = 'indeed'"""


@query("csv_na_tokens", _BOARD_SQL)
def q_csv_na_tokens(spark, sf):
    """A3: CSV lines with accented headers parsed (``from_csv``), NA tokens -> null."""
    lines = adapter.board_csv_lines(_obs(spark, sf))
    parsed = lines.select("l_orderkey", "l_linenumber",
                          readers.parse_csv_line("line", readers.BOARD_SCHEMA).alias("r")).select(
        "l_orderkey", "l_linenumber", "r.*")
    return readers.with_na_tokens(parsed)


@query("scan_csv_reference", f"""SELECT s_name AS company_name,
  ({o.lst(config.WORKFORCE_SIZES)})[s_suppkey % 5 + 1] AS workforce_size,
  ({o.lst(config.SECTORS)})[s_suppkey % 7 + 1] AS sector FROM supplier""")
def q_scan_csv_reference(spark, sf):
    """A4: company register as CSV lines, parsed under its schema."""
    reg = adapter.company_register(spark, sf)
    lines = reg.select(F.to_csv(F.struct("company_name", "workforce_size", "sector")).alias("line"))
    parsed = lines.select(readers.parse_csv_line("line", readers.REGISTER_SCHEMA).alias("r")).select("r.*")
    return readers.with_na_tokens(parsed)


@query("raw_registry")
def q_raw_registry(spark, sf):
    """Raw files kept as bytes with size and format (its SQL would need the folder's
    path, which the oracle's views do not tell: pytest holds it against the file system)."""
    r = readers.raw_registry(spark, f"{sf.rstrip('/')}/*.parquet")
    return r.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length", "format")


@query("raw_record_count", OBS + """SELECT src AS source, CASE WHEN src = 'adzuna' THEN 'json' ELSE 'csv' END AS format,
  CAST(floor(l_orderkey / 64) AS BIGINT) AS page, CAST(count(*) AS INTEGER) AS records FROM obs GROUP BY 1, 2, 3""")
def q_raw_record_count(spark, sf):
    """Record counts of the raw texts of every source: JSON array length, CSV newlines - 1."""
    t = adapter.raw_texts(_obs(spark, sf))
    return t.select("source", "format", F.col("page").cast("bigint"), readers.raw_record_count("text", F.col("format")).alias("records"))


@query("scan_json_files", _records_sql("skill_label").replace("SELECT skill_label", "SELECT l_orderkey % 50 = 3 AS damaged, skill_label")
       .replace(f"{R2('price*' + D(adapter.LOW))} AS salary_min", f"CASE WHEN l_orderkey % 50 <> 3 THEN {R2('price*' + D(adapter.LOW))} END AS salary_min"))
def q_scan_json_files(spark, sf):
    """A1 from files: JSON arrays delivered as files and read back, damaged records kept apart (their lower salary is no number)."""
    path = fresh_path(spark, "json-files")
    adapter.deliver_json(_obs(spark, sf), path)
    good, bad = readers.read_json_checked(spark, path, readers.OFFER_SCHEMA)
    return _records_out(good).withColumn("damaged", F.lit(False)).unionByName(_records_out(bad.select("rest.*")).withColumn("damaged", F.lit(True)))


@query("scan_csv_files", _BOARD_SQL.replace("""skill_label || '""" + adapter.TITLE_B + """' AS""", """skill_label || '""" + adapter.TITLE_B + """' || CASE WHEN l_orderkey % 7 = 0
  THEN chr(10) || '"' || l_linenumber || '", x' ELSE '' END AS""") + " AND l_orderkey % 40 <> 1")
def q_scan_csv_files(spark, sf):
    """A3 from files: quoted CSV with line breaks and quotes inside fields, delivered as files and read back by header;
    records with a field too many are kept apart (``damaged_csv_records`` counts them)."""
    good, _ = _csv_files(spark, sf)
    return good.withColumn("l_orderkey", F.col("l_orderkey").cast("bigint")).withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))


def _csv_files(spark, sf):
    path = fresh_path(spark, "csv-files")
    adapter.deliver_csv(_obs(spark, sf), path)
    return readers.read_csv_checked(spark, path, readers.string_schema(["l_orderkey", "l_linenumber", *adapter.BOARD_COLUMNS]))


@query("damaged_csv_records", OBS + """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(count(*) AS BIGINT) AS records
FROM obs WHERE src = 'indeed' AND l_orderkey % 40 = 1 GROUP BY 1""")
def q_damaged_csv_records(spark, sf):
    """A3: the records kept apart, by the order that their text names."""
    _, bad = _csv_files(spark, sf)
    return bad.groupBy(F.regexp_extract("record", '^"(\\d+)"', 1).alias("l_orderkey")).agg(F.count(F.lit(1)).cast("bigint").alias("records"))


def _text_sql(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '{readers.TAG_RE}', '', 'g'), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g')"


@query("html_listing_extract", f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, h[i] AS href, replace({_text_sql('t[i]')}, ' ', '') AS label
FROM (SELECT page_id, h, t, generate_subscripts(h, 1) AS i FROM (
  SELECT page_id, regexp_extract_all(html, '{readers.LINK_RE}', 1) AS h, regexp_extract_all(html, '{readers.LINK_RE}', 2) AS t
  FROM pages))""")
def q_html_listing_extract(spark, sf):
    """A10: links (target and text) of every raw page."""
    return readers.html_links(load(spark, sf, "pages", "page_id", "html"))


@query("html_listing_blocks", f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, {_text_sql('head')} AS title,
  replace({_text_sql(f"regexp_extract_all(head, '{readers.LINK_RE}', 2)[1]")}, ' ', '') AS item,
  {_text_sql(f"regexp_extract_all(block, '{readers.PARAGRAPH_RE}', 1)[1]")} AS description,
  coalesce({_text_sql(f"regexp_extract_all(block, '{readers.COUNT_RE}', 1)[1]")}, '0') AS stars
FROM (SELECT *, coalesce(regexp_extract_all(block, '{readers.HEAD2_RE}', 1)[1], regexp_extract_all(block, '{readers.HEAD1_RE}', 1)[1]) AS head
      FROM (SELECT page_id, unnest(b) AS block, generate_subscripts(b, 1) AS i
            FROM (SELECT page_id, regexp_extract_all(html, '{readers.BLOCK_RE}', 1) AS b FROM pages)))""")
def q_html_listing_blocks(spark, sf):
    """A10: listing blocks of every raw page, with their heading, paragraph and count."""
    return readers.html_blocks(load(spark, sf, "pages", "page_id", "html"))


@query("wide_to_long_interest", OBS + """SELECT date_posted AS date, skill_label AS keyword, iso2 AS country,
  CAST(count(*) AS INTEGER) AS interest FROM obs GROUP BY 1, 2, 3""")
def q_wide_to_long_interest(spark, sf):
    """Interest table wide (one column per keyword) -> long, empties skipped."""
    wide = adapter.interest_wide(_obs(spark, sf))
    return readers.wide_to_long(wide, ["date", "country"], adapter.SKILL_DISPLAY).select(
        "date", "keyword", "country", F.col("interest").cast("int"))


@query("silver_union", o.with_ctes(o.OBS, o.SILVER_RAW, o.SILVER) + "SELECT * FROM silver")
def q_silver_union(spark, sf):
    """Every registered source cleaned to the
    contract, quality-filtered, concatenated (UNION ALL)."""
    return md.silver(spark, sf)


@query("clean_compensation_json", OBS + f"""SELECT 'wttj' AS source, date_posted, iso2 AS country_iso2,
  lower(skill_label) AS skill, s_name AS company,
  {R2(f"({R2('price*' + D(adapter.PAY_LOW))} + {R2('price*' + D(adapter.PAY_HIGH))})/2")} AS salary_eur,
  {R2('price*' + D(adapter.PAY_LOW))} AS min_salary_eur, {R2('price*' + D(adapter.PAY_HIGH))} AS max_salary_eur FROM obs""")
def q_clean_compensation(spark, sf):
    """The example extra source (nested organisation/office/compensation)."""
    return cleaners.clean_compensation(adapter.compensation_records(_obs(spark, sf)))


# ------------------------------------------------------------ B: functions

@query("normalize_currency", OBS + f"""SELECT l_orderkey, l_linenumber,
  {BOARD_TEXT_SQL} AS salary_text,
  {R2(f"floor(price/1000)*1000*{o.RATE_SQL}")} AS salary_eur FROM obs WHERE src = 'indeed'""")
def q_normalize_currency(spark, sf):
    """B1 on symbol texts ('€81k', '£40k', '$52k')."""
    b = adapter.board_rows(_obs(spark, sf)).select("l_orderkey", "l_linenumber",
                                                   F.col("Salaire annoncé").alias("salary_text"))
    return with_normalized_currency(b, "salary_text", "salary_eur")


def _code_text():
    cur = F.try_element_at(F.create_map(*[x for k, v in CURRENCY_BY_ISO2.items() for x in (F.lit(k), F.lit(v))]),
                           F.col("iso2"))
    return F.concat(cur, F.format_number(F.floor("price").cast("bigint"), 0))


@query("normalize_currency_codes", OBS + f"""SELECT l_orderkey, l_linenumber,
  {CUR_SQL} || format('{{:,}}', CAST(floor(price) AS BIGINT)) AS salary_text,
  {R2(f"floor(price)*{CODE_RATE_SQL}")} AS salary_eur FROM obs""")
def q_normalize_currency_codes(spark, sf):
    """B1 on code-prefixed texts with thousands separators ('GBP45,123', 'CAD9,876')."""
    t = _obs(spark, sf).select("l_orderkey", "l_linenumber", _code_text().alias("salary_text"))
    return with_normalized_currency(t, "salary_text", "salary_eur")


@query("rates_lookup", OBS + f"""SELECT {CUR_SQL} AS currency, {CODE_RATE_SQL} AS rate,
  CAST(count(*) AS BIGINT) AS observations FROM obs GROUP BY 1, 2""")
def q_rates_lookup(spark, sf):
    """B2: currency of each observation's country -> EUR rate (unknown -> 1.0)."""
    cur = F.try_element_at(F.create_map(*[x for k, v in CURRENCY_BY_ISO2.items() for x in (F.lit(k), F.lit(v))]),
                           F.col("iso2"))
    return (_obs(spark, sf).groupBy(cur.alias("currency"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("observations"))
            .select("currency", rate_to_eur("currency").alias("rate"), "observations"))


def _country_cases() -> list[tuple[str, str | None]]:
    """Every code and name of the table with its alpha-2, then texts of no country."""
    return [*iso3166.exact().items(), ("QQ", None), ("ZZZ", None), ("NO SUCH LAND", None), ("LA LA", None), ("", None)]


def _country_texts(spark, sf):
    """Observations with a country text: plain, in lower case, or among white space of several kinds."""
    cases = _country_cases()
    text = adapter.pick([a for a, _ in cases], F.col("l_orderkey") % len(cases))
    v = F.col("l_linenumber") % 4
    raw = (F.when(v == 1, F.lower(text)).when(v == 2, F.concat(F.lit(" \t"), text, F.lit(adapter.NBSP)))
            .when(v == 3, F.concat(F.lit(adapter.NBSP), text, F.lit("\n"))).otherwise(text))
    return load(spark, sf, "lineitem", "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", raw.alias("raw"))


def _country_sql() -> str:
    cases = _country_cases()
    codes = ", ".join("NULL" if c is None else f"'{c}'" for _, c in cases)
    return f"""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 1 THEN lower(t) WHEN 2 THEN ' ' || chr(9) || t || chr(160)
  WHEN 3 THEN chr(160) || t || chr(10) ELSE t END AS raw, country_iso2
FROM (SELECT l_orderkey, l_linenumber, ({o.lst([a for a, _ in cases])})[l_orderkey % {len(cases)} + 1] AS t,
        ([{codes}])[l_orderkey % {len(cases)} + 1] AS country_iso2 FROM lineitem)"""


@query("map_country_iso2", _country_sql)
def q_map_country_iso2(spark, sf):
    """Every code and name of ISO 3166, and texts of no country."""
    return _country_texts(spark, sf).withColumn("country_iso2", map_country_iso2("raw"))


@query("country_table_resolve", _country_sql)
def q_country_table_resolve(spark, sf):
    """D7 table form: the same texts resolved by a join with the alias table."""
    aliases = spark.createDataFrame(alias_rows(), "alias_upper string, iso2 string, rank int")
    return resolve_with_table(_country_texts(spark, sf), "raw", aliases).select("l_orderkey", "l_linenumber", "raw", "country_iso2")


# FIXED VALUES: what texts name, from the public ISO 3166 list and by eye; the SQL of ``country_fuzzy`` knows nothing else.
PINNED_COUNTRIES = [
    ("France", "FR"), ("us", "US"), ("DEU", "DE"), ("Poland", "PL"), ("JPN", "JP"), ("Republic of Korea", "KR"), ("Viet Nam", "VN"),
    ("Brazil", "BR"), ("za", "ZA"), ("New Zealand", "NZ"), ("Russian Federation", "RU"), ("Czech Republic", "CZ"), ("Türkiye", "TR"),
    # words of a name
    ("Zealand", "NZ"), ("Kingdom", "GB"), ("Herzegovina", "BA"), ("Tobago", "TT"), ("Islamic Republic", "IR"), ("Plurinational State", "BO"),
    ("Saint Lucia", "LC"), ("Lanka", "LK"), ("Salvador", "SV"), ("Faso", "BF"), ("Saudi", "SA"),
    # beginnings of words
    ("Unit King", "GB"), ("Trinidad & Tob", "TT"), ("Luxemb", "LU"), ("Switz", "CH"), ("Liecht", "LI"), ("Kazakh", "KZ"),
    # misspelt names
    ("Germny", "DE"), ("Swizterland", "CH"), ("Philipines", "PH"), ("Argentinia", "AR"), ("Untied States", "US"), ("Frnace", "FR"),
    ("Belgum", "BE"), ("Singapure", "SG"), ("Colombia.", "CO"), ("Portugaal", "PT"), ("Madagaskar", "MG"),
    # no country
    ("no such land", None), ("QQ", None), ("ZZZ", None), ("", None), ("12345", None), ("---", None), ("remote", None), ("worldwide", None),
]


def _pinned_texts(spark, sf):
    text = adapter.pick([t for t, _ in PINNED_COUNTRIES], F.col("l_orderkey") % len(PINNED_COUNTRIES))
    v = F.col("l_linenumber") % 3  # every source of rows spells them in its own way; a third of all rows share one text
    raw = F.when(v == 1, F.lower(text)).when(v == 2, F.lit("Netherland")).otherwise(F.concat(F.lit(" "), text, F.lit("\t")))
    return load(spark, sf, "lineitem", "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", raw.alias("raw"))


@query("country_fuzzy", f"""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 1 THEN lower(t) WHEN 2 THEN 'Netherland'
    ELSE ' ' || t || chr(9) END AS raw, CASE WHEN l_linenumber % 3 = 2 THEN 'NL' ELSE iso2 END AS country_iso2
FROM (SELECT l_orderkey, l_linenumber, ({o.lst([t for t, _ in PINNED_COUNTRIES])})[l_orderkey % {len(PINNED_COUNTRIES)} + 1] AS t,
        ([{", ".join("NULL" if c is None else f"'{c}'" for _, c in PINNED_COUNTRIES)}])[l_orderkey % {len(PINNED_COUNTRIES)} + 1] AS iso2 FROM lineitem)""")
def q_country_fuzzy(spark, sf):
    """Codes, names, words of names, misspelt names and texts of no country; each distinct text resolved once."""
    return resolve_countries(_pinned_texts(spark, sf), "raw")


_LO, _HI = (f"CAST(CAST(floor(price*{D(x)}/1000) AS BIGINT) AS VARCHAR)" for x in (adapter.LOW, adapter.HIGH))


@query("parse_salary_range", OBS + f"""SELECT l_orderkey, l_linenumber,
  CASE l_orderkey % 10 WHEN 1 THEN {_LO} || chr(160) || 'k€–' || chr(160) || {_HI} || chr(160) || 'k€'
    WHEN 2 THEN '+' || {_LO} || 'k–+' || {_HI} || 'K' WHEN 3 THEN {_LO} || '000' || chr(160) || '–' || chr(160) || {_HI} || '000'
    ELSE {_LO} || 'k–' || {_HI} || 'k€' END AS salary_range,
  floor(price*{D(adapter.LOW)}/1000)*1000 AS min_salary_eur, floor(price*{D(adapter.HIGH)}/1000)*1000 AS max_salary_eur,
  {R2(f"(floor(price*{D(adapter.LOW)}/1000)*1000 + floor(price*{D(adapter.HIGH)}/1000)*1000)/2")} AS salary_eur
FROM obs WHERE src = 'glassdoor'""")
def q_parse_salary_range(spark, sf):
    """B4 + B8: range text -> (min, max) and strict midpoint."""
    r = adapter.range_rows(_obs(spark, sf)).select("l_orderkey", "l_linenumber", "salary_range")
    r = with_salary_range(r, "salary_range", "min_salary_eur", "max_salary_eur")
    return r.withColumn("salary_eur", round2((F.col("min_salary_eur") + F.col("max_salary_eur")) / 2))


@query("normalize_skill_label", r"""SELECT p_partkey, p_name || '/' || p_type || ' ' || p_brand AS raw,
  nullif(regexp_replace(regexp_replace(lower(p_name || '/' || p_type || ' ' || p_brand), '[^a-z0-9]+', '_', 'g'),
         '^_+|_+$', '', 'g'), '') AS label FROM part""")
def q_normalize_skill_label(spark, sf):
    """B5 on free-text part labels ('forest green/STANDARD Brand#12')."""
    p = load(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_brand")
    raw = F.concat_ws("", "p_name", F.lit("/"), "p_type", F.lit(" "), "p_brand")
    return p.select("p_partkey", raw.alias("raw")).select("p_partkey", "raw",
                                                          normalize_skill_label("raw").alias("label"))


@query("struct_field_or_null", OBS + """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE s_name END AS company FROM obs""")
def q_struct_field_or_null(spark, sf):
    """``company.display_name`` when company is an object; a bare string -> null."""
    company = F.when(F.col("l_orderkey") % 4 == 0, F.concat(F.lit('"'), F.col("s_name"), F.lit('"'))) \
               .otherwise(F.to_json(F.struct(F.col("s_name").alias("display_name"))))
    t = _obs(spark, sf).select("l_orderkey", "l_linenumber",
                               F.concat(F.lit('{"company": '), company, F.lit("}")).alias("j"))
    parsed = t.select("l_orderkey", "l_linenumber",
                      F.from_json("j", "company struct<display_name: string>").alias("r"))
    return parsed.select("l_orderkey", "l_linenumber", F.col("r.company.display_name").alias("company"))


@query("row_mean_skipna", OBS + f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 7 = 0 THEN {R2(R2('price*' + D(adapter.LOW)))}
       ELSE {R2(f"({R2('price*' + D(adapter.LOW))} + {R2('price*' + D(adapter.HIGH))})/2")} END AS salary_eur FROM obs""")
def q_row_mean_skipna(spark, sf):
    """Mean of min and max ignoring a missing max."""
    lo = round2(F.col("price") * adapter.LOW)
    hi = F.when(F.col("l_orderkey") % 7 != 0, round2(F.col("price") * adapter.HIGH))
    t = _obs(spark, sf).select("l_orderkey", "l_linenumber", lo.alias("lo"), hi.alias("hi"))
    return t.select("l_orderkey", "l_linenumber", row_mean_skipna("lo", "hi").alias("salary_eur"))


@query("timestamp_to_date_coerce", OBS + """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE date_posted END AS date_posted FROM obs""")
def q_timestamp_to_date_coerce(spark, sf):
    """ISO timestamps with Z -> date; unparsable text -> null."""
    created = F.when(F.col("l_orderkey") % 10 == 0, F.lit("bad")) \
               .otherwise(F.concat(F.col("date_posted"), F.lit(adapter.STAMP)))
    t = _obs(spark, sf).select("l_orderkey", "l_linenumber", created.alias("created"))
    return t.select("l_orderkey", "l_linenumber", timestamp_to_date_coerce("created").alias("date_posted"))


@query("thousands_int", "SELECT p_partkey, CAST(floor(p_retailprice*10) AS BIGINT) AS stars FROM part")
def q_thousands_int(spark, sf):
    """B10: '12,345' -> 12345."""
    p = load(spark, sf, "part", "p_partkey", "p_retailprice")
    t = p.select("p_partkey", F.format_number(F.floor(F.col("p_retailprice") * 10).cast("bigint"), 0).alias("s"))
    return t.select("p_partkey", thousands_int("s").alias("stars"))


@query("fill_zero_int", "SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size AS BIGINT) ELSE 0 END AS forks FROM part")
def q_fill_zero_int(spark, sf):
    """Missing forks -> 0."""
    p = load(spark, sf, "part", "p_partkey", "p_size")
    t = p.select("p_partkey", F.when(F.col("p_partkey") % 11 != 0, F.col("p_size").cast("bigint")).alias("f"))
    return t.select("p_partkey", fill_zero_int("f").alias("forks"))


@query("fill_unknown_company", o.with_ctes(o.OBS, o.SILVER_RAW, o.SILVER, o.SALARY)
       + "SELECT company, CAST(count(*) AS BIGINT) AS rows FROM salary GROUP BY company")
def q_fill_unknown_company(spark, sf):
    """Null or '' company -> 'Unknown', counted per company."""
    from ..operators import gold
    s = gold.salary_frame(md.silver(spark, sf))
    return s.groupBy("company").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


@query("literal_columns", o.with_ctes(o.OBS, o.SILVER_RAW, o.SILVER) + """SELECT source,
  CAST(count(*) AS BIGINT) AS rows, CAST(count(company) AS BIGINT) AS with_company,
  CAST(count(min_salary_eur) AS BIGINT) AS with_range, min(date_posted) AS first_date, max(date_posted) AS last_date
FROM silver GROUP BY source""")
def q_literal_columns(spark, sf):
    """Literal source names, fixed survey date, null company and range."""
    return md.silver(spark, sf).groupBy("source").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"), F.count("company").cast("bigint").alias("with_company"),
        F.count("min_salary_eur").cast("bigint").alias("with_range"),
        F.min("date_posted").alias("first_date"), F.max("date_posted").alias("last_date"))


@query("usd_prefix_amount", OBS + f"""SELECT l_orderkey, l_linenumber,
  CASE l_orderkey % 50 WHEN 1 THEN format('{{:,}}', CAST(floor(price) AS BIGINT)) WHEN 2 THEN 'unpaid'
    ELSE CAST(CAST(floor(price) AS BIGINT) AS VARCHAR) END AS amount_usd,
  CASE WHEN l_orderkey % 50 <> 2 THEN {R2(f"CAST(CAST(floor(price) AS BIGINT) AS DOUBLE)*{D(0.92)}")} END AS salary_eur
FROM obs WHERE src = 'so_survey'""")
def q_usd_prefix_amount(spark, sf):
    """USD amount text -> EUR as the 'USD{v}' text path gives; no number -> null."""
    s = adapter.survey_rows(_obs(spark, sf))
    return s.select("l_orderkey", "l_linenumber", F.col("ConvertedCompYearly").alias("amount_usd"),
                    usd_prefix_amount("ConvertedCompYearly").alias("salary_eur"))


@query("round_measures", OBS + f"""SELECT l_orderkey, l_linenumber, {R2('price*' + D(adapter.HIGH))} AS price_2dp,
  {o.r1('price/1000')} AS price_k_1dp FROM obs""")
def q_round_measures(spark, sf):
    """Engine-neutral half-up rounding to 2 and 1 decimals."""
    return _obs(spark, sf).select("l_orderkey", "l_linenumber", round2(F.col("price") * adapter.HIGH).alias("price_2dp"),
                                  round1(F.col("price") / 1000).alias("price_k_1dp"))


@query("nan_to_null", """SELECT event_type, CAST(count(*) FILTER (WHERE event_id % 50 <> 0) AS BIGINT) AS n_values,
  floor(CAST(sum(CASE WHEN event_id % 50 <> 0 THEN CAST(floor(value*100+0.5) AS BIGINT) END) AS DOUBLE)
        / count(*) FILTER (WHERE event_id % 50 <> 0) + 0.5) / 100 AS avg_value
FROM events GROUP BY event_type""")
def q_nan_to_null(spark, sf):
    """NaN readings -> null before aggregating (one NaN would poison avg)."""
    e = load(spark, sf, "events", "event_id", "event_type", "value")
    v = F.when(F.col("event_id") % 50 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    t = e.select("event_type", nan_to_null(v).alias("v"))
    return t.groupBy("event_type").agg(
        F.count("v").cast("bigint").alias("n_values"),
        (F.floor(F.sum(cents("v")).cast("double") / F.count("v") + 0.5) / 100).alias("avg_value"))


# ------------------------------------------------- M1-M6: source cleaners

@query("clean_api_json", o.with_ctes(o.OBS) + o.SILVER_ADZUNA)
def q_clean_api_json(spark, sf):
    """M1: offer API payloads -> silver (before the quality filter)."""
    return md.silver_parts(spark, sf, filtered=False)[0]


@query("clean_board_csv", o.with_ctes(o.OBS) + o.SILVER_INDEED)
def q_clean_board_csv(spark, sf):
    """M2: job-board CSV (local-currency salary text) -> silver."""
    return md.silver_parts(spark, sf, filtered=False)[1]


@query("clean_range_csv", o.with_ctes(o.OBS) + o.SILVER_GLASSDOOR)
def q_clean_range_csv(spark, sf):
    """M3: salary-site CSV (range text) -> silver."""
    return md.silver_parts(spark, sf, filtered=False)[2]


@query("clean_survey_csv", o.with_ctes(o.OBS) + o.SILVER_SURVEY)
def q_clean_survey_csv(spark, sf):
    """M4: survey CSV -> silver, one row per respondent x skill."""
    return md.silver_parts(spark, sf, filtered=False)[3]


REPO_SILVER_SQL = f"""SELECT CASE WHEN p_partkey % 13 <> 0 THEN lower(({o.lst(adapter.SKILL_DISPLAY)})[p_partkey % 12 + 1]) END AS skill,
  CAST(floor(p_retailprice*10) AS BIGINT) AS stars,
  CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size AS BIGINT) ELSE 0 END AS forks,
  'github_trending' AS source FROM part"""


@query("clean_repo_popularity", REPO_SILVER_SQL)
def q_clean_repo_popularity(spark, sf):
    """M5: repositories -> (skill, stars, forks, source)."""
    return md.repositories_silver(spark, sf)


TRENDS_SILVER_SQL = OBS + """SELECT date_posted AS date, lower(skill_label) AS skill, iso2 AS country_iso2,
  CAST(count(*) AS BIGINT) AS interest, 'google_trends' AS source FROM obs GROUP BY 1, 2, 3"""


@query("clean_search_trends", TRENDS_SILVER_SQL)
def q_clean_search_trends(spark, sf):
    """M6: search interest wide -> long -> silver; country passes unchanged."""
    return md.trends_silver(spark, sf)


@query("sql_function_surface", r"""SELECT p_partkey, p_name || '/' || p_type || ' ' || p_brand AS raw,
  nullif(regexp_replace(regexp_replace(lower(p_name || '/' || p_type || ' ' || p_brand), '[^a-z0-9]+', '_', 'g'),
         '^_+|_+$', '', 'g'), '') AS label FROM part""")
def q_sql_function_surface(spark, sf):
    """2.L: the same label rule called from SQL as a registered SQL function."""
    from ..functions.sql import register_sql_functions
    register_sql_functions(spark)
    load(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_brand").createOrReplaceTempView("ml_part")
    return spark.sql("""SELECT p_partkey, concat(p_name, '/', p_type, ' ', p_brand) AS raw,
                        normalize_skill_label(concat(p_name, '/', p_type, ' ', p_brand)) AS label FROM ml_part""")
