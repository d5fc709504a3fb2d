"""Scans of bronze shapes.

File readers take explicit schemas (no inference, no driver-side parsing).
Each has a column form too (``parse_*``) that applies the same parser to text
columns, which is how the registered queries feed driver-derived bronze text
through it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import na_tokens_to_null
from ..functions._util import as_col
from ..session import materialize

# ---------------------------------------------------------------- schemas

OFFER_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("company", T.StructType([T.StructField("display_name", T.StringType())])),
    T.StructField("location", T.StructType([T.StructField("display_name", T.StringType())])),
    T.StructField("salary_min", T.DoubleType()),
    T.StructField("salary_max", T.DoubleType()),
    T.StructField("category", T.StructType([T.StructField("tag", T.StringType())])),
    T.StructField("country", T.StringType()),
    T.StructField("created", T.StringType()),
])

REPO_SCHEMA = T.StructType([
    T.StructField("repo", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("stars", T.StringType()),
    T.StructField("forks", T.LongType()),
    T.StructField("language", T.StringType()),
    T.StructField("period", T.StringType()),
])

COMPENSATION_SCHEMA = T.StructType([
    T.StructField("organization", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("office", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("profession", T.StringType()),
    T.StructField("compensation", T.StructType([
        T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType()),
        T.StructField("currency", T.StringType()), T.StructField("period", T.StringType())])),
    T.StructField("published_at", T.StringType()),
])


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


BOARD_SCHEMA = string_schema(["Intitulé", "Entreprise", "Lieu", "Salaire annoncé", "Requête", "Zone", "Date"])
RANGE_SCHEMA = string_schema(["Rôle", "Ville", "Pays", "Niveau", "skill", "salary_range", "date_posted"])
SURVEY_SCHEMA = string_schema(["Country", "ConvertedCompYearly", "LanguageHaveWorkedWith"])
TRENDS_SCHEMA = string_schema(["date", "keyword", "country", "interest"])
REGISTER_SCHEMA = string_schema(["company_name", "workforce_size", "sector"])

# ------------------------------------------------------------- file readers


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A1/A2: a file holding one JSON array of records, under an explicit schema."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def _unparsed(t: T.DataType) -> T.DataType:
    """The type a field is read as: text, and a variant where numbers are expected.  In a file of many lines a number
    read as text is fetched from the file again, on its own: forty times the bytes, and most of the time."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _unparsed(f.dataType)) for f in t.fields])
    return T.VariantType() if isinstance(t, T.DoubleType) else T.StringType()


def _text(c: Column, t: T.DataType) -> Column:
    """An unparsed field of type ``t`` as text."""
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_text(c[f.name], f.dataType).alias(f.name) for f in t.fields]))
    return c.cast("string")


def _typed(c: Column, t: T.DataType) -> Column:
    """A column of texts in the shape of ``t``, cast field by field; what cannot be cast is null."""
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_typed(c[f.name], f.dataType).alias(f.name) for f in t.fields]))
    return c.try_cast(t)


def _lost(c: Column, t: T.DataType, name: str) -> list[Column]:
    if isinstance(t, T.StructType):
        return [x for f in t.fields for x in _lost(c[f.name], f.dataType, f"{name}.{f.name}")]
    return [] if isinstance(t, T.StringType) else [F.when(c.isNotNull() & c.try_cast(t).isNull(), F.lit(name))]


def read_json_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """A1/A2 with damaged records kept apart: (records under ``schema``, damaged ones).

    A field whose value is not of its type, or a document that is no JSON, makes a record damaged: it is
    returned as ``(fields, record, rest)``, the names of the fields (none for a broken document), its text and
    what can be read of it, and is not among the others.
    """
    unparsed = _unparsed(schema).add("_broken", T.StringType())
    df = spark.read.schema(unparsed).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)
    df = df.select(*[_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields], "_broken")
    df = materialize(df, "json-parsed")  # parsed once for both results
    lost = F.array_compact(F.array(*[x for f in schema.fields for x in _lost(F.col(f"`{f.name}`"), f.dataType, f.name)]).cast("array<string>"))
    df = df.withColumn("_fields", lost)
    fine = (F.size("_fields") == 0) & F.col("_broken").isNull()
    typed = [_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields]
    good = df.where(fine).select(*typed)
    record = F.coalesce("_broken", F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields])))
    return good, df.where(~fine).select(F.col("_fields").alias("fields"), record.alias("record"), F.struct(*typed).alias("rest"))


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, na_tokens: bool = True) -> tuple[DataFrame, DataFrame]:
    """A3/A4 with damaged records kept apart: (rows as ``read_csv`` gives them, texts ``record`` of lines that do not
    have the header's number of fields)."""
    options = {"header": True, "multiLine": True, "escape": '"'}
    names = _header(spark, path)
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path}: no column {missing}; the header has {names}")
    df = (spark.read.schema(string_schema(names).add("_broken", T.StringType())).options(**options)
               .option("columnNameOfCorruptRecord", "_broken").option("columnPruning", False).csv(path))
    df = materialize(df, "csv-parsed")  # parsed once for both results
    good = df.where("_broken is null").select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    return with_na_tokens(good) if na_tokens else good, df.where("_broken is not null").select(F.col("_broken").alias("record"))


def _header(spark: SparkSession, path: str) -> list[str]:
    """Names in the first line of the files (folders' partition columns are not among them)."""
    lines = spark.read.option("inferSchema", False).option("header", False).option("multiLine", True).option("escape", '"').csv(path)
    first = lines.select(*[c for c in lines.columns if c.startswith("_c")]).first()
    return [] if first is None else [v for v in first if v is not None]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, na_tokens: bool = True) -> DataFrame:
    """A3/A4: headed CSV (accented headers are fine), all columns as text.

    Columns are found by their header names, so a wider file, or one in another
    order, is read as well; a column that the header lacks is an error.  With
    ``na_tokens`` the pandas missing-value tokens (``NA``, ``null``, ``N/A``,
    ...) become null, as the reference's reader does.
    """
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).csv(path)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {missing}; the header has {df.columns}")
    df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    return with_na_tokens(df) if na_tokens else df


def with_na_tokens(df: DataFrame) -> DataFrame:
    cols = [na_tokens_to_null(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(*cols)


def raw_registry(spark: SparkSession, path_glob: str) -> DataFrame:
    """Raw files kept unchanged: path, size, modification time, bytes, format tag."""
    df = spark.read.format("binaryFile").load(path_glob)
    return df.select(
        "path", "length", "modificationTime", "content",
        F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("format"),
    )


# ------------------------------------------------------------- column forms

def parse_json_records(text, schema: T.StructType) -> Column:
    """JSON array text -> array<struct> under ``schema`` (A1 column form)."""
    return F.from_json(as_col(text), T.ArrayType(schema))


def parse_csv_line(line, schema: T.StructType) -> Column:
    """One CSV line -> struct under ``schema`` (A3 column form)."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(as_col(line), F.lit(ddl))


def raw_record_count(content, fmt) -> Column:
    """Best-effort record count of a raw text: JSON list length (1 for an
    object), CSV newlines - 1 floored at 0, null when JSON does not parse."""
    c, f = as_col(content), as_col(fmt)
    trimmed = F.ltrim(c)
    json_n = F.when(trimmed.startswith("["), F.json_array_length(c)) \
              .when(trimmed.startswith("{") & F.get_json_object(c, "$").isNotNull(), F.lit(1))
    csv_n = F.greatest(F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) - 1, F.lit(0))
    return F.when(f == "json", json_n).when(f == "csv", csv_n).cast("int")


# ----------------------------------------------------------- payload shapes

_PAYLOAD_SCHEMA = "struct<count: bigint, results: array<map<string, string>>>"


def payload_results(payload) -> Column:
    """The ``results`` of an API response text, each result a string map (so
    absent and explicit-null keys stay distinct)."""
    return F.from_json(as_col(payload), _PAYLOAD_SCHEMA)["results"]


def api_category(m: Column) -> Column:
    """The ``category`` of a result map, as a string map."""
    return F.from_json(m["category"], "map<string, string>")


def api_offer(m: Column, request_country: Column, category: Column | None = None) -> Column:
    """A9 for one result map: the bronze offer record (``category``: its ``api_category``, where that is a column already).

    ``country`` is taken from the request only when the key is *absent*;
    ``category.tag`` falls back to ``lower(category.label)`` (or '') only when
    the ``tag`` key is absent.
    """
    cat = api_category(m) if category is None else category
    tag = F.when(F.map_contains_key(cat, "tag"), cat["tag"]) \
           .otherwise(F.lower(F.coalesce(cat["label"], F.lit(""))))
    return F.struct(
        m["title"].alias("title"),
        F.from_json(m["company"], "display_name string").alias("company"),
        F.from_json(m["location"], "display_name string").alias("location"),
        m["salary_min"].cast("double").alias("salary_min"),
        m["salary_max"].cast("double").alias("salary_max"),
        F.struct(tag.alias("tag")).alias("category"),
        F.when(F.map_contains_key(m, "country"), m["country"]).otherwise(request_country).alias("country"),
        m["created"].alias("created"),
    )


def flatten_api_payload(pages: DataFrame, payload: str = "payload", request_country: str = "request_country") -> DataFrame:
    """Explode ``results`` of API responses into bronze offer records."""
    r = pages.select(F.col(request_country).alias("_rc"),
                     F.explode(payload_results(F.col(payload))).alias("m"))
    r = r.withColumn("_cat", api_category(F.col("m")))
    return r.select(api_offer(F.col("m"), F.col("_rc"), F.col("_cat")).alias("o")).select("o.*")


# FIXED PATTERNS of listing pages: anchors with their target, listing blocks, headings, paragraphs.
LINK_RE = r'(?s)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
BLOCK_RE = r"(?s)<article(?:\s[^>]*)?>(.*?)</article>"
HEAD2_RE, HEAD1_RE = r"(?s)<h2(?:\s[^>]*)?>(.*?)</h2>", r"(?s)<h1(?:\s[^>]*)?>(.*?)</h1>"
PARAGRAPH_RE = r"(?s)<p(?:\s[^>]*)?>(.*?)</p>"
COUNT_RE = r'(?s)<a\s[^>]*?href="[^"]*/stargazers"[^>]*>(.*?)</a>'
TAG_RE = r"(?s)<[^>]*>"


def tag_text(html) -> Column:
    """Text of a piece of HTML: without tags, without white space at its ends."""
    return F.regexp_replace(F.regexp_replace(as_col(html), TAG_RE, ""), r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def _first(html: Column, pattern: str) -> Column:
    """Text of the first match, or null."""
    return tag_text(F.try_element_at(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), F.lit(1)))


def html_links(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """A10: the links of raw pages, whatever other attributes or inner tags they have:
    position, target, text without spaces (the reference strips them)."""
    items = pages.select(
        key,
        F.arrays_zip(F.regexp_extract_all(F.col(html), F.lit(LINK_RE), F.lit(1)).alias("href"),
                     F.regexp_extract_all(F.col(html), F.lit(LINK_RE), F.lit(2)).alias("text")).alias("items"))
    return items.select(key, F.posexplode("items").alias("pos", "it")).select(
        key, F.col("pos").cast("int").alias("pos"), F.col("it.href").alias("href"),
        F.replace(tag_text("it.text"), F.lit(" "), F.lit("")).alias("label"))


def html_blocks(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """A10: the listing blocks (``article``) of raw pages: heading (second level before
    first), its link's text without spaces, first paragraph, star count ('0' where there is none)."""
    blocks = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(BLOCK_RE), F.lit(1))).alias("pos", "block"))
    extract = lambda p: F.try_element_at(F.regexp_extract_all(F.col("block"), F.lit(p), F.lit(1)), F.lit(1))
    blocks = blocks.withColumn("head", F.coalesce(extract(HEAD2_RE), extract(HEAD1_RE)))
    link = tag_text(F.try_element_at(F.regexp_extract_all(F.col("head"), F.lit(LINK_RE), F.lit(2)), F.lit(1)))
    return blocks.select(key, F.col("pos").cast("int").alias("pos"), tag_text("head").alias("title"),
                         F.replace(link, F.lit(" "), F.lit("")).alias("item"), _first(F.col("block"), PARAGRAPH_RE).alias("description"),
                         F.coalesce(_first(F.col("block"), COUNT_RE), F.lit("0")).alias("stars"))


def wide_to_long(df: DataFrame, ids: list[str], value_cols: list[str],
                 name_col: str = "keyword", value_col: str = "interest") -> DataFrame:
    """Wide interest table -> ``(ids..., keyword, interest)``; empty cells skipped."""
    long = df.unpivot(ids, value_cols, name_col, value_col)
    return long.where(F.col(value_col).isNotNull())
