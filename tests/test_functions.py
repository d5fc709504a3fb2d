"""Edge tables for the scalar functions (B1-B21), as in the reference's unit tests."""

import math

import pytest
from pyspark.sql import functions as F

from marketlake import functions as M
from marketlake.functions.money import with_normalized_currency, with_salary_range


def _one(spark, values, fn, type_="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(fn("x")).collect()]


CURRENCY = [("€40k", 40000.0), ("$50,000", 46000.0), ("GBP60k", 70200.0), ("non communiqué", None),
            (None, None), ("45 000", 45000.0), ("40.5k", 40.5), ("40kGBP", 40000.0),
            ("environ 40k", 40000.0), ("45,5k", 455000.0), ("40k-60k", 4000060000.0),
            ("45 000", 45000.0), ("£1.5k", 1.76), ("JPY1000000", 6700.0), ("5.", 5.0), (".", None)]


def test_normalize_currency_column(spark):
    got = _one(spark, [c[0] for c in CURRENCY], M.normalize_currency)
    assert got == [c[1] for c in CURRENCY]


def test_normalize_currency_staged_equals_column(spark):
    df = spark.createDataFrame([(c[0],) for c in CURRENCY], "x string")
    got = [r["v"] for r in with_normalized_currency(df, "x", "v").collect()]
    assert got == [c[1] for c in CURRENCY]


RANGES = [("40k–60k€", (40000.0, 60000.0)), ("50000-70000", (50000.0, 70000.0)), (None, (None, None)),
          ("-50000", (50000.0, 50000.0)), ("60k-40k", (60000.0, 40000.0)), ("40,000-60,000", (None, None)),
          ("1-2-3", (None, None)), ("40\u00a0k€–60\u00a0k€", (40000.0, 60000.0)), ("40000\u00a0–\u00a060000", (40000.0, 60000.0)),
          ("+40k", (40000.0, 40000.0)), ("1e3–2e3", (1000.0, 2000.0)), ("50K", (50000.0, 50000.0)), ("1d", (None, None)), ("k", (None, None))]


def test_parse_salary_range(spark):
    got = _one(spark, [r[0] for r in RANGES], M.parse_salary_range)
    assert [(g["min"], g["max"]) for g in got] == [r[1] for r in RANGES]


def test_parse_salary_range_staged(spark):
    df = spark.createDataFrame([(r[0],) for r in RANGES], "x string")
    got = [(r["lo"], r["hi"]) for r in with_salary_range(df, "x", "lo", "hi").collect()]
    assert got == [r[1] for r in RANGES]


def test_normalize_skill_label(spark):
    vals = ["Node.js", "Python/C++", "  AWS ", "+++", None, "C#", "C", "Brand#23"]
    assert _one(spark, vals, M.normalize_skill_label) == ["node_js", "python_c", "aws", None, None, "c", "c",
                                                          "brand_23"]


COUNTRIES = [("France", "FR"), ("us", "US"), ("DEU", "DE"), (None, None), ("", None), ("  gbr ", "GB"), ("x", None),
             ("Belgium", "BE"), ("Poland", "PL"), ("IN", "IN"), ("AL", "AL"), ("AD", "AD"), ("AN", None), ("GE", "GE"), ("NE", "NE"), ("LA", "LA"),
             ("AND", "AD"), ("POL", "PL"), ("pl", "PL"), ("QQ", None), ("ZZZ", None), ("\u00a0FR\t", "FR"), ("\u2003India\n", "IN"),
             ("United States of America", "US"), ("Viet Nam", "VN"), ("Cote d'Ivoire", "CI"), ("Côte d’Ivoire", "CI"), ("Türkiye", "TR"),
             ("Bosnia and Herzegovina", "BA"), ("states", "US"), ("Kingdom", "GB"), ("NETH", None), ("Herzegovina", "BA"), ("land", None), ("a|b c", None)]


def test_map_country_iso2(spark):
    assert _one(spark, [c[0] for c in COUNTRIES], M.map_country_iso2) == [c[1] for c in COUNTRIES]


def test_every_code_of_the_country_table(spark):
    from marketlake.functions import iso3166
    rows = iso3166.table()
    assert len(rows) > 240
    for i in range(3):
        assert _one(spark, [r[i] for r in rows], M.map_country_iso2) == [r[0] for r in rows]


def test_alias_table_gives_the_same(spark):
    from marketlake.functions.country import alias_rows
    known = [c for c in COUNTRIES if c[0] not in ("states", "Kingdom", "Herzegovina")]  # a table has no search
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(known)], "i int, x string")
    aliases = spark.createDataFrame(alias_rows(), "alias_upper string, iso2 string, rank int")
    got = M.resolve_with_table(df, "x", aliases).orderBy("i").collect()
    assert [r["country_iso2"] for r in got] == [c[1] for c in known]


def test_ranked_search_of_distinct_texts(spark):
    from marketlake.plans import catalog  # noqa: F401 - registers the queries
    from marketlake.plans.catalog_sources import PINNED_COUNTRIES
    cases = [*PINNED_COUNTRIES, *[c for c in COUNTRIES if c[0] not in ("land", "NETH")], ("Netherland", "NL")] * 2
    df = spark.createDataFrame([(i, c[0], "clash") for i, c in enumerate(cases)], "i int, x string, iso2 string")
    got = M.resolve_countries(df, "x").orderBy("i").collect()
    assert [(r["x"], r["country_iso2"]) for r in got] == cases
    assert M.resolve_countries(df.limit(0), "x").collect() == []


def test_perfect_hash_holds_every_alias():
    from marketlake.functions import country, iso3166
    shifts, names, codes = country.perfect_hash()
    exact = iso3166.exact()
    assert sorted(n for n in names if n) == sorted(exact)
    assert all(codes[names.index(a)] == c for a, c in exact.items())


def test_no_numeric_cap(spark):
    from pyspark.errors import PySparkException
    from marketlake.functions.money import cents
    vals = [1e20, -3e17, 1e13 + 0.005, 2.345, None]
    assert _one(spark, vals, M.round2, "double") == [1e20, -3e17, 1e13 + 0.01, 2.35, None]
    assert math.isnan(_one(spark, [float("nan")], M.round2, "double")[0])
    assert _one(spark, ["€" + "9" * 20], M.normalize_currency) == [1e20]
    with pytest.raises(PySparkException):
        _one(spark, [1e20], cents, "double")


def test_survey_amounts(spark):
    vals = ["1000", "1,234", "abc", "", None, "-500", "1e3", "40k", " 50 "]
    assert _one(spark, vals, M.usd_prefix_amount) == [920.0, 1135.28, None, None, None, 460.0, 920.0, 36800.0, 46.0]


def test_timestamp_to_date_coerce_is_zone_independent(spark):
    vals = ["2026-06-01T09:00:00Z", "bad", "2026-06-01", None, "2026-06-01T23:30:00-02:00"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert _one(spark, vals, M.timestamp_to_date_coerce) == ["2026-06-01", None, "2026-06-01", None,
                                                                      "2026-06-02"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_means_and_midpoints(spark):
    df = spark.createDataFrame([(10.0, 20.0), (10.0, None), (None, None), (1.0, 2.0)], "lo double, hi double")
    r = df.select(M.row_mean_skipna("lo", "hi").alias("a"), M.range_midpoint_strict("lo", "hi").alias("b")).collect()
    assert [x["a"] for x in r] == [15.0, 10.0, None, 1.5]
    assert [x["b"] for x in r] == [15.0, None, None, 1.5]


def test_rounding_is_half_up_and_engine_neutral(spark):
    vals = [1.005, 2.675, 0.125, 12345.675, 2.5, -1.0]
    got = _one(spark, vals, M.round2, "double")
    assert got == [math.floor(v * 100 + 0.5) / 100 for v in vals]


def test_ints_and_fills(spark):
    assert _one(spark, ["12,345", "7"], M.thousands_int) == [12345, 7]
    assert _one(spark, [None, 3], M.fill_zero_int, "bigint") == [0, 3]
    assert _one(spark, [None, "", "ACME"], M.fill_unknown_company) == ["Unknown", "Unknown", "ACME"]
    assert _one(spark, [12345.0, -100.0, None], M.usd_prefix_amount, "double") == [11357.4, 92.0, None]


def test_nan_to_null_and_na_tokens(spark):
    assert _one(spark, [float("nan"), 1.0, None], M.nan_to_null, "double") == [None, 1.0, None]
    assert _one(spark, ["NA", "null", "N/A", "", "Namibia", None], M.na_tokens_to_null) == [
        None, None, None, None, "Namibia", None]


def test_indicator_keys_and_case_folds(spark):
    df = spark.createDataFrame([("FR", "python")], "c string, s string")
    r = df.select(M.indicator_pk("c"), M.indicator_sk("s")).first()
    assert tuple(r) == ("country#FR", "skill#python")
    assert M.fold_country("fr") == "FR" and M.fold_lower("PyThOn") == "python" and M.fold_lower("") == ""


def test_to_decimal(spark):
    r = spark.createDataFrame([(1.005,), (55000.0,)], "x double").select(
        M.to_decimal_12_2("x").cast("string").alias("d")).collect()
    # 1.005 is 1.00499... in binary: half-up on the stored value gives 1.00
    assert [x["d"] for x in r] == ["1.00", "55000.00"]


def test_split_skill_list(spark):
    df = spark.createDataFrame([("Python;;C++;+++;python",), (None,)], "x string")
    r = df.select(F.explode(M.split_skill_list("x")).alias("s")).where("s is not null").collect()
    assert [x["s"] for x in r] == ["python", "c", "python"]


def test_sql_functions_match_column_functions(spark):
    from marketlake.functions.sql import register_sql_functions
    register_sql_functions(spark)
    r = spark.sql("select normalize_skill_label('Python/C++') a, normalize_currency('GBP60k') b, "
                  "map_country_iso2(' united kingdom') c, timestamp_to_date_coerce('2026-06-01T09:00:00Z') d, "
                  "usd_prefix_amount(12345.0) e, fill_unknown_company('') f, round2(2.675) g").first()
    assert tuple(r) == ("python_c", 70200.0, "GB", "2026-06-01", 11357.4, "Unknown", 2.68)


def test_trimmed_salary_parsers_on_odd_texts(spark):
    texts = ["1.2.3", ".", "", None, "GBP60k", "usd 5K", "40.5k", "k", "€", "12.", "~7", "Ab9", "45 000", "1,5k0"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(M.normalize_currency("t")).collect()]
    assert [g is None for g in got] == [t in ("1.2.3", ".", "", None, "€") for t in texts]
    assert got[6] == 40.5 and got[9] == 12.0 and got[10] == 7.0 and got[11] == 9.0 and got[12] == 45000.0 and got[13] == 150.0
    ranges = [("$40K–60k€", (40000.0, 60000.0)), ("40kk-5", (5.0, 5.0)), ("k", (None, None)), ("7K", (None, None)), ("", (None, None)), (None, (None, None))]
    for text, want in ranges:
        assert tuple(spark.range(1).select(M.parse_salary_range(F.lit(text).cast("string")).alias("r")).first()["r"]) == want
    labels = [("Node.js", "node_js"), ("go", "go"), ("_", None), ("", None), (None, None), ("C#", "c"), ("É", None)]
    for text, want in labels:
        assert spark.range(1).select(M.normalize_skill_label(F.lit(text).cast("string"))).first()[0] == want
