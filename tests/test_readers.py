"""Bronze readers on files written to a scratch folder."""

import json

import pytest
from pyspark.sql import functions as F

from marketlake.session import scratch_path
from marketlake.sources import readers


def _write(spark, name, content: bytes) -> str:
    import os
    d = scratch_path(spark, "test-readers")
    local = d[len("file:"):] if d.startswith("file:") else d  # tests run on a local folder
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/{name}", "wb") as fh:
        fh.write(content)
    return f"{d}/{name}"


def test_json_array_and_struct_field_or_null(spark):
    recs = [{"title": "Python Developer", "company": {"display_name": "ACME"}, "salary_min": 1, "salary_max": 3,
             "category": {"tag": "python"}, "country": "fr", "created": "2026-06-01T09:00:00Z"},
            {"title": "x", "company": "not an object", "category": {"tag": "go"}, "created": "bad"}]
    p = _write(spark, "offers.json", json.dumps(recs, indent=2).encode())
    df = readers.read_json_array(spark, p, readers.OFFER_SCHEMA)
    rows = df.select("company.display_name", "category.tag").collect()
    assert [tuple(r) for r in rows] == [("ACME", "python"), (None, "go")]


def test_csv_headers_and_na_tokens(spark):
    text = "Intitulé,Entreprise,Lieu,Salaire annoncé,Requête,Zone,Date\n" \
           "Dev,NA,\"Paris, France\",€40k,Python,France,2026-06-01\nDev,null,Lyon,N/A,Go,France,2026-06-02\n"
    p = _write(spark, "board.csv", text.encode())
    df = readers.read_csv(spark, p, readers.BOARD_SCHEMA)
    rows = df.select("Entreprise", "Lieu", "`Salaire annoncé`").collect()
    assert [tuple(r) for r in rows] == [(None, "Paris, France", "€40k"), (None, "Lyon", None)]


def test_csv_columns_are_found_by_header(spark):
    names = ["Id", "Age", "LanguageHaveWorkedWith", "Remote", "Country", "Years", "ConvertedCompYearly", "Org", "Ed", "Note"]
    rows = ["1,30,Python;Go,yes,France,3,1000,a,b,c", "2,31,,no,Spain,4,NA,a,b,\"x, y\""]
    p = _write(spark, "survey.csv", ("\n".join([",".join(names), *rows]) + "\n").encode())
    df = readers.read_csv(spark, p, readers.SURVEY_SCHEMA)
    assert df.columns == readers.SURVEY_SCHEMA.names
    assert [tuple(r) for r in df.collect()] == [("France", "1000", "Python;Go"), ("Spain", None, None)]
    with pytest.raises(ValueError, match="no column"):
        readers.read_csv(spark, p, readers.BOARD_SCHEMA)


def test_raw_registry_and_counts(spark):
    p = _write(spark, "raw.json", b"[1, 2, 3]")
    r = readers.raw_registry(spark, p).select("length", "format",
                                              readers.raw_record_count(F.col("content").cast("string"),
                                                                       F.col("format")).alias("n")).first()
    assert (r["length"], r["format"], r["n"]) == (9, "json", 3)
    df = spark.createDataFrame([("a,b\n1,2\n3,4\n", "csv"), ("{\"a\": 1}", "json"), ("[oops", "json")],
                               "c string, f string")
    assert [r[0] for r in df.select(readers.raw_record_count("c", "f")).collect()] == [2, 1, None]


def test_payload_absent_vs_null_keys(spark):
    payload = json.dumps({"results": [
        {"title": "a", "category": {"label": "Python"}},
        {"title": "b", "country": None, "category": {"tag": None}},
        {"title": "c", "country": "gb", "category": {}}]})
    df = spark.createDataFrame([("fr", payload)], "request_country string, payload string")
    r = readers.flatten_api_payload(df).select("title", "country", "category.tag").collect()
    assert [tuple(x) for x in r] == [("a", "fr", "python"), ("b", None, None), ("c", "gb", "")]


def test_html_links_and_wide_to_long(spark):
    html = '<ul><li><a href="/a">New York</a></li><li><a href="/b">b</a></li></ul>'
    r = readers.html_links(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()
    assert [(x["pos"], x["href"], x["label"]) for x in r] == [(0, "/a", "NewYork"), (1, "/b", "b")]
    wide = spark.createDataFrame([("2026-06-01", "FR", 3, None)], "date string, country string, Python int, Go int")
    long = readers.wide_to_long(wide, ["date", "country"], ["Python", "Go"]).collect()
    assert [(x["keyword"], x["interest"]) for x in long] == [("Python", 3)]


def test_listing_blocks(spark):
    html = """<nav><a class="x" href="/a"> one <b>two</b></a></nav>
<article class="Box-row"><h2 class="t"><a data-x="1" href="/own/repo"> own / <span>repo</span> </a></h2><p> A <i>fine</i> thing </p>
<a href="/own/repo/stargazers"> 1,234 </a></article><article><h1>Plain</h1></article><articles>no</articles>"""
    df = spark.createDataFrame([(1, html), (2, None), (3, "<p>x</p>")], "page_id int, html string")
    assert [tuple(r) for r in readers.html_blocks(df).orderBy("pos").collect()] == [
        (1, 0, "own / repo", "own/repo", "A fine thing", "1,234"), (1, 1, "Plain", None, None, "0")]
    assert [tuple(r)[2:] for r in readers.html_links(df).orderBy("pos").collect()] == [
        ("/a", "onetwo"), ("/own/repo", "own/repo"), ("/own/repo/stargazers", "1,234")]


def test_raw_registry_of_the_tables(spark):
    import os

    from conftest import SF_SMALL
    from marketlake.plans.catalog import QUERIES
    got = {r["file"]: (r["length"], r["format"]) for r in QUERIES["raw_registry"](spark, SF_SMALL).collect()}
    assert got == {f: (os.path.getsize(f"{SF_SMALL}/{f}"), "parquet") for f in os.listdir(SF_SMALL) if f.endswith(".parquet")}


def test_raw_counts_and_casts_cover_every_source(spark):
    import __spark_entry__ as entry
    from marketlake import config
    from marketlake.plans import medallion as md

    q = entry.queries()
    obs = {r["src"]: r["count"] for r in md.observations(spark, "/root/testdata/sf0.001").groupBy("src").count().collect()}
    counted = {r["source"]: r["n"] for r in q["raw_record_count"](spark, "/root/testdata/sf0.001").groupBy("source").agg({"records": "sum"}).withColumnRenamed("sum(records)", "n").collect()}
    assert counted == obs and set(obs) == set(config.SALARY_SOURCES)
    rows = {(r["source"], r["column"]): r["failures"] for r in q["dq_coerce"](spark, "/root/testdata/sf0.001").collect()}
    assert {s for s, _ in rows} == set(config.SALARY_SOURCES) and len(rows) == 25
    assert rows["indeed", "Zone"] == obs["indeed"] and rows["glassdoor", "date_posted"] == 0


def test_json_files_keep_damaged_records_apart(spark, tmp_path):
    from marketlake.sources import readers
    (tmp_path / "a.json").write_text('[{"title": "a", "salary_min": 1.5, "category": {"tag": "x"}},\n {"title": "b", "salary_min": "n/a", "salary_max": 2}]')
    (tmp_path / "b.json").write_text('[{"title": "c"}')
    (tmp_path / "c.json").write_text("[]")
    good, bad = readers.read_json_checked(spark, str(tmp_path), readers.OFFER_SCHEMA)
    assert good.schema == readers.OFFER_SCHEMA
    assert {(r["title"], r["salary_min"], r["category"] and r["category"]["tag"]) for r in good.collect()} >= {("a", 1.5, "x")}
    held = {tuple(r["fields"]): r for r in bad.collect()}
    assert held["salary_min",]["rest"]["title"] == "b" and held["salary_min",]["rest"]["salary_max"] == 2.0 and '"n/a"' in held["salary_min",]["record"]
    assert '"c"' in held[()]["record"] and len(held) == 2


def test_csv_files_keep_damaged_records_apart(spark, tmp_path):
    from marketlake.sources import readers
    (tmp_path / "a.csv").write_text('x,y,z\n1,"two ""quoted""\nlines",3\n4,NA,6\n7,8\n9,10,11,12\n')
    good, bad = readers.read_csv_checked(spark, str(tmp_path), readers.string_schema(["z", "y"]))
    assert sorted(map(tuple, good.collect()), key=str) == [("3", 'two "quoted"\nlines'), ("6", None)]
    assert sorted(r["record"] for r in bad.collect()) == ["7,8", "9,10,11,12"]
    assert readers.read_csv(spark, str(tmp_path), readers.string_schema(["y"])).first()["y"] == 'two "quoted"\nlines'
    with pytest.raises(ValueError, match="no column"):
        readers.read_csv_checked(spark, str(tmp_path), readers.string_schema(["nope"]))
