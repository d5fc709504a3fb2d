"""Plans over observations at size: generated methods stay compiled."""

from datetime import datetime

import pytest

from marketlake.session import COMPILED_METHOD_BYTES, keep_compiled
from marketlake.sources import adapter

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def tables(spark, root, orders=3):
    """Driver tables with seven lines for each order."""
    day = datetime(2001, 6, 15)
    rows = {
        "lineitem": ([(o, o % 2 + 1, o % 2 + 1, n, 40000.0 + 1000 * n) for o in range(1, orders + 1) for n in range(1, 8)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double"),
        "orders": ([(o, 1, day) for o in range(1, orders + 1)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "customer": ([(1, 0)], "c_custkey long, c_nationkey int"),
        "nation": ([(0,)], "n_nationkey int"),
        "part": ([(1, 3, "a", 9.0), (2, 4, "b", 8.0)], "p_partkey long, p_size int, p_name string, p_retailprice double"),
        "supplier": ([(1, "S1"), (2, "S2")], "s_suppkey long, s_name string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.fixture
def limit(spark):
    old = spark.conf.get(LIMIT)
    yield
    spark.conf.set(LIMIT, old)


def test_observations_keep_methods_compiled(spark, tmp_path, limit):
    sf = tables(spark, tmp_path)
    spark.conf.set(LIMIT, "65535")
    assert adapter.observations(spark, sf).count() == 21
    assert int(spark.conf.get(LIMIT)) == COMPILED_METHOD_BYTES


def test_a_lower_limit_stays(spark, limit):
    spark.conf.set(LIMIT, "4000")
    keep_compiled(spark)
    assert spark.conf.get(LIMIT) == "4000"


def test_json_files_are_read_about_once(spark, tmp_path):
    from marketlake.sources import readers
    records = [f'{{"title":"t{i}","salary_min":{i}.25,"salary_max":{i}.5}}' for i in range(4000)]
    file = tmp_path / "a.json"
    file.write_text("[" + ",\n".join(records) + "]")
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics
    before = sum(s.getBytesRead() for s in stats())
    good, bad = readers.read_json_checked(spark, str(file), readers.OFFER_SCHEMA)
    assert sum(s.getBytesRead() for s in stats()) - before < 4 * file.stat().st_size
    assert good.count() == 4000 and bad.count() == 0
    assert good.agg({"salary_max": "sum"}).first()[0] == sum(range(4000)) + 2000


@pytest.mark.parametrize("name, scans", [("distinct_keys", 1), ("watermark_state", 0), ("upsert_ignore", 0), ("dq_unique_grain", 0), ("micro_batch_day", 1)])
def test_observations_are_scanned_once(spark, tmp_path, name, scans):
    """Parts of a result that need the same parsed rows read them stored: the result's own plan scans the lines at most once."""
    from marketlake.plans import catalog_gold  # noqa: F401
    from marketlake.plans.catalog import QUERIES
    result = QUERIES[name](spark, tables(spark, tmp_path))
    leaves = result._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert sum("l_orderkey" in leaves.apply(i).toString() for i in range(leaves.size())) == scans
    assert result.count() > 0


def test_rows_are_parsed_after_the_generator(spark, tmp_path, limit):
    """What a generator or an array lambda computes is interpreted for each row: the generator of all sources only puts items out."""
    from marketlake.sources import registry
    obs = adapter.observations(spark, tables(spark, tmp_path))
    rows = registry.silver_all(obs)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    emits = [line for line in plan.splitlines() if "Generate inline" in line]
    assert len(emits) == 1 and not any(f in emits[0].lower() for f in ("from_json", "rlike", "regexp", "cast("))
    assert plan.count("from_json(StructField(results") == 1  # no filter inferred that parses again
    assert "Lieu" not in plan and rows.count() == 3 * (1 + 2 + 2 + 2 * 2)


def test_odd_api_payloads_keep_their_rows(spark):
    """Null and empty results, and null offers among them, with several sources in one frame."""
    from pyspark.sql import functions as F
    from marketlake.operators import cleaners
    texts = [("a", '{"results":[{"salary_min":1,"salary_max":3,"category":{"label":"X Y"}},null]}'), ("a", '{"results":[]}'),
             ("a", '{"results":null}'), ("a", "x"), ("a", None), ("b", None), (None, None), ("c", None)]
    df = spark.createDataFrame([(s, "fr", p) for s, p in texts], "src string, request_country string, payload string")
    df, items, finish = cleaners.parse_api_pages(df, {c: F.col(c) for c in df.columns}, "a")
    single = lambda df, _: (df, {"source": F.lit("b"), "skill": F.lit("s")})
    rows = cleaners.finish_rows(cleaners.emit_rows(df, {"a": (items, finish), "b": (None, single)}, F.col("src"))).collect()
    got = sorted((r["source"], str(r["country_iso2"]), str(r["skill"]), str(r["salary_eur"])) for r in rows)
    assert got == [("a", "FR", "None", "None"), ("a", "FR", "x_y", "2.0"), ("b", "None", "s", "None")]


def test_tasks_follow_the_lines(spark, tmp_path, limit, monkeypatch):
    """Rendering and parsing are dealt to tasks by rows: few bytes of them are much work."""
    monkeypatch.setattr(adapter, "TASK_LINES", 2)
    obs = adapter.observations(spark, tables(spark, tmp_path, orders=40))
    assert obs.rdd.getNumPartitions() == 40 * 7 // 2 + 1 and obs.count() == 280


def test_sources_share_the_columns_of_their_records(spark):
    import re
    from marketlake.sources import registry
    rows = [(5 * i + 1, i, s, "2001-03-01", "GB", "United Kingdom", "Go", "SQL", "Supplier#1", 41234.5)
            for i, s in enumerate(["adzuna", "indeed", "glassdoor", "so_survey", None])]
    obs = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, src string, date_posted string, iso2 string, country_name string, "
                                      "skill_label string, skill2_label string, s_name string, price double")
    out = registry.silver_all(obs)
    held = set(re.findall(r"_b_\w+", out._jdf.queryExecution().optimizedPlan().toString()))
    assert 0 < len(held) <= 5  # fourteen when every source had its own
    whole = sorted(map(str, out.collect()))
    assert whole == sorted(str(r) for s in registry.REGISTRY for r in registry.silver_source(obs, s.name).collect())
    assert len(whole) == 5 and sum("so_survey" in r for r in whole) == 2
