"""2.L: the Column functions exposed to SQL as temporary SQL functions.

Each function body is the SQL text of the very same Catalyst expression the
DataFrame API uses (no Python UDF), so ``spark.sql`` users get identical
semantics and the optimiser still inlines and code-generates it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import country, dates, money, text

# name -> (function, argument type, return type)
SQL_FUNCTIONS = {
    "normalize_skill_label": (text.normalize_skill_label, "STRING", "STRING"),
    "normalize_currency": (money.normalize_currency, "STRING", "DOUBLE"),
    "map_country_iso2": (country.map_country_iso2, "STRING", "STRING"),
    "timestamp_to_date_coerce": (dates.timestamp_to_date_coerce, "STRING", "STRING"),
    "usd_prefix_amount": (money.usd_prefix_amount, "DOUBLE", "DOUBLE"),
    "fill_unknown_company": (text.fill_unknown_company, "STRING", "STRING"),
    "round2": (money.round2, "DOUBLE", "DOUBLE"),
}


def expression_sql(spark: SparkSession, fn, arg_type: str, arg: str = "x") -> str:
    """SQL text of ``fn(x)``, taken from Catalyst's analysed expression."""
    df = spark.range(0).select(F.lit(None).cast(arg_type).alias(arg)).select(fn(F.col(arg)).alias("_out"))
    alias = df._jdf.queryExecution().analyzed().expressions().head()
    return alias.child().sql()


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions in this session; returns their names."""
    for name, (fn, arg_type, ret_type) in SQL_FUNCTIONS.items():
        body = expression_sql(spark, fn, arg_type, "x")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x {arg_type}) RETURNS {ret_type} RETURN {body}")
    return list(SQL_FUNCTIONS)
