"""Driver tables: one parquet file per table under an ``sf`` folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one table as it stands now; naming the columns keeps the parquet ReadSchema pruned."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df
