"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..session import scratch_path

#: Fixed values of the contracts: ASCII white space and the ASCII letters that are folded.
ASCII_WS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with one computation; the files outlive any executor.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_path = path
    return out


def discard(*kept: DataFrame) -> None:
    """Remove what ``keep`` wrote; only for tables that nothing still to be computed reads."""
    for df in kept:
        storage.remove(df.sparkSession, df.kept_path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small driver-side list as a DataFrame made of literals (no Python RDD)."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in fields])
    made = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, fields, strict=True)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*made)))


def crc32_text(c: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes (null counts as empty)."""
    return F.crc32(F.encode(F.coalesce(c, F.lit("")), "UTF-8"))


def held_out(doc_id: Column) -> Column:
    """Rows kept away from learning: crc32(doc_id as text) mod 5 = 0 (null id: as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, as ``--py-files`` would, once per application."""
    sc = spark.sparkContext
    if any(os.path.basename(p).startswith("corpus-ops-") for p in sc._python_includes):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top, package = os.path.dirname(os.path.dirname(here)), os.path.basename(os.path.dirname(here))
    path = os.path.join(tempfile.mkdtemp(prefix="corpus-ops-"), f"corpus-ops-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, package)):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)


def map_arrow(df: DataFrame, f: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose function may use this package."""
    ship(df.sparkSession)
    return df.mapInArrow(f, schema)
