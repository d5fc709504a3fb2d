"""A training-data pipeline over ``documents``, one operator after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes a
stage's result as Parquet below the shared checkpoint folder and reads it again
as the next one's ``docs``.  All stages but the last return the columns of
``documents``; n_chars follows a changed text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import line_dedup, nbest_pieces, part_join, quality_qda, tiling
from marketlake.llm.catalog import piece_model
from marketlake.llm.common import held_out, keep


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant scores below 0.3 go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_qda.fit(docs.select("doc_id", "text"), labels, ~held_out(F.col("doc_id")))
    # the row travels whole beside its text, so no column of a user's can clash with the score's
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return quality_qda.score(rows, model).filter(F.col(quality_qda.SCORE) >= 0.3).select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more are dropped from all of them."""
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    out = line_dedup.dedup_lines(rows, min_docs=10, min_chars=1)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, length).otherwise(F.col("whole.n_chars"))}
    return out.select(*[new.get(c, F.col(f"whole.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, similarity 0.8)."""
    return part_join.one_of_each(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, in whatever order its passages come, go."""
    return tiling.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the pieces of their best segmentation, the N-best scores and the round trip."""
    out = nbest_pieces.encode(docs, piece_model(spark), n_best=4)
    return out.withColumn("n_pieces", F.size("piece_ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_qda", quality),
    ("line_dedup_runs", line_dedup_stage),
    ("partition_jaccard", near_dedup),
    ("greedy_string_tiling", decontaminate),
    ("nbest_sentencepiece", encode),
]

#: The discriminant and the lattice search are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
