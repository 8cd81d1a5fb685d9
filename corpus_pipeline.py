"""Corpus pipeline: quality rules, near-duplicate removal, sanitisation, mixing and tokenisation, one after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import mixing, near, pieces, private, quality
from postmill.llm.common import cut, cut_table, drop_table, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    docs = docs.select(*COLUMNS)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).where("kept").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least id; shingles have five words.

    Rows alike in doc_id are one document, and the least of them stays. Rows without an id are kept.
    """
    docs = docs.select(*COLUMNS)
    found = near.near_duplicates(docs, shingle=5).groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("rows"))
    touched = cut(found.where("doc_id IS NOT NULL AND (NOT kept OR rows > 1)"))
    rest = [c for c in COLUMNS if c != "doc_id"]
    repeated = docs.join(touched.where("kept").select("doc_id"), "doc_id").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row"))
    once = docs.join(touched.select("doc_id"), "doc_id", "left_anti")
    return once.select(*COLUMNS).unionByName(repeated.select("doc_id", "row.*").select(*COLUMNS))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced; n_chars follows."""
    clean = private.sanitise(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated so that the sources' words come to their targets."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids; what decodes to another text than its own is marked."""
    return pieces.encode_texts(docs.select(*COLUMNS), pieces.PieceModel.load()).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("private_data", private_stage),
    ("source_mix", mixing_stage),
    ("sentencepiece", token_stage),
]

#: SQL can express neither the model nor the rounding; tests compare each stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each stage's result is written and read again before the next, and then removed."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        kept = cut_table(stage(spark, docs, sf_dir))
        if k:
            drop_table(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
