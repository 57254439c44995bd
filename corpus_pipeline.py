"""Corpus pipeline over ``documents``: filter, dedup, decontaminate and pack into training windows.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor and returns the
columns of documents; the last returns packed pieces. NULL and empty texts pass every stage that
does not score them as poor, and each becomes one piece with the end id alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import free_name, stored
from strata.llm.decontaminate import mark_contaminated
from strata.llm.line_dedup import dedup_lines, line_words
from strata.llm.minhash import drop_near_duplicates
from strata.llm.packing import pack, piece_digests
from strata.llm.quality import fit_quality, learnable, score_quality
from strata.llm.queries import table, vocabulary

#: Documents with a lower quality score are rejected.
QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is high enough; the model never sees the held-out labels."""
    model = fit_quality(docs, learnable(table(spark, sf_dir, "labels"), 4, 2))
    score = free_name(docs, "score")
    return score_quality(docs, model).where(F.col(score) >= QUALITY).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; whole copies, of which nothing is left, go.

    ``n_chars`` follows the text.
    """
    gone = free_name(docs, "n_deleted")
    out = dedup_lines(docs).where((F.col(gone) == 0) | (line_words(F.col("text")) > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, literally or re-parameterised."""
    flag = free_name(docs, "contaminated")
    return mark_contaminated(docs, table(spark, sf_dir, "benchmark")).where(~F.col(flag)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all kept documents in windows of 2048 ids."""
    return piece_digests(pack(docs, vocabulary("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: A trained classifier and a tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each result written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
