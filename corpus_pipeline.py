"""From raw documents to token ids: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's docs.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.llm.bpe import encode
from caderneta.llm.line_dedup import drop_repeated_lines
from caderneta.llm.mixing import mixed_documents
from caderneta.llm.near_duplicates import drop_near_duplicates
from caderneta.llm.quality_rules import keep_good
from caderneta.llm.tables import load, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed and the learned quality rules let through."""
    return keep_good(docs, load(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their source's target takes them."""
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row."""
    return encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]
# Similarity joins, learned rules and merges have no plain SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
