"""The corpus pipeline: stages over `documents`, each written as Parquet and reread by the next.

A stage takes (spark, docs, sf_dir). All but the last return the columns of documents; the last
returns the training order of what was kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import decontaminate, language_id, line_dedup, mixing, near_dedup, tables


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, whose language is not clear or is none of the learned ones, go.

    Null and empty texts go, and so do all documents if none has a language to learn from. Equal rows fare alike.
    """
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated in many distinct texts go, but for their first; n_chars is that of the new text.

    Near copies are left whole for the next stage. A document left without a word goes; null and empty ones stay.
    Rows are told apart by id and text, so rows that share an id, or have none, lose no lines of each other.
    """
    return line_dedup.drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by five-word shingles and a similarity of 0.8, stays.

    It is that of the least id, nulls last; of repeated rows one stays. Documents without a word stay.
    """
    return near_dedup.one_of_each(docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go; null and empty ones hold none."""
    return decontaminate.drop_leaks(docs, tables.read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order; every document is in it."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontaminate", decontaminate_documents),
    ("mixing", mix_sources),
]

#: Naive Bayes over hashed n-grams and minima of shingle hashes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents; what each returns is written under the shared checkpoint folder."""
    top = f"{tables.checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
    return docs
