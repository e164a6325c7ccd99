"""Training-corpus pipeline over ``documents``: five stages, each one operator.

language ID -> quality rules -> n-gram Jaccard join -> substring dedup ->
best-fit packing. Every stage takes ``(spark, docs, sf_dir)``, works on all
rows that its predecessor kept and returns the columns of ``documents`` (the
last one the packed pieces). Its result is written as Parquet and read again
before the next stage, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.jaccard import deduplicate
from cartwheel.llm.langid import language_filter
from cartwheel.llm.packing import pack_documents
from cartwheel.llm.quality import quality_filter
from cartwheel.llm.substring import remove_repeats
from cartwheel.session import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return language_filter(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go."""
    return quality_filter(spark, docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays: the smallest doc_id."""
    return deduplicate(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur elsewhere go out of the texts."""
    return remove_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts that are left, packed into sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Compression, isolation forests and BPE are not expressible in SQL; the tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("errorifexists").parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
