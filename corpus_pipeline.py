"""The training-data pipeline: five stages over ``documents``, each written and read again.

Every stage works on all rows its predecessor kept and returns the columns of
``documents``; the last returns one row per copy that the mix takes.  Between
stages the rows are Parquet under the folder that ``spark.checkpoint.dir``
names, so a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hearth.llm import decontaminate, langid, line_dedup, mixing, ngram_join
from hearth.llm.common import table
from hearth.session import ensure_checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return langid.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, or are one word edit away from one, go."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaks go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks."""
    return mixing.take(docs)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix)]

# The trained network, the chosen paths and the tiling have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
