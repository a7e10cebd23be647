"""A corpus pipeline of five stages, each one operator of ``gridloom.llm``.

Each stage gets all rows that the one before it kept and passes on rows with the columns of ``documents``; the
last one adds each row's shard and place to them.  Rows without a doc_id are judged by their texts and stay if clean.  A stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.decontaminate import decontaminated
from gridloom.llm.langid import spoken
from gridloom.llm.mixing import mixed
from gridloom.llm.nearcopies import deduplicated
from gridloom.llm.sharding import sharded
from gridloom.tables import settle


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go."""
    return spoken(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the least doc_id."""
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix to target weights takes them."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard and its place there."""
    return sharded(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: The near-duplicate components, the knapsack and label propagation have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
