"""Corpus pipeline: language, near-duplicates, decontamination, mixing, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents.  All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firn.llm import decontaminate, language_id, mixing, near_dedup, sharding
from firn.llm.common import stored
from firn.sources.tables import read_table

ORACLE_SQL = None  # signatures and profiles are beyond SQL; tests/llm has a plain version


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the labelled rows teach; others go."""
    return language_id.accepted_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least id."""
    return near_dedup.distinct_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixing.mixed_documents(docs)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard (of 8) and slot."""
    return sharding.sharded_documents(docs, 8)


STAGES = [("language_id", keep_known_languages), ("near_dedup", drop_near_duplicates),
          ("decontaminate", drop_contaminated), ("mix", mix_sources), ("shard", cut_shards)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
