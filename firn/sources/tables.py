"""Readers for the driver tables (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()

# Schemas already read from parquet footers, per session and path: later
# reads pass them in and skip footer inference.
_SCHEMAS: dict[tuple[str, str], object] = {}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    path = table_path(sf_dir, name)
    key = (spark.sparkContext.applicationId, path)
    schema = _SCHEMAS.get(key)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    _SCHEMAS[key] = df.schema
    return df


class Tables:
    """Attribute access to the driver tables of one scale-factor folder.
    Each table is resolved once per instance, so a plan that uses a table
    twice (nation, region) reads one relation."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.sf_dir, name)
        return self._frames[name]
