"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firn.session import ensure_checkpoint_dir

SPACE = r"\x20\x09-\x0D"  # what separates words, inside a character class


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage like ``checkpoint()`` and, as a table with a known
    size, lets the planner choose between a broadcast and a shuffle join.
    The files go when the driver ends.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder; it goes when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/firn-{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-space characters; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def fold(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n
