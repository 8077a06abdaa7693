"""Whitespace text point files (IO03 source, IO04 sink) and scratch paths."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firn.functions.names import cluster_from_name
from firn.session import ensure_checkpoint_dir


# How a missing value is written.
MISSING = "nan"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a
    machine-local temp folder on a cluster), removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/firn-io-{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of what runs inside are deleted when it ends, not when the driver's memory is next collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, kept in the shared scratch folder and read from there: what several branches of a plan
    need is not computed for each, and the planner knows its size.  Survives lost executors.  The shuffles that computed it
    are of no more use then and leave the disk at once."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_point_text(df: DataFrame, path: str, point_col: str, time_col: str,
                     variables: list[str]) -> None:
    """One space-delimited file set per point, columns year month day hour
    then the variables, no header; the helper column is dropped (IO04).
    A NULL is written as ``nan``, so every line has all columns.
    Written to a new path: Spark must not overwrite what it reads."""
    t = F.col(time_col)
    line = F.concat_ws(" ", F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                       *[F.coalesce(F.col(v).cast("string"), F.lit(MISSING)) for v in variables])
    # rebalanced on the point: a task writes into its own point folders instead of all of them, without a sampling pass
    # that computes the rows twice, and adaptive execution splits a very long point series over several tasks (several
    # part files in its folder)
    (df.select(point_col, line.alias("value")).hint("rebalance", point_col)
     .write.partitionBy(point_col).text(path))


def read_point_text(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """Parse whitespace text into (cluster, time, variables...) (IO03); the
    cluster id comes from the file path (``..._pt_<id>``); ``nan`` is NULL."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    f = F.split(F.trim(F.col("value")), r"\s+")
    num = lambda i: f.getItem(i).cast("int")
    return raw.select(
        cluster_from_name(F.regexp_extract(F.col("_metadata.file_path"), r"(_pt_\d+)", 1)).alias("cluster"),
        F.make_timestamp_ntz(num(0), num(1), num(2), num(3), F.lit(0), F.lit(0)).alias("time"),
        *[F.when(F.lower(f.getItem(4 + i)) != MISSING, f.getItem(4 + i).cast("double")).alias(v) for i, v in enumerate(variables)])
