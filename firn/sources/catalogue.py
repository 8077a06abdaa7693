"""What a sink holds, and how it is stored to be read cheaply (J16, IO09, IO10, IO01, P10, J01, J14).

``publish_new`` publishes the partitions a sink does not have yet.  What it has is told by the names of its partition
folders, without opening a file, and by commit markers: a run writes its data first and then one small marker table
that names what is whole, so a partition that a lost run left half written has a folder but no marker.  It comes again, and
replaces what is there.  Attributes of rasters stand once, in a dimension table beside the data.

``join_on_partitions`` reads such a sink by a small table of keys; Spark prunes the partitions at run time.
``save_bucketed`` stores a table in buckets of its merge key, so that joins and aggregates on it need no shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firn.operators.publish import skip_published
from firn.sources.faults import folder_key, list_files
from firn.sources.textio import scratch_path, stored

# Names that begin like this are not read as data of the sink.
MARKERS, ATTRIBUTES = "_published", "_attributes"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def published(spark: SparkSession, path: str, keys: StructType) -> DataFrame:
    """``(keys..., run)`` of the partitions that are published whole: they have a folder and a marker."""
    schema = StructType([*keys.fields]).add("run", "string")
    if not _exists(spark, f"{path}/{MARKERS}"):
        return spark.createDataFrame([], schema)
    folders = list_files(spark, path).select(*[folder_key(F.col("file"), f.name, f.dataType).alias(f.name) for f in keys]).distinct()
    marks = spark.read.schema(schema).parquet(f"{path}/{MARKERS}")
    return marks.join(folders, [f.name for f in keys], "left_semi").groupBy(*[f.name for f in keys]).agg(F.max("run").alias("run"))


def write_partitions(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Writes partitions of a sink, in place of what their folders hold."""
    (rows.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


def publish_new(rows: DataFrame, path: str, keys: list[str], run: str, refresh_from: str | None = None,
                date_col: str = "date") -> DataFrame:
    """Publishes the partitions of ``rows`` that the sink does not hold whole; returns their keys (none if all are there).
    ``refresh_from`` publishes days on or after it again."""
    spark = rows.sparkSession
    types = StructType([rows.schema[k] for k in keys])
    todo = stored(skip_published(rows.select(*keys).distinct(), published(spark, path, types), keys, refresh_from, date_col), "to-publish")
    if not todo.head(1):
        return todo
    write_partitions(rows.join(todo, keys, "left_semi").select(*rows.columns), path, keys)
    todo.withColumn("run", F.lit(run)).coalesce(1).write.mode("append").parquet(f"{path}/{MARKERS}")
    return todo


def write_attributes(attributes: DataFrame, path: str) -> None:
    """The dimension table of a sink: attributes by variable, once instead of on every row."""
    attributes.write.mode("overwrite").parquet(f"{path}/{ATTRIBUTES}")


def read_published(spark: SparkSession, path: str, schema: str | StructType, keys: list[str]) -> DataFrame:
    """Rows of the partitions that are published whole, with the attributes of their variable where the sink has them."""
    rows = spark.read.schema(schema).parquet(path)
    whole = published(spark, path, StructType([rows.schema[k] for k in keys])).select(*keys)
    rows = rows.join(whole, keys, "left_semi")
    if _exists(spark, f"{path}/{ATTRIBUTES}"):
        rows = rows.join(spark.read.parquet(f"{path}/{ATTRIBUTES}"), "variable", "left")
    return rows


def join_on_partitions(spark: SparkSession, path: str, schema: str | StructType, wanted: DataFrame, on: list[str]) -> DataFrame:
    """Rows of a sink for the partitions that ``wanted`` names, a table that is read itself, such as a filtered calendar.  Where
    it is small the planner broadcasts it, and its keys prune the sink's folders before they are listed for reading."""
    return spark.read.schema(schema).parquet(path).join(wanted.select(*on).distinct(), on)


def save_bucketed(df: DataFrame, keys: list[str], buckets: int, name: str = "bucketed", sort: list[str] | None = None) -> DataFrame:
    """``df`` as a table in ``buckets`` buckets of ``keys``, each sorted by keys and ``sort``.  Tables of equal keys and numbers of
    buckets join without a shuffle; so do aggregates whose keys begin with these."""
    spark = df.sparkSession
    table = f"firn_{name}_{uuid.uuid4().hex}"
    # one file a bucket: the rows of a bucket come together before they are written
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys, *(sort or [])).format("parquet")
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    return spark.table(table)
