"""Reading folders in which some files are damaged.

One bad file must not end the job, nor may its rows slip out of a result unseen.  Files are listed without their
content, read with corrupt ones tolerated, and compared: a file from which nothing came, or fewer rows than its footer
says, spoils its unit (the partition folder, which stands for one file of the operational chain).  What is
wrong with a unit is a row of the error table; its rows are left out as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Reasons in the error table.
NO_ROWS, CUT = "no rows", "cut off"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, bytes)`` of every file under ``path``; no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")))


def folder_key(file: Column, name: str, dtype) -> Column:
    """The value of partition column ``name`` in a file's path, NULL for Spark's folder of NULLs."""
    text = F.regexp_extract(file, f"/{name}=([^/]*)/", 1)
    return F.when(~text.isin("", "__HIVE_DEFAULT_PARTITION__"), text).cast(dtype)


def read_tolerant(spark: SparkSession, path: str, schema: str | StructType, fmt: str = "parquet") -> DataFrame:
    """Rows of all files that can be read.  The schema is given, as a damaged file must not be asked for it."""
    return spark.read.format(fmt).schema(schema).option("ignoreCorruptFiles", "true").load(path)


def check_units(spark: SparkSession, path: str, schema: str | StructType, keys: list[str], fmt: str = "parquet",
                deep: bool = False) -> DataFrame:
    """``(keys..., n_files, n_rows, reason)``, one row a unit; ``reason`` is NULL for a good one.

    Row counts come from the footers, so no column is decoded.  ``deep`` decodes all columns as well and finds files
    that break in the middle."""
    rows = read_tolerant(spark, path, schema, fmt)
    types = {f.name: f.dataType for f in rows.schema}
    file = F.col("_metadata.file_path").alias("file")
    said = rows.select(file).groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))
    files = list_files(spark, path).join(said, "file", "left").withColumn(
        "reason", F.when(F.coalesce("n_rows", F.lit(0)) == 0, NO_ROWS))
    if deep:
        data = [c for c in rows.columns if c not in keys]
        read = (rows.select(file, F.xxhash64(*data).alias("h")).groupBy("file")
                .agg(F.count(F.lit(1)).alias("n_read"), F.bit_xor("h").alias("_all")).where(F.col("_all").isNotNull()))
        files = files.join(read, "file", "left").withColumn(
            "reason", F.coalesce("reason", F.when(F.coalesce("n_read", F.lit(0)) < F.col("n_rows"), CUT)))
    return (files.groupBy(*[folder_key(F.col("file"), k, types[k]).alias(k) for k in keys])
            .agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.max("reason").alias("reason")))


def good_rows(spark: SparkSession, path: str, schema: str | StructType, units: DataFrame, keys: list[str],
              fmt: str = "parquet") -> DataFrame:
    """Rows of the units without a reason; none of a spoilt unit, even if some of its files can be read."""
    rows, bad = read_tolerant(spark, path, schema, fmt).alias("r"), units.where("reason IS NOT NULL").alias("b")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return rows.join(bad, same, "left_anti")
