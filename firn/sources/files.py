"""File-level sources and sinks: class scans, dated names, wide CSV
tables, per-zone TSV, day- and raster-partitioned writes (IO01, IO02,
IO05-IO09).  Spark writers name folders, not files, so "one file per
X" becomes one partition folder per X; names live in partition columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firn.functions.names import date_from_name

# Name classes of forcing files.
CLASS_PATTERNS = {"reanalysis": r"^PLEV_20", "daily_fc": r"^PLEV_FC_20", "cont_fc": r"^PLEV_FC$"}


def write_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "parquet",
                      within: list[str] | None = None, gather: bool = True, **options) -> None:
    """Partitioned write to a new path.

    A ``REBALANCE`` on the partition columns brings a folder's rows together without a sampling
    pass; adaptive execution joins small folders in one task and splits a large one (a day holding
    a third of the data) over many.  Rows are sorted by ``within`` inside a task's folder, so
    ranges of these columns skip row groups.  Without ``gather`` each task writes its rows into their
    folders as they come: for rows that are many times what they were made from and stand in order already."""
    out = df.hint("rebalance", *by) if gather else df
    if within and gather:
        out = out.sortWithinPartitions(*by, *within)
    w = out.write.mode("errorifexists").partitionBy(*by)
    for k, v in options.items():
        w = w.option(k, v)
    w.format(fmt).save(path)


def scan_class(spark: SparkSession, path: str, file_col: str, cls: str) -> DataFrame:
    """Rows of the files whose name matches a class pattern (IO01); the
    predicate is on the partition column, so folders are pruned at listing."""
    return spark.read.parquet(path).where(F.col(file_col).rlike(CLASS_PATTERNS[cls]))


def dated_files(names: DataFrame, name_col: str = "name") -> DataFrame:
    """(name, date) for names carrying a valid date; bad names skipped (IO02)."""
    return names.select(name_col, date_from_name(F.col(name_col)).alias("date")).where(F.col("date").isNotNull())


def write_wide_csv(wide: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Wide table sink with header (IO06), optionally one folder per variable, whose rows are brought together."""
    if by:
        write_partitioned(wide, path, by, "csv", header=True)
    else:
        wide.write.mode("errorifexists").option("header", True).csv(path)


def read_wide_csv(spark: SparkSession, path: str, key: str, columns: list[str] | None = None,
                  key_type: str = "date", extra: list[str] | None = None,
                  zone_col: str = "zone", value_col: str = "mean") -> DataFrame:
    """Wide CSV scan (``key`` + one column per zone) back to the long table
    (IO05).  Columns go by the names in the header, in whatever order they
    stand; ``columns`` selects zones (an absent one is an error), all by default.  Nothing but the header is read
    ahead.  Files of one path have the same header."""
    wide = spark.read.option("header", True).csv(path)  # text columns; partition columns appended
    extra = extra or []
    zones = columns or [c for c in wide.columns if c not in (key, *extra)]
    typed = wide.select(F.col(key).cast(key_type).alias(key), *extra, *[F.col(f"`{c}`").cast("double").alias(c) for c in zones])
    return typed.unpivot([key] + extra, zones, zone_col, value_col)


def write_zone_tsv(product: DataFrame, path: str, zone_col: str = "zone", within: list[str] | None = None) -> None:
    """Per-zone tab-separated product files (IO07): one write job, one
    folder per zone whose rows are brought together, instead of a loop over zones."""
    write_partitioned(product, path, [zone_col], "csv", within, sep="\t", header=True)
