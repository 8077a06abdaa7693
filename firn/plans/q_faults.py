"""Folders with damaged files: monthly forcing files and monthly rasters, some cut off, some without rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from firn.functions.numeric import rnd, rnd_sql
from firn.operators import quality as Q
from firn.operators import zonal as Z
from firn.plans.q_zonal import zone_region
from firn.plans.registry import register
from firn.sources import faults
from firn.sources import standins as S
from firn.sources.files import write_partitioned
from firn.sources.tables import Tables
from firn.sources.textio import scratch_path

FILE_SCHEMA = "lon_i int, time timestamp_ntz, value double, source string, lat_i int, month date"
FILE_KEYS = ["source", "lat_i", "month"]
# Which files are damaged.  Cut off: one source's row of cells; a second part of another.  Without rows: a third.
CUT_FILES = "(source = 'cont_fc' AND lat_i = 1) OR (source = 'reanalysis' AND lat_i = 3)"
EMPTY_FILES = "source = 'daily_fc' AND lat_i = 2"


def write_damaged(rows, path: str, keys: list[str], cut: str, empty: str) -> None:
    """``rows`` in a folder for each of ``keys``; those of ``cut`` get a file that is none, those of ``empty``
    only a file without rows."""
    write_partitioned(rows.where(f"NOT ({empty})"), path, keys)
    # a file that ends before its footer
    torn = rows.where(cut).select(*keys).distinct().withColumn("value", F.lit("PAR1 and no more"))
    torn.write.mode("append").partitionBy(*keys).text(path)
    spark = rows.sparkSession
    data = rows.drop(*keys).schema
    for r in rows.where(empty).select(*[F.col(k).cast("string") for k in keys]).distinct().collect():  # names of folders
        folder = "/".join(f"{k}={r[k]}" for k in keys)
        spark.createDataFrame([], data).write.parquet(f"{path}/{folder}")


def forcing_files(t: Tables) -> str:
    """S1 in monthly files by source and row of cells; every seventh column is half an hour off."""
    s = S.s1(t).select("lon_i", F.when(F.col("lon_i") % 7 == 3, F.col("time") + F.expr("INTERVAL 30 MINUTES")).otherwise(F.col("time")).alias("time"),
                       "value", "source", "lat_i", F.trunc("time", "month").alias("month"))
    path = scratch_path(t.spark, "forcing-files")
    write_damaged(s, path, FILE_KEYS, CUT_FILES, EMPTY_FILES)
    return path


_FILES = f"""
f AS (SELECT DISTINCT source, lat_i, CAST(date_trunc('month', time) AS DATE) AS month,
             CASE WHEN ({CUT_FILES}) OR ({EMPTY_FILES}) THEN 'no rows' END AS reason FROM s1),
x AS (SELECT source, lat_i, month, unnest(generate_series(CAST(month AS TIMESTAMP), CAST(last_day(month) AS TIMESTAMP) + INTERVAL 23 HOUR,
                                                          INTERVAL 1 HOUR)) AS time FROM f),
h AS (SELECT DISTINCT source, lat_i, time FROM s1 WHERE lon_i % 7 <> 3),
c AS (SELECT f.source, f.lat_i, f.month, f.reason, count(*) AS n_expected, count(h.time) FILTER (f.reason IS NULL) AS n_present
      FROM f JOIN x USING (source, lat_i, month) LEFT JOIN h ON h.source = f.source AND h.lat_i = f.lat_i AND h.time = x.time GROUP BY ALL),
r AS (SELECT source, lat_i, month, n_present, n_expected - n_present AS n_missing,
             coalesce(reason, CASE WHEN n_present < n_expected THEN 'missing hours' END) AS reason FROM c)"""


def _completeness(t: Tables):
    path = forcing_files(t)
    units = faults.check_units(t.spark, path, FILE_SCHEMA, FILE_KEYS)
    rows = faults.good_rows(t.spark, path, FILE_SCHEMA, units, FILE_KEYS)
    return Q.file_completeness(units, rows, ["source", "lat_i"])


@register("j08_file_completeness", S.with_ctes("SELECT * FROM r", "s1", extra=_FILES))
def j08_file_completeness(t: Tables):
    """Every monthly file with its hours present and missing; unreadable files and files without rows are rows too."""
    return _completeness(t)


@register("a12_bad_files", S.with_ctes("SELECT source, lat_i, month, reason, n_missing FROM r WHERE reason IS NOT NULL", "s1", extra=_FILES))
def a12_bad_files(t: Tables):
    """The error list: files that cannot be read, hold no rows or miss hours, with the number of missing steps."""
    return _completeness(t).where("reason IS NOT NULL").select("source", "lat_i", "month", "reason", "n_missing")


RASTER_SCHEMA = "date date, zone string, value double, variable string, month date"
RASTER_KEYS = ["variable", "month"]
# Damaged rasters, by the month's number since year 0.
_NO = "(12 * year(month) + month(month))"
CUT_RASTERS = f"variable = 'SWE' AND {_NO} % 17 = 5"
EMPTY_RASTERS = f"variable = 'HS' AND {_NO} % 19 = 7"


@register("a01_unreadable_raster", S.with_ctes(f"SELECT variable, date, zone, {rnd_sql('mean')} AS mean FROM zm", "s3", extra=f"""
a AS (SELECT variable, date, zone, CASE WHEN isnan(value) OR value = -9999 THEN NULL ELSE value END AS value,
             CAST(date_trunc('month', date) AS DATE) AS month FROM s3),
w AS (SELECT *, ({CUT_RASTERS}) OR ({EMPTY_RASTERS}) AS bad FROM a),
v AS (SELECT * FROM w WHERE NOT bad),
k AS (SELECT DISTINCT variable, date FROM v UNION
      SELECT variable, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) FROM (SELECT DISTINCT variable, month FROM w WHERE bad)),
zr AS (SELECT n_name AS zone FROM nation JOIN region ON n_regionkey = r_regionkey),
zm AS (SELECT k.variable, k.date, zr.zone, avg(v.value) AS mean
       FROM k CROSS JOIN zr LEFT JOIN v ON v.variable = k.variable AND v.date = k.date AND v.zone = zr.zone GROUP BY ALL)"""))
def a01_unreadable_raster(t: Tables):
    """Zonal means from monthly rasters of which some are damaged: all zones are NULL on each day of such a month."""
    s = S.s3(t).select("date", "zone", "value", "variable", F.trunc("date", "month").alias("month"))
    path = scratch_path(t.spark, "rasters")
    write_damaged(s, path, RASTER_KEYS, CUT_RASTERS, EMPTY_RASTERS)
    units = faults.check_units(t.spark, path, RASTER_SCHEMA, RASTER_KEYS)
    rows = faults.good_rows(t.spark, path, RASTER_SCHEMA, units, RASTER_KEYS)
    return (Z.zonal_mean_of_files(rows, units, zone_region(t)).select("variable", "date", "zone", rnd("mean").alias("mean")))
