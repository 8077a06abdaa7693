"""The sink as a catalogue, run-time pruning of its partitions, bucketed tables, and wide tables of any number of zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from firn.functions.numeric import rnd, rnd_sql
from firn.functions.timecols import water_year
from firn.operators import merge as M
from firn.operators import raster as R
from firn.operators import zonal as Z
from firn.plans.q_zonal import _ZM, AS_OF, WATER_YEAR, zone_region
from firn.plans.registry import register
from firn.sources import catalogue as CT
from firn.sources import standins as S
from firn.sources import wide as W
from firn.sources.tables import Tables
from firn.sources.textio import scratch_path, stored

KEYS = ["variable", "month"]
SCHEMA = "date date, zone string, value double, variable string, month date"
# The first run ends before this month; months (by their number) that a lost run left half written.
FIRST_RUN_UNTIL = "1995-01-01"
LOST = "month(month) % 5 = 2"


def rasters(t: Tables):
    return S.s3(t).select("date", "zone", "value", "variable", F.trunc("date", "month").alias("month"))


def published_in_runs(t: Tables):
    """A first run, a run that was lost before its marker, a second run over all months, and a third one."""
    r, path = stored(rasters(t), "rasters"), scratch_path(t.spark, "published")
    until = F.col("month") < F.lit(FIRST_RUN_UNTIL).cast("date")
    CT.publish_new(r.where(until), path, KEYS, "first")
    CT.write_partitions(r.where(~until & F.expr(LOST) & (F.dayofmonth("date") < 15)), path, KEYS)  # lost: no marker
    CT.write_attributes(t.spark.createDataFrame(list(R.PRODUCT_NAMES.values()), "variable string, unit string"), path)
    CT.publish_new(r, path, KEYS, "second")
    third = CT.publish_new(r, path, KEYS, "third")
    return path, third


_RUNS = f"""
r AS (SELECT variable, CAST(date_trunc('month', date) AS DATE) AS month FROM s3),
u AS (SELECT variable, month, CASE WHEN month < DATE '{FIRST_RUN_UNTIL}' THEN 'first' ELSE 'second' END AS run,
             CASE variable WHEN 'SWE' THEN 'mm' WHEN 'HS' THEN 'm' WHEN 'ROF' THEN 'mm' END AS unit, count(*) AS n_rows FROM r GROUP BY ALL)"""


@register("j16_publish_runs", S.with_ctes("SELECT variable, month, run, unit, n_rows, false AS again FROM u", "s3", extra=_RUNS))
def j16_publish_runs(t: Tables):
    """Each month with the run that published it whole, its unit and its rows; the third run publishes nothing again."""
    path, third = published_in_runs(t)
    rows = CT.read_published(t.spark, path, SCHEMA, KEYS).groupBy(*KEYS, "unit").agg(F.count(F.lit(1)).alias("n_rows"))
    types = t.spark.createDataFrame([], "variable string, month date").schema
    runs = CT.published(t.spark, path, types)
    again = third.withColumn("again", F.lit(True))
    return (rows.join(runs, KEYS).join(again, KEYS, "left")
            .select(*KEYS, "run", "unit", "n_rows", F.coalesce("again", F.lit(False)).alias("again")))


@register("p10_pruned_rasters", S.with_ctes(f"""
SELECT variable, date, zone, {rnd_sql('avg(CASE WHEN isnan(value) OR value = -9999 THEN NULL ELSE value END)')} AS mean, count(*) AS n
FROM s3 WHERE year(date) - CASE WHEN month(date) < 9 THEN 1 ELSE 0 END = {WATER_YEAR} GROUP BY ALL""", "s3"))
def p10_pruned_rasters(t: Tables):
    """Zone means of the water year that a calendar table names, from monthly folders; others are pruned at run time."""
    path = scratch_path(t.spark, "rasters")
    r = stored(rasters(t), "rasters-all")
    CT.write_partitions(r, path, KEYS)
    months = stored(r.select("month").distinct().withColumn("water_year", water_year(F.col("month"))), "calendar")
    rows = CT.join_on_partitions(t.spark, path, SCHEMA, months.where(F.col("water_year") == WATER_YEAR), ["month"])
    g = rows.groupBy("variable", "date", "zone").agg(F.avg(Z.nodata_to_null(F.col("value"))).alias("mean"), F.count(F.lit(1)).alias("n"))
    return g.select("variable", "date", "zone", rnd("mean").alias("mean"), "n")


def buckets(t: Tables) -> int:
    return int(t.spark.conf.get("spark.sql.shuffle.partitions"))


@register("j01_bucketed_merge", S.with_ctes(f"""
SELECT lat_i, lon_i, time, {rnd_sql('min_by(value, prio) FILTER (WHERE value IS NOT NULL)')} AS value,
       min(prio) FILTER (WHERE value IS NOT NULL) AS src_prio FROM s1 GROUP BY ALL""", "s1"))
def j01_bucketed_merge(t: Tables):
    """The daily overlay on a table bucketed by cell: merged bucket by bucket, without a shuffle."""
    s = CT.save_bucketed(S.s1(t).select("lat_i", "lon_i", "time", "value", "prio"), ["lat_i", "lon_i"], buckets(t), "forcing", ["time"])
    m = M.priority_merge(s, ["lat_i", "lon_i", "time"], ["value"], source="src_prio")
    return m.select("lat_i", "lon_i", "time", rnd("value").alias("value"), "src_prio")


@register("j14_bucketed_product", S.with_ctes(f"""
SELECT zone, date, {', '.join(f"{rnd_sql(f'{v}.mean')} AS {v}" for v in Z.PRODUCT_VARIABLES)}, date >= DATE '{AS_OF}' AS FC
FROM (SELECT * FROM zm WHERE variable = 'SWE') SWE JOIN (SELECT * FROM zm WHERE variable = 'HS') HS USING (zone, date)
JOIN (SELECT * FROM zm WHERE variable = 'ROF') ROF USING (zone, date)""", "s3", extra=_ZM))
def j14_bucketed_product(t: Tables):
    """The three-way date join of zone means that are stored apart by variable, bucketed by zone and date: no shuffle."""
    zm = stored(Z.zonal_mean(S.s3(t), zone_region(t)), "means")
    parts = [CT.save_bucketed(zm.where(F.col("variable") == v).select("zone", "date", rnd("mean").alias(v)), ["zone", "date"], buckets(t), v.lower())
             for v in Z.PRODUCT_VARIABLES]
    # hint: sides of this size would be broadcast, larger ones meet in their buckets
    j = parts[0].join(parts[1].hint("merge"), ["zone", "date"]).join(parts[2].hint("merge"), ["zone", "date"])
    return j.select("zone", "date", *Z.PRODUCT_VARIABLES, (F.col("date") >= F.lit(AS_OF).cast("date")).alias("FC"))


@register("io06_wide_chunks", """
WITH v AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, 'P' || l_partkey AS zone, sum(l_quantity) AS mean FROM lineitem GROUP BY ALL)
SELECT d.date, z.zone, v.mean FROM (SELECT DISTINCT date FROM v) d CROSS JOIN (SELECT DISTINCT zone FROM v) z LEFT JOIN v USING (date, zone)""")
def io06_wide_chunks(t: Tables):
    """Monthly totals of every part as a wide table in chunks of columns, and back: no list of zones in the driver."""
    li = t.lineitem.groupBy(F.trunc("l_shipdate", "month").alias("date"), F.concat(F.lit("P"), "l_partkey").alias("zone")).agg(F.sum("l_quantity").alias("mean"))
    path = scratch_path(t.spark, "wide")
    W.write_wide_chunks(li, path, "date")
    return W.read_wide_chunks(t.spark, path, "date")
