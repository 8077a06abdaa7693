"""Zone statistics and zone products on the S3 stand-in, over every date of
the tables (all water years); p10 is the one-water-year filter itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from firn.functions.numeric import rnd, rnd_sql
from firn.functions.timecols import water_year_bounds
from firn.operators import zonal as Z
from firn.plans.registry import register
from firn.sources import standins as S
from firn.sources.tables import Tables

# Query parameters.
WATER_YEAR = 1996
AS_OF = "1997-06-01"
WY_FIRST, WY_LAST = water_year_bounds(WATER_YEAR)


def zone_region(t: Tables):
    return (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("zone"), F.col("r_name").alias("region")))


def wy_values(t: Tables):
    """S3 rows of one water year; the range reaches the parquet scans."""
    return Z.filter_water_year(S.s3(t, WY_FIRST, WY_LAST), WATER_YEAR)


def product_values(t: Tables):
    """S3 rows of every date (all water years)."""
    return S.s3(t)


def zone_means(t: Tables):
    zr = zone_region(t)
    return Z.zonal_mean(product_values(t), zr), zr


# ---- DuckDB twins ---------------------------------------------------------
_WY = f"date BETWEEN DATE '{WY_FIRST}' AND DATE '{WY_LAST}'"
_ALL = "TRUE"
_ZM = f"""
v AS (SELECT variable, date, zone,
             CASE WHEN isnan(value) OR value = -9999 THEN NULL ELSE value END AS value
      FROM s3 WHERE {_ALL}),
k AS (SELECT DISTINCT variable, date FROM v),
zr AS (SELECT n_name AS zone, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
zm AS (SELECT k.variable, k.date, zr.zone, avg(v.value) AS mean
       FROM k CROSS JOIN zr LEFT JOIN v ON v.variable = k.variable AND v.date = k.date AND v.zone = zr.zone
       GROUP BY k.variable, k.date, zr.zone)"""


def _zm_sql(body: str) -> str:
    return S.with_ctes(body, "s3", extra=_ZM)


@register("a01_zonal_mean", _zm_sql(f"SELECT variable, date, zone, {rnd_sql('mean')} AS mean FROM zm"))
def a01_zonal_mean(t: Tables):
    """Zonal mean per (variable, date, zone), empty zone-days kept as NULL."""
    zm, _ = zone_means(t)
    return zm.select("variable", "date", "zone", rnd("mean").alias("mean"))


@register("a02_region_mean", _zm_sql(f"""
SELECT variable, date, region, {rnd_sql("avg(mean)")} AS mean
FROM zm JOIN zr USING (zone) GROUP BY variable, date, region"""))
def a02_region_mean(t: Tables):
    """Region roll-up: unweighted mean of catchment means, NULL skipped."""
    zm, zr = zone_means(t)
    r = Z.region_mean(zm, zr)
    return r.select("variable", "date", "region", rnd("mean").alias("mean"))


# The zone names of the driver's nation table, the columns of the wide tables' SQL.
ZONES = tuple(f"NATION_{k}" for k in range(25))
_WIDE = ", ".join(f"max(mean) FILTER (WHERE zone = '{z}') AS {z}" for z in ZONES)


@register("a03_pivot_wide", _zm_sql(f"""
SELECT date, {_WIDE} FROM (SELECT date, zone, {rnd_sql('mean')} AS mean FROM zm WHERE variable = 'SWE') GROUP BY date"""))
def a03_pivot_wide(t: Tables):
    """Wide SWE table: date plus one column per zone."""
    return Z.pivot_wide(swe_means(t), Z.zones_of(zone_region(t)))


def swe_means(t: Tables):
    """Zone means of SWE where there are any; a wide table needs no rows for empty zone-days."""
    v = product_values(t).where(F.col("variable") == "SWE")
    v = v.select("date", "zone", Z.nodata_to_null(F.col("value")).alias("value"))
    return v.groupBy("date", "zone").agg(rnd(F.avg("value")).alias("mean"))


@register("p09_water_year", S.with_ctes("""
SELECT variable, CAST(year(date) - CASE WHEN month(date) < 9 THEN 1 ELSE 0 END AS INT) AS water_year,
       count(*) AS n, min(date) AS first_date, max(date) AS last_date
FROM s3 GROUP BY 1, 2""", "s3"))
def p09_water_year(t: Tables):
    """Rows and date span per variable and water year."""
    return (Z.with_water_year(S.s3(t)).groupBy("variable", "water_year")
            .agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"),
                 F.max("date").alias("last_date")))


@register("p10_water_year_filter", S.with_ctes(f"""
SELECT variable, date, zone, region, value FROM s3 WHERE {_WY}""", "s3"))
def p10_water_year_filter(t: Tables):
    """All S3 rows of water year 1996."""
    return wy_values(t)


@register("p15_nodata_null", S.with_ctes("""
SELECT variable, zone, count(*) AS n_rows,
       count(CASE WHEN isnan(value) OR value = -9999 THEN NULL ELSE value END) AS n_valid
FROM s3 GROUP BY 1, 2""", "s3"))
def p15_nodata_null(t: Tables):
    """Valid (non-sentinel) values per variable and zone."""
    return (S.s3(t).groupBy("variable", "zone")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count(Z.nodata_to_null(F.col("value"))).alias("n_valid")))


_PRODUCT_COLS = ", ".join(rnd_sql(f"max(mean) FILTER (WHERE variable = '{v}')") + f" AS {q}_{v}"
                         for q in Z.QUANTILES for v in Z.PRODUCT_VARIABLES)


@register("j14_zone_product", _zm_sql(f"""
SELECT zone, date, {_PRODUCT_COLS}, date >= DATE '{AS_OF}' AS FC
FROM zm GROUP BY zone, date HAVING count(DISTINCT variable) = 3"""))
def j14_zone_product(t: Tables):
    """Per-catchment product: Q5/Q50/Q95 copies of SWE, HS, ROF + FC flag."""
    zm, _ = zone_means(t)
    p = Z.zone_product(zm, AS_OF)
    return p.select("zone", "date", *[rnd(c).alias(c) for c in p.columns[2:-1]], "FC")


@register("j14_region_product", _zm_sql(f"""
, rm AS (SELECT variable, date, region, avg(mean) AS mean FROM zm JOIN zr USING (zone) GROUP BY 1, 2, 3)
SELECT region, date, {_PRODUCT_COLS}, date >= DATE '{AS_OF}' AS FC
FROM rm GROUP BY region, date HAVING count(DISTINCT variable) = 3"""))
def j14_region_product(t: Tables):
    """Per-region product table from the region roll-up (no second scan)."""
    zm, zr = zone_means(t)
    rm = Z.region_mean(zm, zr)
    p = Z.zone_product(rm, AS_OF, zone_col="region")
    return p.select("region", "date", *[rnd(c).alias(c) for c in p.columns[2:-1]], "FC")


@register("u04_common_dates", _zm_sql("""
SELECT date FROM zm WHERE variable = 'SWE' INTERSECT SELECT date FROM zm WHERE variable = 'HS'
INTERSECT SELECT date FROM zm WHERE variable = 'ROF'"""))
def u04_common_dates(t: Tables):
    """Dates present for all three variables."""
    return Z.common_dates(product_values(t), Z.PRODUCT_VARIABLES)


@register("p20_fixed_columns", _zm_sql(f"""
SELECT date, zone, {rnd_sql('mean')} AS SWE, CAST(NULL AS DOUBLE) AS GST FROM zm WHERE variable = 'SWE'"""))
def p20_fixed_columns(t: Tables):
    """Fixed output columns; a variable that is not produced (GST) is NULL."""
    zm, _ = zone_means(t)
    swe = zm.where(F.col("variable") == "SWE").select("date", "zone", rnd("mean").alias("SWE"))
    return Z.ensure_columns(swe, ["date", "zone", "SWE", "GST"])


@register("p16_forecast_flag", S.with_ctes(f"""
SELECT DISTINCT variable, date, date >= DATE '{AS_OF}' AS FC FROM s3""", "s3"))
def p16_forecast_flag(t: Tables):
    """Forecast flag per product day: FC = date >= as_of."""
    return (product_values(t).select("variable", "date").distinct()
            .withColumn("FC", F.col("date") >= F.lit(AS_OF).cast("date")))


@register("j13_quantile_copies", _zm_sql(f"""
SELECT zone, date, {rnd_sql('mean')} AS Q5_SWE, {rnd_sql('mean')} AS Q50_SWE, {rnd_sql('mean')} AS Q95_SWE
FROM zm WHERE variable = 'SWE'"""))
def j13_quantile_copies(t: Tables):
    """Q5/Q50/Q95 of SWE: three copies of the same zone mean, no self-join."""
    zm, _ = zone_means(t)
    m = rnd("mean")
    return zm.where(F.col("variable") == "SWE").select(
        "zone", "date", *[m.alias(f"{q}_SWE") for q in Z.QUANTILES])
