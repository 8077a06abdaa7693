"""Forcing queries on S1 (surface fields) and S2 (accumulated runs)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firn.functions.numeric import rnd, rnd_sql
from firn.operators import forcing as P
from firn.plans.registry import register
from firn.sources import standins as S
from firn.sources.tables import Tables

KEYS = ["source", "lat_i", "lon_i", "time"]
RUN = ["run_date", "cell"]
# S2 switches from 3-hour to 6-hour steps after step 12.
S2_SWITCH = 12


def q(body: str, *names: str) -> str:
    return S.with_ctes(body, *(names or ("s1_surface",)))


@register("p01_bbox", q("""
SELECT source, prio, lat_i, lon_i, lat, lon, time, value FROM s1
WHERE lat BETWEEN 32.0 AND 45.0 AND lon BETWEEN 59.0 AND 81.0""", "s1"))
def p01_bbox(t: Tables):
    """Inclusive bounding box (lat 32-45, lon 59-81); edge cells kept."""
    return P.bbox(S.s1(t))


def raw_forecast(t: Tables):
    """S1 surface fields under forecast parameter names (2t, param193.1.0)."""
    return S.s1_surface(t).select(*KEYS, F.col("t2m").alias("2t"), F.col("value").alias("param193.1.0"),
                                  "sp", "msl")


@register("p02_rename", q("""
SELECT source, lat_i, lon_i, time, t2m, value AS tp, sp, msl FROM s1_surface"""))
def p02_rename(t: Tables):
    """Forecast names to reanalysis names; tp taken from its fallback name."""
    return P.rename_with_fallback(raw_forecast(t))


@register("p03_drop", q("SELECT source, lat_i, lon_i, time, t2m, sp FROM s1_surface"))
def p03_drop(t: Tables):
    """Variables not carried on (value, msl, gh, plev, lat, lon, prio) dropped."""
    return P.drop_fields(S.s1_surface(t), "value", "msl", "gh", "plev", "lat", "lon", "prio")


@register("p04_surface_geopotential", q(f"""
SELECT source, lat_i, lon_i, time, {rnd_sql('287.0 * t2m * ln(msl / sp)')} AS z FROM s1_surface"""))
def p04_surface_geopotential(t: Tables):
    """Surface geopotential z = 287 T ln(msl/sp)."""
    d = P.with_surface_geopotential(S.s1_surface(t))
    return d.select(*KEYS, rnd("z").alias("z"))


@register("p05_level_geopotential", q(f"""
SELECT source, lat_i, lon_i, time, {rnd_sql('gh * 9.81')} AS z FROM s1_surface"""))
def p05_level_geopotential(t: Tables):
    """Level geopotential z = gh * 9.81."""
    d = P.with_level_geopotential(S.s1_surface(t))
    return d.select(*KEYS, rnd("z").alias("z"))


@register("p06_level_hpa", q("""
SELECT source, lat_i, lon_i, time, plev / 100 AS level,
       row_number() OVER (PARTITION BY source, lat_i, lon_i, CAST(time AS DATE) ORDER BY plev, time) AS rank FROM s1_surface"""))
def p06_level_hpa(t: Tables):
    """Pressure levels in hPa, ascending; ``rank`` shows the order inside a cell's day."""
    day = Window.partitionBy("source", "lat_i", "lon_i", F.to_date("time")).orderBy("level", "time")
    return (P.to_hpa(S.s1_surface(t)).select(*KEYS, "level").withColumn("rank", F.row_number().over(day).cast("bigint")))


@register("p07_allow_list", q("""
SELECT source, lat_i, lon_i, time, plev / 100 AS level, t2m, gh FROM s1_surface
WHERE plev / 100 IN (1000, 925, 850, 700, 600, 500, 400, 300)"""))
def p07_allow_list(t: Tables):
    """Parameter allow-list projection and the 8-level filter."""
    d = P.to_hpa(S.s1_surface(t))
    return P.allow_list(d, KEYS, ["level", "t2m", "gh"], levels=[float(x) for x in S.LEVELS_HPA])


_W01 = f"""
w1 AS (SELECT run_date, cell, step,
              (acc - coalesce(lag(acc) OVER (PARTITION BY run_date, cell ORDER BY step), 0.0))
              / CASE WHEN step <= {S2_SWITCH} THEN 3 ELSE 6 END AS rate
       FROM s2)"""


@register("w01_deaccumulate", S.with_ctes(f"SELECT run_date, cell, step, {rnd_sql('rate')} AS rate FROM w1",
                                          "s2", extra=_W01))
def w01_deaccumulate(t: Tables):
    """Accumulated totals to rates: difference of successive steps / step width."""
    d = P.deaccumulate(S.s2(t), RUN, "acc", switch=S2_SWITCH)
    return d.select(*RUN, "step", rnd("rate").alias("rate"))


_W02 = _W01 + """,
k AS (SELECT run_date, cell, step, rate, lead(step) OVER w AS s2, lead(rate) OVER w AS v2
      FROM w1 WINDOW w AS (PARTITION BY run_date, cell ORDER BY step)),
h AS (SELECT run_date, cell, step AS hour, rate FROM k WHERE s2 IS NULL
      UNION ALL
      SELECT run_date, cell, hr AS hour, rate + (v2 - rate) * (hr - step) / (s2 - step) AS rate
      FROM (SELECT *, unnest(generate_series(step, s2 - 1)) AS hr FROM k WHERE s2 IS NOT NULL))"""


def w02_frame(t: Tables):
    d = P.deaccumulate(S.s2(t), RUN, "acc", switch=S2_SWITCH).select(*RUN, "step", "rate")
    return P.interpolate_hourly(d, RUN, "rate")


@register("w02_interpolate", S.with_ctes(f"SELECT run_date, cell, CAST(hour AS INT) AS hour, {rnd_sql('rate')} AS rate FROM h",
                                         "s2", extra=_W02))
def w02_interpolate(t: Tables):
    """Rates linearly interpolated to every hour between irregular knots."""
    return w02_frame(t).select(*RUN, F.col("hour").cast("int").alias("hour"), rnd("rate").alias("rate"))


@register("w03_hindcast_day", S.with_ctes(f"""
SELECT run_date, cell, CAST(hour AS INT) AS hour, {rnd_sql('rate')} AS rate,
       CAST(min(CAST(run_date AS TIMESTAMP) + to_hours(CAST(hour AS BIGINT))) OVER (PARTITION BY run_date, cell) AS DATE) AS label_date
FROM (SELECT *, row_number() OVER (PARTITION BY run_date, cell ORDER BY hour) AS rn FROM h) WHERE rn <= 24""",
                                          "s2", extra=_W02))
def w03_hindcast_day(t: Tables):
    """First 24 hourly rows of each run, labelled by the day of the first."""
    h = w02_frame(t).withColumn(
        "valid_time", F.col("run_date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("hour")))
    d = P.first_hours(h, RUN, "hour", 24, label_from="valid_time")
    return d.select(*RUN, F.col("hour").cast("int").alias("hour"), rnd("rate").alias("rate"), "label_date")


_W04 = """
SELECT CASE run WHEN 2 THEN 'daily_fc' ELSE 'cont_fc' END AS source, lat_i, lon_i, time, value, run FROM (
  SELECT lat_i, lon_i, time, value, prio AS run, row_number() OVER (PARTITION BY lat_i, lon_i, time ORDER BY prio {order}) AS rn
  FROM s1 WHERE source IN ('daily_fc', 'cont_fc')) WHERE rn = 1"""


def forecast_rows(t: Tables):
    """Both forecast sources with their run number; the source's name follows from it."""
    return (S.s1(t).where(F.col("source").isin("daily_fc", "cont_fc"))
            .select("lat_i", "lon_i", "time", "value", F.col("prio").alias("run")))


def with_source(df):
    name = F.when(F.col("run") == 2, "daily_fc").otherwise("cont_fc")
    return df.select(name.alias("source"), "lat_i", "lon_i", "time", "value", "run")


@register("w04_latest_run", q(_W04.format(order="DESC"), "s1"))
def w04_latest_run(t: Tables):
    """Per (cell, valid time) the whole row of the latest forecast run."""
    return with_source(P.latest_run(forecast_rows(t), ["lat_i", "lon_i", "time"], "run"))


@register("w04_first_run", q(_W04.format(order="ASC"), "s1"))
def w04_first_run(t: Tables):
    """As coded: the row that comes first in run order stays."""
    return with_source(P.latest_run(forecast_rows(t), ["lat_i", "lon_i", "time"], "run", prefer="first"))


@register("a06_dedupe_first", q("""
SELECT source, lat_i, lon_i, time, value FROM (
  SELECT *, row_number() OVER (PARTITION BY lat_i, lon_i, time
                               ORDER BY CASE source WHEN 'cont_fc' THEN 1 ELSE 2 END) AS rn
  FROM s1 WHERE source IN ('daily_fc', 'cont_fc')) WHERE rn = 1""", "s1"))
def a06_dedupe_first(t: Tables):
    """Forecast merge dedupe: the first file in name order (continuous) wins."""
    rank = F.when(F.col("run") == 3, 1).otherwise(2)
    return with_source(P.first_in_order(forecast_rows(t), ["lat_i", "lon_i", "time"], rank)).drop("run")
