"""Merge queries on the S1 three-source forcing stand-in."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firn.functions.numeric import rnd, rnd_sql
from firn.operators import merge as M
from firn.plans.registry import register
from firn.sources import standins as S
from firn.sources.tables import Tables

CELL_TIME = ["lat_i", "lon_i", "time"]
ROW = ["source", "lat_i", "lon_i", "time", "value"]


def q(body: str, *names: str, extra: str = "") -> str:
    return S.with_ctes(body, *(names or ("s1",)), extra=extra)


def by_source(t: Tables, src: str, cols=ROW):
    return S.s1(t).where(F.col("source") == src).select(*cols)


def drifting_sources(t: Tables):
    """Sources whose variables differ: reanalysis (value, t2m), hindcast
    (value, sp), continuous forecast (value, t2m, sp)."""
    s = S.s1_surface(t)
    k = ["prio", *CELL_TIME, "value"]
    return M.concat(s.where(F.col("source") == "reanalysis").select(*k, "t2m"),
                    s.where(F.col("source") == "daily_fc").select(*k, "sp"),
                    s.where(F.col("source") == "cont_fc").select(*k, "t2m", "sp"))


_DRIFT = """
u AS (SELECT prio, lat_i, lon_i, time, value, t2m, CAST(NULL AS DOUBLE) AS sp FROM s1_surface WHERE source = 'reanalysis'
      UNION ALL SELECT prio, lat_i, lon_i, time, value, CAST(NULL AS DOUBLE), sp FROM s1_surface WHERE source = 'daily_fc'
      UNION ALL SELECT prio, lat_i, lon_i, time, value, t2m, sp FROM s1_surface WHERE source = 'cont_fc')"""


@register("j01_priority_merge", q("""
SELECT lat_i, lon_i, time,
       min_by(value, prio) FILTER (WHERE value IS NOT NULL) AS value,
       min_by(t2m, prio) FILTER (WHERE t2m IS NOT NULL) AS t2m,
       min_by(sp, prio) FILTER (WHERE sp IS NOT NULL) AS sp
FROM u GROUP BY lat_i, lon_i, time""", "s1_surface", extra=_DRIFT))
def j01_priority_merge(t: Tables):
    """Per cell and variable: reanalysis > daily hindcast > continuous forecast."""
    return M.priority_merge(drifting_sources(t), CELL_TIME, ["value", "t2m", "sp"])


@register("j02_gap_fill", q("""
, r AS (SELECT * FROM s1 WHERE source = 'reanalysis'),
  gx AS (SELECT unnest(generate_series((SELECT min(time) FROM r), (SELECT max(time) FROM r), INTERVAL 1 HOUR)) AS time),
  gd AS (SELECT DISTINCT CAST(time AS DATE) AS d FROM (SELECT time FROM gx EXCEPT SELECT time FROM r)),
  u AS (SELECT * FROM r UNION ALL
        SELECT * FROM s1 WHERE source = 'daily_fc' AND CAST(time AS DATE) IN (SELECT d FROM gd))
SELECT lat_i, lon_i, time, min_by(value, prio) FILTER (WHERE value IS NOT NULL) AS value FROM u GROUP BY ALL"""))
def j02_gap_fill(t: Tables):
    """Hindcast days used only where reanalysis misses an hour inside its span."""
    cols = ["prio", *CELL_TIME, "value"]
    return M.gap_limited_fill(by_source(t, "reanalysis", cols), by_source(t, "daily_fc", cols),
                              [], CELL_TIME, ["value"])


@register("j03_append", q("""
, r AS (SELECT * FROM s1 WHERE source = 'reanalysis'),
  inst AS (SELECT unnest(generate_series((SELECT min(time) FROM r), (SELECT max(time) FROM r), INTERVAL 1 DAY)) AS time),
  md AS (SELECT CAST(time AS DATE) AS d FROM inst WHERE time NOT IN (SELECT time FROM r))
SELECT source, lat_i, lon_i, time, value FROM r
UNION ALL SELECT source, lat_i, lon_i, time, value FROM s1 WHERE source = 'daily_fc' AND CAST(time AS DATE) IN (SELECT d FROM md)
UNION ALL SELECT source, lat_i, lon_i, time, value FROM s1 WHERE source = 'cont_fc'"""))
def j03_append(t: Tables):
    """Reanalysis + hindcasts of missing days + all continuous, no dedupe."""
    return M.append_missing_days(by_source(t, "reanalysis"), by_source(t, "daily_fc"),
                                 by_source(t, "cont_fc"))


@register("j04_forecast_overlay", q("""
, b AS (SELECT greatest((SELECT min(time) FROM s1 WHERE source = 'reanalysis'),
                        (SELECT min(time) FROM s1 WHERE source = 'cont_fc')) AS o0,
               least((SELECT max(time) FROM s1 WHERE source = 'reanalysis'),
                     (SELECT max(time) FROM s1 WHERE source = 'cont_fc')) AS o1)
SELECT source, lat_i, lon_i, time, value FROM s1, b
WHERE source = 'reanalysis' AND (o1 <= o0 OR time <= o0 - INTERVAL 1 HOUR)
UNION ALL SELECT source, lat_i, lon_i, time, value FROM s1 WHERE source = 'cont_fc'"""))
def j04_forecast_overlay(t: Tables):
    """Earlier data cut before the forecast start, forecast appended."""
    return M.overlay(by_source(t, "reanalysis"), by_source(t, "cont_fc"))


@register("j04_overlay_corrected", q("""
, b AS (SELECT min(time) AS lo, max(time) AS hi FROM s1 WHERE source = 'cont_fc')
SELECT source, lat_i, lon_i, time, value FROM s1, b WHERE source = 'reanalysis' AND (time < lo OR time > hi)
UNION ALL SELECT source, lat_i, lon_i, time, value FROM s1 WHERE source = 'cont_fc'"""))
def j04_overlay_corrected(t: Tables):
    """The corrected overlay: earlier rows outside the forecast's range kept, none inside."""
    return M.overlay(by_source(t, "reanalysis"), by_source(t, "cont_fc"), corrected=True)


_J05 = """
, r AS (SELECT lat_i, lon_i, time, value FROM s1 WHERE source = 'reanalysis'),
  d AS (SELECT lat_i, lon_i, time, value FROM s1 WHERE source = 'daily_fc')"""


@register("j05_outer_merge", q("""
SELECT coalesce(r.lat_i, d.lat_i) AS lat_i, coalesce(r.lon_i, d.lon_i) AS lon_i, coalesce(r.time, d.time) AS time,
       coalesce(r.value, d.value) AS value
FROM r FULL OUTER JOIN d ON r.lat_i = d.lat_i AND r.lon_i = d.lon_i AND r.time = d.time""", extra=_J05))
def j05_outer_merge(t: Tables):
    """Full outer merge of reanalysis and hindcast; reanalysis value first."""
    c = CELL_TIME + ["value"]
    return M.outer_merge(by_source(t, "reanalysis", c), by_source(t, "daily_fc", c), CELL_TIME, ["value"])


@register("j05_conflicts", q("""
SELECT r.lat_i, r.lon_i, r.time, r.value AS left_value, d.value AS right_value, 'value' AS variable
FROM r JOIN d ON r.lat_i = d.lat_i AND r.lon_i = d.lon_i AND r.time = d.time WHERE r.value <> d.value""", extra=_J05))
def j05_conflicts(t: Tables):
    """Keys where both sources hold different values (the merge error list)."""
    c = CELL_TIME + ["value"]
    return M.merge_conflicts(by_source(t, "reanalysis", c), by_source(t, "daily_fc", c), CELL_TIME, ["value"])


@register("j05_conflict_variables", q("""
SELECT r.lat_i, r.lon_i, r.time, CASE v WHEN 'value' THEN r.value WHEN 't2m' THEN r.t2m ELSE r.sp END AS left_value,
       CASE v WHEN 'value' THEN d.value WHEN 't2m' THEN d.t2m ELSE d.sp END AS right_value, v AS variable
FROM (SELECT * FROM s1_surface WHERE source = 'reanalysis') r
JOIN (SELECT * FROM s1_surface WHERE source = 'daily_fc') d ON r.lat_i = d.lat_i AND r.lon_i = d.lon_i AND r.time = d.time,
     (SELECT unnest(['value', 't2m', 'sp']) AS v)
WHERE left_value <> right_value""", "s1_surface"))
def j05_conflict_variables(t: Tables):
    """Conflicts of three variables from one join."""
    v = ["value", "t2m", "sp"]
    s = S.s1_surface(t).select("source", *CELL_TIME, *v)
    return M.merge_conflicts(s.where(F.col("source") == "reanalysis"), s.where(F.col("source") == "daily_fc"), CELL_TIME, v)


@register("u01_concat", q("""
SELECT source, lat_i, lon_i, time, value FROM s1 WHERE source = 'reanalysis'
UNION ALL SELECT source, lat_i, lon_i, time, value FROM s1 WHERE source = 'daily_fc'"""))
def u01_concat(t: Tables):
    """Concatenation along time, duplicates kept."""
    return M.concat(by_source(t, "reanalysis"), by_source(t, "daily_fc"))


@register("so04_merge_time", q("""
SELECT source, lat_i, lon_i, time, value,
       row_number() OVER (PARTITION BY lat_i, lon_i, CAST(time AS DATE) ORDER BY time, source) AS rank
FROM s1 WHERE source IN ('daily_fc', 'cont_fc')"""))
def so04_merge_time(t: Tables):
    """Time-ordered merge of both forecast sources; duplicates not removed.  ``rank`` shows the
    order inside a cell's day."""
    both = M.merge_time(by_source(t, "daily_fc"), by_source(t, "cont_fc"), ties=("lat_i", "lon_i", "source"))
    day = Window.partitionBy("lat_i", "lon_i", F.to_date("time")).orderBy("time", "source")
    return both.withColumn("rank", F.row_number().over(day).cast("bigint"))


# Offsets of the targets from a cell's node, in cells: the node itself, a point on
# each grid line, one inside, and one before the first row.
OFFSETS = ((0.0, 0.0), (0.0, 0.25), (0.5, 0.0), (0.5, 0.75), (-1.0, 0.5))


def regrid_targets(t: Tables):
    """Target points around every cell of the S1 grid; those of the last rows and columns lie on its edge or outside."""
    cells = S.s1(t).select("lat_i", "lon_i").distinct()
    off = F.explode(F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y, x in OFFSETS])).alias("o")
    return cells.select("*", off).select((F.lit(S.LAT0) + F.lit(S.DLAT) * (F.col("lat_i") + F.col("o.y"))).alias("t_lat"),
                                         (F.lit(S.LON0) + F.lit(S.DLON) * (F.col("lon_i") + F.col("o.x"))).alias("t_lon")).distinct()


def _regrid_sql(source: str, name: str, targets: str) -> str:
    return f"""
  {name}_f AS (SELECT t_lat, t_lon, (t_lat - {S.LAT0}) / {S.DLAT} AS fy, (t_lon - {S.LON0}) / {S.DLON} AS fx FROM {targets}),
  {name}_c AS (SELECT t_lat, t_lon, CAST(floor(fy) AS INT) + di AS lat_i, CAST(floor(fx) AS INT) + dj AS lon_i,
               (CASE WHEN di = 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END)
               * (CASE WHEN dj = 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END) AS w
        FROM {name}_f, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(di, dj)),
  {name}_g AS (SELECT t_lat, t_lon, time, sum(w * value) AS value, count(value) AS n
        FROM {name}_c JOIN (SELECT * FROM s1 WHERE source = '{source}') r USING (lat_i, lon_i) WHERE w > 0
        GROUP BY t_lat, t_lon, time),
  {name}_n AS (SELECT t_lat, t_lon, count(*) AS need FROM {name}_c WHERE w > 0 GROUP BY t_lat, t_lon),
  {name} AS (SELECT n.t_lat, n.t_lon, h.time, CASE WHEN g.n = n.need THEN g.value END AS value
        FROM {name}_n n CROSS JOIN (SELECT DISTINCT time FROM s1 WHERE source = '{source}') h
        LEFT JOIN {name}_g g ON g.t_lat = n.t_lat AND g.t_lon = n.t_lon AND g.time = h.time)"""


_TARGETS = f"""
, tg AS (SELECT DISTINCT {S.LAT0} + {S.DLAT} * (lat_i + oy) AS t_lat, {S.LON0} + {S.DLON} * (lon_i + ox) AS t_lon
         FROM (SELECT DISTINCT lat_i, lon_i FROM s1),
              (VALUES {', '.join(f'({y}::DOUBLE, {x}::DOUBLE)' for y, x in OFFSETS)}) o(oy, ox)),"""


@register("j19_bilinear", q(f"SELECT t_lat, t_lon, time, {rnd_sql('value')} AS value FROM rg",
                            extra=_TARGETS + _regrid_sql("reanalysis", "rg", "tg")))
def j19_bilinear(t: Tables):
    """Reanalysis regridded bilinearly: targets on nodes, grid lines, inside cells and outside;
    NULL where a corner that counts is missing."""
    src = by_source(t, "reanalysis", ["lat_i", "lon_i", "time", "value"])
    out = M.bilinear_regrid(src, regrid_targets(t), "value", S.LAT0, S.DLAT, S.LON0, S.DLON)
    return out.withColumn("value", rnd("value"))


@register("j04_regrid_overlay", q(f"""
, b AS (SELECT greatest((SELECT min(time) FROM e), (SELECT min(time) FROM rg)) AS o0,
               least((SELECT max(time) FROM e), (SELECT max(time) FROM rg)) AS o1)
SELECT t_lat, t_lon, time, value FROM e, b WHERE o1 <= o0 OR time <= o0 - INTERVAL 1 HOUR
UNION ALL SELECT t_lat, t_lon, time, {rnd_sql('value')} FROM rg""", extra=f"""
, e AS (SELECT {S.LAT0} + {S.DLAT} * (lat_i + 0.5::DOUBLE) AS t_lat, lon AS t_lon, time, value FROM s1 WHERE source = 'reanalysis'),
  eg AS (SELECT DISTINCT t_lat, t_lon FROM e),""" + _regrid_sql("cont_fc", "rg", "eg")))
def j04_regrid_overlay(t: Tables):
    """Continuous forecast interpolated to the grid of the earlier data (half a row further north), then overlaid."""
    e = S.s1(t).where(F.col("source") == "reanalysis").select(
        (F.lit(S.LAT0) + F.lit(S.DLAT) * (F.col("lat_i") + F.lit(0.5))).alias("t_lat"), F.col("lon").alias("t_lon"), "time", "value")
    fc = by_source(t, "cont_fc", ["lat_i", "lon_i", "time", "value"])
    fc_on_grid = M.bilinear_regrid(fc, e.select("t_lat", "t_lon").distinct(), "value", S.LAT0, S.DLAT, S.LON0, S.DLON)
    return M.overlay(e, fc_on_grid.withColumn("value", rnd("value")))
