"""Stand-in inputs S1-S7 derived from the driver tables.

Each builder returns a lazy DataFrame (Spark prunes the scans to the
columns used).  ``SQL`` holds the same derivations for DuckDB, used as
CTEs by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firn.functions.timecols import ntz, trunc_hour
from firn.operators.common import spread
from firn.sources.tables import Tables

# Bounds of the S1 sources.
S1_REANALYSIS_END = "2024-01-21 16:00:00"
S1_CONT_FC_START = "2024-01-18 00:00:00"
# The S1 grid; one cell per user, GRID_ROWS rows, columns as many as users need.
GRID_ROWS, LAT0, DLAT, LON0, DLON = 5, 32.0, 3.5, 59.0, 1.0
# The eight pressure levels (hPa) of the level cube.
LEVELS_HPA = (1000, 925, 850, 700, 600, 500, 400, 300)


def s1(t: Tables) -> DataFrame:
    """Three-source hourly forcing: source, prio, lat_i, lon_i, lat, lon, time, value."""
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    et, ts = F.col("event_type"), F.col("ts")
    # every event belongs to a source: what lies outside a source's span is daily hindcast
    src = (F.when((et == "view") & (ts < ntz(S1_REANALYSIS_END)), "reanalysis")
           .when(et.isin("purchase", "error") & (ts >= ntz(S1_CONT_FC_START)), "cont_fc").otherwise("daily_fc"))
    prio = F.when(src == "reanalysis", 1).when(src == "daily_fc", 2).otherwise(3)
    lat_i = (F.col("user_id") % GRID_ROWS).cast("int")
    lon_i = F.floor(F.col("user_id") / GRID_ROWS).cast("int")
    g = (e.select("event_id", "value", trunc_hour(ts).alias("time"), lat_i.alias("lat_i"),
                  lon_i.alias("lon_i"), src.alias("source"), prio.alias("prio"))
         .groupBy("source", "prio", "lat_i", "lon_i", "time")
         .agg(F.min_by("value", "event_id").alias("value")))
    return g.select("source", "prio", "lat_i", "lon_i",
                    (F.lit(LAT0) + F.lit(DLAT) * F.col("lat_i")).alias("lat"),
                    (F.lit(LON0) + F.lit(DLON) * F.col("lon_i")).alias("lon"),
                    "time", "value")


def s1_surface(t: Tables) -> DataFrame:
    """S1 with the surface variables derived from ``value`` (P04-P07 input)."""
    v = F.col("value")
    return s1(t).select("*", (F.lit(250.0) + v / 10).alias("t2m"),
                        (F.lit(90000.0) - v * 10).alias("sp"),
                        F.lit(101325.0).alias("msl"), (v * 10).alias("gh"),
                        (F.lit(100.0) * F.element_at(
                            F.array(*[F.lit(float(x)) for x in LEVELS_HPA]),
                            (F.floor(v) % 8 + 1).cast("int"))).alias("plev"))


def s2(t: Tables) -> DataFrame:
    """Accumulated forecast runs: run_date, cell, step, acc."""
    h = F.hour("ts")
    step = F.when(h < 12, F.floor(h / 3).cast("int") * 3).otherwise(
        F.lit(12) + F.floor((h - 12) / 6).cast("int") * 6)
    b = (t.events.select(F.to_date("ts").alias("run_date"), F.col("user_id").alias("cell"),
                         step.alias("step"), "value")
         .groupBy("run_date", "cell", "step").agg(F.sum("value").alias("v")))
    from pyspark.sql import Window as W
    w = W.partitionBy("run_date", "cell").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return b.select("run_date", "cell", "step", F.sum("v").over(w).alias("acc"))


def _geo(t: Tables, fact: DataFrame, nation_key: str) -> DataFrame:
    zones = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
             .select("n_nationkey", F.col("n_name").alias("zone"), F.col("r_name").alias("region")))
    return fact.join(zones, F.col(nation_key) == F.col("n_nationkey"))


def _day_range(c, first, last):
    """Predicate on a raw timestamp column equal to ``to_date(c) BETWEEN first AND last``
    but pushable into the parquet scan."""
    from firn.functions.timecols import date_lit
    if first is None:
        return F.lit(True)
    return (c >= date_lit(first).cast("timestamp_ntz")) & (
        c < F.date_add(date_lit(last), 1).cast("timestamp_ntz"))


def s3(t: Tables, first: str | None = None, last: str | None = None) -> DataFrame:
    """Pixel values by variable, day, zone, region: variable, date, zone, region, value.

    ``first``/``last`` (inclusive days) restrict the scans with pushable
    predicates; the result equals filtering the full stand-in on ``date``.
    """
    o = (t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
         .where(_day_range(F.col("o_orderdate"), first, last))
         .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")))
    swe = _geo(t, o, "c_nationkey").select(
        F.lit("SWE").alias("variable"), F.to_date("o_orderdate").alias("date"), "zone", "region",
        F.col("o_totalprice").alias("value"))
    li = (t.lineitem.select("l_suppkey", "l_shipdate", "l_quantity", "l_returnflag",
                            "l_extendedprice", "l_discount")
          .where(_day_range(F.col("l_shipdate"), first, last))
          .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
    li = _geo(t, li, "s_nationkey")
    # one scan and one join of lineitem feed both of its variables
    rof_v = F.when(F.col("l_returnflag") == "R", F.lit(-9999.0)).otherwise(
        F.col("l_extendedprice") * F.col("l_discount"))
    both = F.array(F.struct(F.lit("HS").alias("variable"), F.col("l_quantity").alias("value")),
                   F.struct(F.lit("ROF").alias("variable"), rof_v.alias("value")))
    hs_rof = li.select(F.to_date("l_shipdate").alias("date"), "zone", "region", F.explode(both).alias("_v"))
    hs_rof = hs_rof.select("_v.variable", "date", "zone", "region", "_v.value")
    return swe.unionByName(hs_rof)


def s4a(t: Tables) -> DataFrame:
    """Pixels: pixel, row_i, col_i, x, y (pixel centres, EPSG:32642), cluster."""
    n_sup = t.supplier.agg(F.count(F.lit(1))).scalar()
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("pixel"), F.floor(k / 40).cast("int").alias("row_i"), (k % 40).cast("int").alias("col_i"),
        (F.lit(300000.0) + F.lit(500.0) * (k % 40)).cast("double").alias("x"),
        (F.lit(4500000.0) - F.lit(500.0) * F.floor(k / 40)).cast("double").alias("y"),
        (k % n_sup).alias("cluster"))


def s4b(t: Tables, share: int = 1) -> DataFrame:
    """Cluster series over every date: cluster, date, swe, snd, rof, gst, in pieces of about ``share`` million rows.
    (FIXTURES.md cuts it to 30 days; the whole table is used here.)"""
    # few rows share a cluster and day: brought together first, the groups of a task are bounded
    li = spread(t.lineitem.select(F.col("l_suppkey").alias("cluster"), F.to_date("l_shipdate").alias("date"),
                                  "l_extendedprice", "l_quantity", "l_discount", "l_tax"), t.lineitem.count() // share, "cluster")
    return (li.groupBy("cluster", "date")
            .agg(F.avg("l_extendedprice").alias("swe"), F.avg("l_quantity").alias("snd"),
                 F.avg("l_discount").alias("rof"), F.avg("l_tax").alias("gst")))


# Of ten points, one is in the archive only and one in the latest run only.
ARCHIVE_ONLY, LATEST_ONLY = 3, 7


def s5(t: Tables) -> DataFrame:
    """Archive and latest point series: src, prio, cluster, date, swe, snd, ord.

    ``ord`` is one long that orders the rows of an input like their position in the file would.
    """
    li = t.lineitem
    point = F.col("l_suppkey") % 10
    latest = (point != ARCHIVE_ONLY) & ((point == LATEST_ONLY) | (F.col("l_returnflag") == "R"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return li.select(
        F.when(latest, "latest").otherwise("archive").alias("src"),
        F.when(latest, 2).otherwise(1).alias("prio"),
        F.col("l_suppkey").alias("cluster"), F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("swe"), F.col("l_extendedprice").alias("snd"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * F.lit(1 << 24) + cents).alias("ord"))


# Zone polygon edges of the S6 stand-in (x1, y1, x2, y2 in metres).
S6_EDGES = (
    ("Z_RECT", "R1", 1, 301123.0, 4499877.0, 309123.0, 4499877.0),
    ("Z_RECT", "R1", 2, 309123.0, 4499877.0, 309123.0, 4494123.0),
    ("Z_RECT", "R1", 3, 309123.0, 4494123.0, 301123.0, 4494123.0),
    ("Z_RECT", "R1", 4, 301123.0, 4494123.0, 301123.0, 4499877.0),
    ("Z_TRI", "R1", 1, 305123.0, 4499623.0, 318623.0, 4497123.0),
    ("Z_TRI", "R1", 2, 318623.0, 4497123.0, 306123.0, 4483123.0),
    ("Z_TRI", "R1", 3, 306123.0, 4483123.0, 305123.0, 4499623.0),
    ("Z_EMPTY", "R2", 1, 900123.0, 4499877.0, 901123.0, 4499877.0),
    ("Z_EMPTY", "R2", 2, 901123.0, 4499877.0, 901123.0, 4498123.0),
    ("Z_EMPTY", "R2", 3, 901123.0, 4498123.0, 900123.0, 4499877.0),
)


def s6(spark) -> DataFrame:
    """Zone polygon edges: zone, region, edge, x1, y1, x2, y2."""
    return spark.createDataFrame(list(S6_EDGES),
                                 "zone string, region string, edge int, x1 double, y1 double, x2 double, y2 double")


# Pixel rows and columns of a tile zone, its margin (m) around the pixel centres.
TILE_ROWS, TILE_COLS, MARGIN = 8, 10, 123.0


def tile_rectangles(t: Tables) -> DataFrame:
    """A rectangle around the pixel centres of each tile of the grid: zone, region, x0, x1, y0, y1."""
    r, c = (F.floor(F.col("row_i") / TILE_ROWS).cast("int"), F.floor(F.col("col_i") / TILE_COLS).cast("int"))
    b = s4a(t).groupBy(r.alias("r"), c.alias("c")).agg(
        (F.min("x") - MARGIN).alias("x0"), (F.max("x") + MARGIN).alias("x1"),
        (F.min("y") - MARGIN).alias("y0"), (F.max("y") + MARGIN).alias("y1"))
    return b.select(F.concat(F.lit("T_"), "r", F.lit("_"), "c").alias("zone"),
                    F.concat(F.lit("TR"), F.col("r") % 3).alias("region"), "x0", "x1", "y0", "y1")


def zones(t: Tables) -> DataFrame:
    """All zone polygon edges: the hand-made S6 zones and a rectangle for each tile of the pixel grid."""
    corners = (("x0", "y1"), ("x1", "y1"), ("x1", "y0"), ("x0", "y0"))
    edges = F.array(*[F.struct(F.lit(k + 1).alias("edge"), F.col(x).alias("x1"), F.col(y).alias("y1"),
                               F.col(corners[(k + 1) % 4][0]).alias("x2"), F.col(corners[(k + 1) % 4][1]).alias("y2"))
                      for k, (x, y) in enumerate(corners)])
    tiles = tile_rectangles(t).select("zone", "region", F.explode(edges).alias("e")).select("zone", "region", "e.*")
    return s6(t.spark).unionByName(tiles)


def s7(t: Tables) -> DataFrame:
    """Seven features per pixel for clustering: pixel, f0..f6."""
    e = F.col("embedding")
    return t.embeddings.select(F.col("vec_id").alias("pixel"),
                               *[e.getItem(i).alias(f"f{i}") for i in range(7)])


# ---------------------------------------------------------------------------
# DuckDB text of the same stand-ins (used as CTEs by oracle_sql()).
# ---------------------------------------------------------------------------

_S6_VALUES = ",\n ".join(
    f"('{z}','{r}',{e},{x1},{y1},{x2},{y2})" for z, r, e, x1, y1, x2, y2 in S6_EDGES)

SQL = {
    "s1": f"""
SELECT source, prio, lat_i, lon_i, {LAT0} + {DLAT} * lat_i::DOUBLE AS lat, {LON0} + {DLON} * lon_i::DOUBLE AS lon, time,
       min_by(value, event_id) AS value
FROM (SELECT *, CASE source WHEN 'reanalysis' THEN 1 WHEN 'daily_fc' THEN 2 ELSE 3 END AS prio
      FROM (SELECT event_id, value,
                   CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time,
                   CAST(user_id % {GRID_ROWS} AS INT) AS lat_i, CAST(user_id // {GRID_ROWS} AS INT) AS lon_i,
                   CASE WHEN event_type = 'view' AND ts < TIMESTAMP '{S1_REANALYSIS_END}' THEN 'reanalysis'
                        WHEN event_type IN ('purchase', 'error') AND ts >= TIMESTAMP '{S1_CONT_FC_START}' THEN 'cont_fc'
                        ELSE 'daily_fc' END AS source
            FROM events)) e
GROUP BY source, prio, lat_i, lon_i, time""",
    "s2": """
SELECT run_date, cell, step,
       sum(v) OVER (PARTITION BY run_date, cell ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc
FROM (SELECT CAST(ts AS DATE) AS run_date, user_id AS cell,
             CASE WHEN hour(ts) < 12 THEN CAST(floor(hour(ts) / 3) AS INT) * 3
                  ELSE 12 + CAST(floor((hour(ts) - 12) / 6) AS INT) * 6 END AS step,
             sum(value) AS v
      FROM events GROUP BY 1, 2, 3) b""",
    "s3": """
SELECT 'SWE' AS variable, CAST(o_orderdate AS DATE) AS date, n_name AS zone, r_name AS region, o_totalprice AS value
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT 'HS', CAST(l_shipdate AS DATE), n_name, r_name, l_quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT 'ROF', CAST(l_shipdate AS DATE), n_name, r_name,
       CASE WHEN l_returnflag = 'R' THEN CAST(-9999 AS DOUBLE) ELSE l_extendedprice * l_discount END
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "s4a": """
SELECT c_custkey AS pixel, CAST(floor(c_custkey / 40) AS INT) AS row_i, CAST(c_custkey % 40 AS INT) AS col_i,
       CAST(300000.0 + 500.0 * (c_custkey % 40) AS DOUBLE) AS x, CAST(4500000.0 - 500.0 * floor(c_custkey / 40) AS DOUBLE) AS y,
       c_custkey % (SELECT count(*) FROM supplier) AS cluster
FROM customer""",
    "s4b": """
SELECT l_suppkey AS cluster, CAST(l_shipdate AS DATE) AS date,
       avg(l_extendedprice) AS swe, avg(l_quantity) AS snd, avg(l_discount) AS rof, avg(l_tax) AS gst
FROM lineitem
GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "s5": f"""
SELECT CASE WHEN latest THEN 'latest' ELSE 'archive' END AS src, CASE WHEN latest THEN 2 ELSE 1 END AS prio,
       l_suppkey AS cluster, CAST(l_shipdate AS DATE) AS date, l_quantity AS swe, l_extendedprice AS snd,
       (l_orderkey * 8 + l_linenumber) * {1 << 24} + CAST(round(l_extendedprice * 100) AS BIGINT) AS ord
FROM (SELECT *, l_suppkey % 10 <> {ARCHIVE_ONLY} AND (l_suppkey % 10 = {LATEST_ONLY} OR l_returnflag = 'R') AS latest FROM lineitem)""",
    "s6": f"""
SELECT zone, region, CAST(edge AS INT) AS edge, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
       CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2
FROM (VALUES
 {_S6_VALUES}
) AS t(zone, region, edge, x1, y1, x2, y2)""",
    "zones": f"""
SELECT * FROM s6 UNION ALL
SELECT zone, region, unnest([1, 2, 3, 4]) AS edge, unnest([x0, x1, x1, x0]) AS x1, unnest([y1, y1, y0, y0]) AS y1,
       unnest([x1, x1, x0, x0]) AS x2, unnest([y1, y0, y0, y1]) AS y2
FROM (SELECT 'T_' || (row_i // {TILE_ROWS}) || '_' || (col_i // {TILE_COLS}) AS zone, 'TR' || (row_i // {TILE_ROWS}) % 3 AS region,
             min(x) - {MARGIN} AS x0, max(x) + {MARGIN} AS x1, min(y) - {MARGIN} AS y0, max(y) + {MARGIN} AS y1
      FROM s4a GROUP BY row_i // {TILE_ROWS}, col_i // {TILE_COLS})""",
    "s7": """
SELECT vec_id AS pixel, CAST(embedding[1] AS DOUBLE) AS f0, CAST(embedding[2] AS DOUBLE) AS f1,
       CAST(embedding[3] AS DOUBLE) AS f2, CAST(embedding[4] AS DOUBLE) AS f3, CAST(embedding[5] AS DOUBLE) AS f4,
       CAST(embedding[6] AS DOUBLE) AS f5, CAST(embedding[7] AS DOUBLE) AS f6
FROM embeddings""",
}

# Surface variables derived from S1.value, SQL twin of s1_surface().
SQL["s1_surface"] = f"""
SELECT *, 250.0 + value / 10 AS t2m, 90000.0 - value * 10 AS sp, CAST(101325.0 AS DOUBLE) AS msl,
       value * 10 AS gh,
       100.0 * CAST(([{', '.join(f'{x}.0' for x in LEVELS_HPA)}])[CAST(floor(value) % 8 AS INT) + 1] AS DOUBLE) AS plev
FROM s1"""


def with_ctes(body: str, *names: str, extra: str = "") -> str:
    """``WITH`` clause for the listed stand-ins (plus ``extra`` CTE text)
    followed by ``body``; a body starting with ``,`` adds more CTEs."""
    order = ["s1", "s1_surface", "s2", "s3", "s4a", "s4b", "s5", "s6", "zones", "s7"]
    need = set(names)
    if "s1_surface" in need:
        need.add("s1")
    if "zones" in need:
        need |= {"s4a", "s6"}
    parts = [f"{n} AS ({SQL[n]})" for n in order if n in need]
    if extra.strip():
        parts.append(extra.strip().lstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body
