"""Zone polygons (S6) over the S4a pixel grid; zonal means of the S4b
cluster series through them."""

from __future__ import annotations

from pyspark.sql import functions as F

from firn.functions import crs as C
from firn.functions import geodesy as GD
from firn.functions.geodesy import tm_inverse
from firn.functions.numeric import rnd, rnd_sql
from firn.operators import common as CM
from firn.operators import geometry as G
from firn.operators import raster as R
from firn.operators import zonal as Z
from firn.plans.registry import register
from firn.sources import standins as S
from firn.sources.tables import Tables
from firn.sources.textio import stored

PIXEL = 500.0


def q(body: str, *names: str, extra: str = "") -> str:
    return S.with_ctes(body, *names, extra=extra)


def _inside_sql(dx: float, dy: float) -> str:
    return f"""
zp AS (SELECT e.zone, p.pixel FROM s4a p JOIN zones e
         ON ((e.y1 <= p.y + {dy}) <> (e.y2 <= p.y + {dy}))
        AND p.x + {dx} < e.x1 + (p.y + {dy} - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
       GROUP BY e.zone, p.pixel HAVING count(*) % 2 = 1)"""


@register("j11_zone_pixels", q("SELECT zone, pixel FROM zp", "s4a", "zones", extra=_inside_sql(0.0, 0.0)))
def j11_zone_pixels(t: Tables):
    """Pixels whose centre lies in each zone (scanline fill, equi-joins only);
    hand-made zones and a tile zone for every block of the grid."""
    return G.zone_pixels(S.zones(t), S.s4a(t), PIXEL).select("zone", "pixel")


@register("j11_corner_as_center", q("SELECT zone, pixel FROM zp", "s4a", "zones",
                                    extra=_inside_sql(-PIXEL / 2, PIXEL / 2)))
def j11_corner_as_center(t: Tables):
    """Same with the upper-left corner tested (half-pixel NW shift as coded)."""
    return G.zone_pixels(S.zones(t), S.s4a(t), PIXEL, coord="corner_as_center").select("zone", "pixel")


@register("j11_zone_runs", q("""
SELECT zone, row_i, min(col_i) AS first, max(col_i) AS last, count(*) AS n_pixels
FROM (SELECT zone, row_i, col_i, col_i - row_number() OVER (PARTITION BY zone, row_i ORDER BY col_i) AS grp FROM zp JOIN s4a USING (pixel))
GROUP BY zone, row_i, grp""", "s4a", "zones", extra=_inside_sql(0.0, 0.0)))
def j11_zone_runs(t: Tables):
    """The same cover in run lengths: first and last column of each run of a pixel row, and its pixels.  Runs are cut to
    the columns that the grid's row has (its first pixel and the end of its last row are missing)."""
    pixels = S.s4a(t)
    runs = G.zone_runs(S.zones(t), pixels, PIXEL)
    rows = pixels.groupBy("row_i").agg(F.min("col_i").alias("lo"), F.max("col_i").alias("hi"))
    cut = runs.join(rows, "row_i").select("zone", "row_i", F.greatest("first", "lo").alias("first"), F.least("last", "hi").alias("last"))
    cut = cut.where("first <= last")
    return cut.withColumn("n_pixels", (F.col("last") - F.col("first") + 1).cast("bigint"))


@register("m02_cluster_weights", q("SELECT zone, cluster, count(*) AS n FROM zp JOIN s4a USING (pixel) GROUP BY ALL",
                                   "s4a", "zones", extra=_inside_sql(0.0, 0.0)))
def m02_cluster_weights(t: Tables):
    """Pixels of each cluster in each zone, as differences of prefix counts at the ends of runs."""
    pixels = S.s4a(t)
    return G.cluster_weights(G.zone_runs(S.zones(t), pixels, PIXEL), pixels)


_A01P = _inside_sql(0.0, 0.0) + f""",
zn AS (SELECT DISTINCT zone FROM zones),
dt AS (SELECT DISTINCT date FROM s4b),
v AS (SELECT zp.zone, s4b.date, s4b.swe FROM zp JOIN s4a USING (pixel) JOIN s4b USING (cluster))
"""


_A01P_BODY = f"""
SELECT dt.date, zn.zone, {rnd_sql('avg(v.swe)')} AS mean
FROM dt CROSS JOIN zn LEFT JOIN v ON v.date = dt.date AND v.zone = zn.zone
GROUP BY dt.date, zn.zone"""


def polygon_inputs(t: Tables):
    edges = S.zones(t)
    return G.zone_pixels(edges, S.s4a(t), PIXEL), edges.select("zone")


@register("a01_polygon_zonal_mean", q(_A01P_BODY, "s4a", "s4b", "zones", extra=_A01P))
def a01_polygon_zonal_mean(t: Tables):
    """Daily zonal mean of SWE over polygon pixels; an empty zone is NULL."""
    zp, zones = polygon_inputs(t)
    s4b = stored(S.s4b(t).select("cluster", "date", "swe"), "cluster-series")
    pixels = stored(zp.select("zone", "pixel", "cluster"), "pixels")
    blocks = CM.Blocks(s4b, pixels, zones, ["date"])
    vals = R.cluster_to_pixel_to_group(pixels, s4b, blocks=blocks)
    zm = Z.zonal_mean(vals.select(CM.BLOCK, "date", "zone", F.col("swe").alias("value")), zones, keys=("date",),
                      key_rows=s4b, blocks=blocks)
    return zm.select("date", "zone", rnd("mean").alias("mean"))


@register("m02_factorised_mean", q(_A01P_BODY, "s4a", "s4b", "zones", extra=_A01P))
def m02_factorised_mean(t: Tables):
    """The same zonal mean from per-(zone, cluster) pixel counts; no pixel x day table and no row per zone pixel."""
    edges, pixels = S.zones(t), S.s4a(t)
    weights = G.cluster_weights(G.zone_runs(edges, pixels, PIXEL), pixels)
    zm = G.factorised_zonal_mean(weights, S.s4b(t), ["date"], "swe", edges.select("zone"))
    return zm.select("date", "zone", rnd("mean").alias("mean"))


# Margin (m) of the nation rectangles around their pixel centres; shift (m) of their second part.
MARGIN, PART_SHIFT = 123.0, 100_000.0


def nation_rectangles(t: Tables):
    """Per nation the rectangle around its customers' pixel centres, in
    metres, and a second part of the same shape further east."""
    px = S.s4a(t).join(t.customer.select(F.col("c_custkey").alias("pixel"), "c_nationkey"), "pixel")
    px = px.join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("zone"),
                                 "n_regionkey"), "c_nationkey")
    b = px.groupBy("zone", "n_regionkey").agg(
        (F.min("x") - MARGIN).alias("x0"), (F.max("x") + MARGIN).alias("x1"),
        (F.min("y") - MARGIN).alias("y0"), (F.max("y") + MARGIN).alias("y1"))
    b = b.withColumn("dx", F.explode(F.array(F.lit(0.0), F.lit(PART_SHIFT))))
    return b.select("zone", F.col("n_regionkey").cast("string").alias("region"), (F.col("x0") + F.col("dx")).alias("x0"),
                    (F.col("x1") + F.col("dx")).alias("x1"), "y0", "y1")


def wgs84_rings(t: Tables):
    """Nation rectangles as closed lon/lat rings, two for each zone (what a polygon file
    without CRS holds): NW, NE, SE, SW, NW."""
    def vertex(x, y):
        lon, lat = tm_inverse(F.col(x), F.col(y))
        return F.struct(lon.alias("lon"), lat.alias("lat"))
    corners = [("x0", "y1"), ("x1", "y1"), ("x1", "y0"), ("x0", "y0"), ("x0", "y1")]
    return nation_rectangles(t).select("zone", "region", F.array(*[vertex(x, y) for x, y in corners]).alias("ring"))


_RECT_SQL = f"""
, px AS (SELECT s4a.x, s4a.y, n_name AS zone, CAST(n_regionkey AS VARCHAR) AS region
         FROM s4a JOIN customer ON pixel = c_custkey JOIN nation ON c_nationkey = n_nationkey),
  r AS (SELECT zone, region, min(x) - {MARGIN} AS x0, max(x) + {MARGIN} AS x1,
               min(y) - {MARGIN} AS y0, max(y) + {MARGIN} AS y1 FROM px GROUP BY zone, region),
  b AS (SELECT * FROM r UNION ALL SELECT zone, region, x0 + {PART_SHIFT}, x1 + {PART_SHIFT}, y0, y1 FROM r),
  e AS (SELECT zone, region, 1 AS edge, x0 AS x1, y1 AS y1, x1 AS x2, y1 AS y2 FROM b
        UNION ALL SELECT zone, region, 2, x1, y1, x1, y0 FROM b
        UNION ALL SELECT zone, region, 3, x1, y0, x0, y0 FROM b
        UNION ALL SELECT zone, region, 4, x0, y0, x0, y1 FROM b)"""


@register("io11_zone_load", q("""
SELECT zone, region, CAST(edge AS INT) AS edge, round(x1, 2) AS x1, round(y1, 2) AS y1,
       round(x2, 2) AS x2, round(y2, 2) AS y2 FROM e""", "s4a", extra=_RECT_SQL))
def io11_zone_load(t: Tables):
    """Two-part zones stored as WGS84 rings (no CRS), loaded and projected to grid
    metres, split into numbered edges."""
    e = G.ring_to_edges(G.project_rings(wgs84_rings(t)))
    return e.select("zone", "region", "edge", *[F.round(c, 2).alias(c) for c in ("x1", "y1", "x2", "y2")])


# Systems that zone files come in: the next UTM zone, another ellipsoid and datum, a conic.
FILE_SYSTEMS = ("EPSG:32643", "EPSG:28412", "EPSG:3034")


def rings_in(t: Tables, code: str):
    """The nation rectangles' rings as a file in another system would have them."""
    crs = C.by_code(code)
    ring = F.col("ring")
    if crs.shift:  # WGS84 to the datum: the reverse shift, three times for what its linear form leaves
        def there(p):
            return F.struct(*[c.alias(n) for c, n in zip(GD.to_geocentric(p["lon"], p["lat"], **C.Crs().axes), "XYZ")])
        want, now = F.transform(ring, there), F.transform(ring, there)
        for _ in range(3):
            now = F.zip_with(want, now, lambda w, q: F.struct(*[
                (q[n] + w[n] - c).alias(n) for c, n in zip(GD.helmert(q["X"], q["Y"], q["Z"], crs.shift), "XYZ")]))

        def back(p):
            lon, lat = GD.from_geocentric(p["X"], p["Y"], p["Z"], **crs.axes)
            return F.struct(lon.alias("lon"), lat.alias("lat"))
        ring = F.transform(now, back)
    plain = C.Crs(crs.ellipsoid, crs.projection, crs.params)
    return wgs84_rings(t).select("zone", "region", C.from_lonlat(ring, plain).alias("ring"))


@register("io11_any_crs", q("""
SELECT crs, zone, region, CAST(edge AS INT) AS edge, round(x1, 2) AS x1, round(y1, 2) AS y1,
       round(x2, 2) AS x2, round(y2, 2) AS y2 FROM e CROSS JOIN (SELECT unnest(['""" + "', '".join(FILE_SYSTEMS) + """']) AS crs)""", "s4a", extra=_RECT_SQL))
def io11_any_crs(t: Tables):
    """The same zones from files in three other systems, each to the centimetre in grid metres."""
    out = None
    for code in FILE_SYSTEMS:
        e = G.ring_to_edges(G.project_rings(rings_in(t, code), crs=code))
        e = e.select(F.lit(code).alias("crs"), "zone", "region", "edge", *[F.round(c, 2).alias(c) for c in ("x1", "y1", "x2", "y2")])
        out = e if out is None else out.unionByName(e)
    return out
