"""Zone polygons on a pixel grid (J11, IO11) and zonal means over them
(A01 on polygons, M02 factorised).

Point-in-polygon is a scanline fill written as joins and aggregates:
each polygon edge yields its crossing x for every pixel row it spans; the
sorted crossings of a (zone, row) pair up into inside intervals
[c1, c2), [c3, c4), ...; the intervals expand to candidate columns that
are equi-joined to the pixel table and checked exactly.  Work is
proportional to edges x rows spanned plus the pixels inside: there is no
range join and no pixel x edge product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firn.functions import crs as C
from firn.operators.common import BLOCK, Blocks
from firn.operators.zonal import every_zone_in_blocks
from firn.sources.textio import stored


def ring_to_edges(zones: DataFrame, ring: str = "ring", keys=("zone", "region"),
                  x: str = "x", y: str = "y") -> DataFrame:
    """Explode a vertex ring (array of structs, closing vertex optional)
    into numbered edges (zone, region, edge, x1, y1, x2, y2).  Edges of all rings of a zone
    count together in the crossing rule, so parts add up and holes are left out."""
    keys = list(keys)
    r = F.col(ring)
    # drop a repeated closing vertex
    closed = F.when((F.size(r) > 1) & (F.element_at(r, 1) == F.element_at(r, -1)),
                    F.slice(r, 1, F.size(r) - 1)).otherwise(r)
    z = zones.select(*keys, closed.alias("_r"))
    n = F.size("_r")
    idx = F.sequence(F.lit(0), n - 1)
    e = z.select(*keys, F.explode(F.transform(idx, lambda i: F.struct(
        (i + 1).alias("edge"), F.col("_r")[i].alias("a"), F.col("_r")[(i + 1) % n].alias("b")))).alias("_e"))
    return e.select(*keys, F.col("_e.edge").cast("int").alias("edge"),
                    F.col(f"_e.a.{x}").alias("x1"), F.col(f"_e.a.{y}").alias("y1"),
                    F.col(f"_e.b.{x}").alias("x2"), F.col(f"_e.b.{y}").alias("y2"))


# Fixed value: the coordinate system of the pixel grid.
GRID_CRS = "EPSG:32642"


def project_rings(zones: DataFrame, ring: str = "ring", keys=("zone", "region"), crs: str | None = None,
                  grid: str = GRID_CRS) -> DataFrame:
    """Zone rings in grid metres (IO11).  ``crs`` is the code of the file's system (WGS84 when None, as a file without
    one): vertices are points (lon, lat) of a geographic system or (x, y) of a projected one.  They are taken to WGS84 and
    projected to ``grid`` in place, vertex by vertex, without a shuffle; rings already in the grid's
    system pass through; an unknown code is refused.  A zone may have
    any number of rows, one for each ring (parts and holes)."""
    if crs is not None and crs.upper() == grid.upper():
        return zones.select(*keys, ring)
    lonlat = C.to_lonlat(F.col(ring), C.by_code(crs))
    return zones.select(*keys, C.from_lonlat(lonlat, C.by_code(grid)).alias(ring))


def _intervals(edges: DataFrame, pixels: DataFrame, res: float, coord: str, zone: str, row: str, col: str):
    """Inside intervals [a, b) per zone and pixel row, pixels with their test points, and the grid."""
    shift_x, shift_y = (0.0, 0.0) if coord == "center" else (-res / 2, res / 2)
    px = pixels.select("*", (F.col("x") + shift_x).alias("_px"), (F.col("y") + shift_y).alias("_py"))
    # grid of test points: y_r = y_top - r*res, x_c = x_left + c*res
    # one aggregate over the pixels, referenced as a reused scalar subquery
    g = px.agg(F.struct(F.max(F.col("_py") + F.col(row) * res).alias("y_top"),
                        F.min(F.col("_px") - F.col(col) * res).alias("x_left"),
                        F.max(row).alias("max_row"), F.max(col).alias("max_col"))).scalar()
    y_top, max_row = g.getField("y_top"), g.getField("max_row")
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    # candidate rows (one row of margin each side), clipped to the grid
    r_first = F.greatest(F.floor((y_top - hi) / res).cast("int"), F.lit(0))
    r_last = F.least(F.floor((y_top - lo) / res).cast("int") + 1, max_row)
    e = (edges.where((F.col("y1") != F.col("y2")) & (r_first <= r_last))
         .select(zone, "x1", "y1", "x2", "y2", F.explode(F.sequence(r_first, r_last)).alias(row)))
    yr = y_top - F.col(row) * res
    e = e.where((F.col("y1") <= yr) != (F.col("y2") <= yr))
    xc = F.col("x1") + (yr - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    cr = e.select(zone, row, xc.alias("xc"))
    w = Window.partitionBy(zone, row).orderBy("xc")
    pairs = (cr.withColumn("_k", F.floor((F.row_number().over(w) - 1) / 2))
             .groupBy(zone, row, "_k").agg(F.min("xc").alias("a"), F.max("xc").alias("b")))
    return pairs, px, g


def zone_runs(edges: DataFrame, pixels: DataFrame, res: float, coord: str = "center",
              zone: str = "zone", row: str = "row_i", col: str = "col_i") -> DataFrame:
    """The cover of each zone in run lengths: (zone, row, first, last), columns inclusive.  The rule is that of
    ``zone_pixels``; no row per pixel inside, so the cover of a large zone is as long as it is high."""
    pairs, _, g = _intervals(edges, pixels, res, coord, zone, row, col)
    left = g.getField("x_left")

    def first_at(x):
        """Least column whose test point is at x or east of it; the quotient may be off by one."""
        c = F.floor((x - left) / res).cast("int")
        return c + F.when(left + c * res >= x, 0).when(left + (c + 1) * res >= x, 1).otherwise(2)
    runs = pairs.select(zone, row, F.greatest(first_at(F.col("a")), F.lit(0)).alias("first"),
                        F.least(first_at(F.col("b")) - 1, g.getField("max_col")).alias("last"))
    return runs.where("first <= last")


def zone_pixels(edges: DataFrame, pixels: DataFrame, res: float, coord: str = "center",
                zone: str = "zone", row: str = "row_i", col: str = "col_i") -> DataFrame:
    """Pixels whose test point lies inside each zone (J11), as
    (zone, pixel columns...).  Crossing rule: edge counts for a point
    (x, y) when (y1 <= y) <> (y2 <= y) and x < x1 + (y - y1)(x2 - x1)/(y2 - y1);
    odd count = inside.  ``coord='center'`` tests the pixel centre;
    ``'corner_as_center'`` tests the upper-left corner, the half-pixel
    north-west shift of the operational chain.  Overlapping zones each
    get the pixel."""
    pairs, px, g = _intervals(edges, pixels, res, coord, zone, row, col)
    x_left, max_col = g.getField("x_left"), g.getField("max_col")
    c_first = F.greatest(F.floor((F.col("a") - x_left) / res).cast("int"), F.lit(0))
    c_last = F.least(F.floor((F.col("b") - x_left) / res).cast("int") + 1, max_col)
    cand = (pairs.where(c_first <= c_last)
            .select(zone, row, "a", "b", F.explode(F.sequence(c_first, c_last)).alias(col)))
    # intervals of one (zone, row) are disjoint, so each pixel matches once
    inside = cand.join(px, [row, col]).where((F.col("_px") >= F.col("a")) & (F.col("_px") < F.col("b")))
    return inside.select(zone, *pixels.columns)


def cluster_weights(runs: DataFrame, pixels: DataFrame, zone: str = "zone", cluster: str = "cluster",
                    row: str = "row_i", col: str = "col_i") -> DataFrame:
    """(zone, cluster, n): pixels of each cluster inside each zone, from run lengths.

    A pixel row is one record with the ordered columns of each of its clusters, which are their prefix counts: a
    run holds those up to its last column less those before its first.  A run meets one record and gives one row
    for each cluster in it, so no pixel of its inside is ever a row.  A record is as wide as the grid."""
    columns = pixels.groupBy(row, cluster).agg(F.sort_array(F.collect_list(col)).alias("cols"))
    records = columns.groupBy(row).agg(F.collect_list(F.struct(cluster, "cols")).alias("clusters"))

    def upto(cols, limit):
        return F.size(F.filter(cols, lambda c: c <= limit))
    inside = F.transform("clusters", lambda p: F.struct(
        p[cluster].alias(cluster), (upto(p["cols"], F.col("last")) - upto(p["cols"], F.col("first") - 1)).alias("n")))
    met = runs.join(records, row).select(zone, F.explode(F.filter(inside, lambda p: p["n"] > 0)).alias("p"))
    return met.groupBy(zone, F.col(f"p.{cluster}").alias(cluster)).agg(F.sum("p.n").alias("n"))


def pixel_weights(zone_pixel: DataFrame, zone: str = "zone", cluster: str = "cluster") -> DataFrame:
    """The same weights counted from a table of zone pixels."""
    return zone_pixel.groupBy(zone, cluster).agg(F.count(F.lit(1)).alias("n"))


def factorised_zonal_mean(weights: DataFrame, series: DataFrame, keys: list[str],
                          value: str | list[str], zones: DataFrame, zone: str = "zone",
                          cluster: str = "cluster", blocks: Blocks | None = None) -> DataFrame:
    """Zonal mean of cluster values spread over pixels without building the
    pixel x day table (M02): with the weights n(zone, cluster),
    sum(n*v)/sum(n) over non-NULL v per key and zone.  Equal to the mean
    over pixels; zones of ``zones`` without pixels or values are NULL.  Series and weights are stored, counted and
    joined in blocks of zones and days, where the joined rows are grouped without a shuffle.  Several values of one
    series are joined once and give a column each, by their names (one: ``mean``).  With ``blocks`` the caller
    has stored the tables and made the blocks, and the rows keep them for the next step."""
    values = {value: "mean"} if isinstance(value, str) else {v: v for v in value}
    own = blocks is None
    if own:
        series, weights = stored(series.select(cluster, *keys, *values), "series"), stored(weights, "weights")
        blocks = Blocks(series, weights, zones, keys, zone)
    j = blocks.join(series, weights, cluster)
    means = j.groupBy(BLOCK, *keys, zone).agg(*[
        (F.sum(F.col("n") * F.col(v)) / F.sum(F.when(F.col(v).isNotNull(), F.col("n")))).alias(name) for v, name in values.items()])
    out = every_zone_in_blocks(means, blocks, list(values.values()))
    return out.drop(BLOCK) if own else out
