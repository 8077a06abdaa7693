"""Rasters as tables: cluster->pixel expansion, grid coordinates,
reprojection, band/timestep selection, product names (J12, J15, G05,
P17, P21, P22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.functions.geodesy import tm_forward
from firn.operators.common import Blocks, join_spread
from firn.sources.textio import stored

# Model variable -> (product name, unit); others are upper-cased.
PRODUCT_NAMES = {"swe": ("SWE", "mm"), "snd": ("HS", "m"), "rof": ("ROF", "mm"), "gst": ("GST", "k")}


def cluster_to_pixel(pixels: DataFrame, series: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Spread cluster series over their pixels (J15, inner join).

    No hint: the planner broadcasts the series only when its size is known
    to be under ``autoBroadcastJoinThreshold``, and AQE re-checks the
    materialised size at runtime (then a cluster owning a third of all
    pixels costs nothing extra).  Otherwise both sides shuffle on the
    cluster and AQE's skew-join splits the hot cluster's partition."""
    return pixels.join(series, cluster)


def cluster_to_pixel_to_group(pixels: DataFrame, series: DataFrame, cluster: str = "cluster", blocks: Blocks | None = None) -> DataFrame:
    """The same for pixel rows that are grouped next.  With ``blocks`` of zones and days the join is made inside them, and its rows,
    one for each pixel and day, need no shuffle to be grouped by zone and day; else it is cut by their number.
    ``series`` is read twice."""
    if blocks is not None:
        return blocks.join(series, pixels, cluster)
    return join_spread(stored(pixels, "pixels"), series, cluster)


def cluster_to_pixel_in_order(pixels: DataFrame, series: DataFrame, order: list[str], cluster: str = "cluster") -> DataFrame:
    """The same for a ``series`` that is partitioned by cluster, in ``order`` inside each of its pieces.

    The series is sorted before it is spread: its rows, not those of all pixels, and they meet a hash table of a
    piece's pixels as they come, which keeps their order.  So pixel rows are neither shuffled nor sorted."""
    # the running number stands between sort and join; without it the optimizer drops a sort below a join
    s = series.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    j = s.where(F.col("_at") >= 0).join(pixels.hint("shuffle_hash"), cluster)
    return j.select(*pixels.columns, *[c for c in series.columns if c != cluster])


def product_names(var: Column) -> tuple[Column, Column]:
    """(product name, unit) of a model variable; unknown names upper-cased
    with a NULL unit (P17).  A literal map lookup, no join."""
    names = F.create_map(*[x for k, (n, _) in PRODUCT_NAMES.items() for x in (F.lit(k), F.lit(n))])
    units = F.create_map(*[x for k, (_, u) in PRODUCT_NAMES.items() for x in (F.lit(k), F.lit(u))])
    return F.coalesce(F.element_at(names, var), F.upper(var)), F.element_at(units, var)


def first_band(stack: DataFrame, band: str = "band") -> DataFrame:
    """Rows of the first band."""
    return stack.where(F.col(band) == 1)


def first_timestep(df: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """Per key and day the value of the first timestep."""
    return (df.groupBy(*keys, F.to_date(time).alias("date"))
            .agg(F.min_by(value, time).alias(value), F.min(time).alias("first_time")))


def corner_coords(pixels: DataFrame, dx: float, dy: float, row: str = "row_i", col: str = "col_i",
                  x: str = "x", y: str = "y") -> DataFrame:
    """Upper-left corner coordinates x0 + col*dx, y0 - row*dy, with the
    origin rebuilt from the pixel centres (G05)."""
    o = pixels.agg(F.struct(F.min(F.col(x) - F.col(col) * dx).alias("x"),
                            F.max(F.col(y) + F.col(row) * dy).alias("y"))).scalar()
    x0, y0 = o.getField("x") - F.lit(dx / 2), o.getField("y") + F.lit(dy / 2)
    return pixels.select("*", (x0 + F.col(col) * dx).alias("x_corner"),
                         (y0 - F.col(row) * dy).alias("y_corner"))


def target_grid(rows: DataFrame, lon0: float, lat_top: float, res: float, n_lon: int) -> DataFrame:
    """Regular lon/lat target grid of cell centres for the given rows (column
    ``t_row``), ``n_lon`` cells each, generated where the rows are."""
    t_row, t_col = F.col("t_row"), F.col("t_col")
    return rows.select(t_row, F.explode(F.sequence(F.lit(0), F.lit(n_lon - 1))).alias("t_col")).select(
        t_row, t_col, (F.lit(lon0) + (t_col + 0.5) * F.lit(res)).alias("t_lon"),
        (F.lit(lat_top) - (t_row + 0.5) * F.lit(res)).alias("t_lat"))


def reproject_nearest(targets: DataFrame, pixels: DataFrame, x_left: float, y_top: float,
                      res: float, row: str = "row_i", col: str = "col_i") -> DataFrame:
    """Nearest-neighbour map from target lon/lat cells to source pixels of a
    projected grid (J12): each target centre is projected forward and
    floored to a (row, col) key, then equi-joined to the pixels -- no range
    join.  Cells falling outside the source grid have no match."""
    ex, ny = tm_forward(F.col("t_lon"), F.col("t_lat"))
    t = targets.select("*", F.floor((ex - F.lit(x_left)) / F.lit(res)).cast("int").alias(col),
                       F.floor((F.lit(y_top) - ny) / F.lit(res)).cast("int").alias(row))
    return t.join(pixels, [row, col])
