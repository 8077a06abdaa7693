"""Clustering pixels by standardised terrain features (M01): seeded mini-batch k-means with the centres as a table.

Features are standardised, weighted and rounded to whole units, so sums, distances and centres are integers and do not
depend on how the rows are spread: two runs agree.  The seeds are pixels drawn by a hash; a cluster is named by its seed.
Each round takes one hashed share of the pixels, finds their nearest centres and moves every centre to the mean of all
pixels it has had so far.  Centres are stored after each round.

The nearest centre is exact.  About sqrt(k) of the centres are pivots; each centre belongs to the cell of its nearest
pivot.  A pixel's nearest pivot bounds its distance from above; by the triangle inequality only cells that reach into this
bound, and in them only centres whose own distance from the pivot fits, can hold a nearer one.  These are met by an
equi-join on the cell.  Only the pivots go to every task (and, as a subquery's result, through the driver).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.operators.common import spread
from firn.sources.textio import stored

UNIT = 1 << 16  # of a standard deviation


def draw(id_col: Column, seed: int, use: str) -> Column:
    """A 32-bit number by MD5 of seed, use and id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{use}:"), id_col.cast("string"))), 1, 8), 16, 10).cast("bigint")


def standardise(features: DataFrame, id_col: str, cols: list[str], weights: list[float] | None = None) -> DataFrame:
    """``(id, z)``: features less their mean over their standard deviation, times weight, in whole units of 1 / UNIT; a
    constant or missing feature is 0."""
    s = features.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols])).scalar()

    def unit(c, w):
        sd = s.getField(f"s_{c}")
        z = F.floor((F.col(c) - s.getField(f"m_{c}")) / F.when(sd > 0, sd) * F.lit(float(w) * UNIT) + 0.5)
        return F.coalesce(z.cast("bigint"), F.lit(0).cast("bigint"))
    return features.select(F.col(id_col).alias("id"), F.array(*[unit(c, w) for c, w in zip(cols, weights or [1.0] * len(cols))]).alias("z"))


def square_distance(a: Column, b: Column, n: int) -> Column:
    d = [F.get(a, F.lit(i)) - F.get(b, F.lit(i)) for i in range(n)]
    return sum((x * x for x in d[1:]), d[0] * d[0])


def nearest_centres(points: DataFrame, centres: DataFrame, n: int, seed: int = 2) -> DataFrame:
    """``(id, z, cluster)`` for ``points`` (id, z): the nearest of ``centres`` (cluster, z) of ``n`` dimensions, the least
    cluster on ties."""
    k = centres.count()
    # a point may meet every centre: as the input grows the pieces get more, and the pairs in one do not.  Few points meet
    # more than a quarter
    points = spread(points, points.count() * k // 4, "id")
    step = max(1, round(k ** 0.5))
    some = centres.where((draw(F.col("cluster"), seed, "pivot") % step == 0) | (F.col("cluster") == centres.agg(F.min("cluster")).scalar()))
    pivots = some.agg(F.collect_list(F.struct("cluster", "z"))).scalar()
    gaps = F.transform("_p", lambda p: F.struct(square_distance(F.col("z"), p["z"], n).alias("gap"), p["cluster"].alias("cell")))
    celled = centres.withColumn("_p", pivots).withColumn("_n", F.array_min(gaps))
    celled = stored(celled.select("cluster", "z", F.col("_n.cell").alias("cell"), F.sqrt(F.col("_n.gap").cast("double")).alias("off")), "centres")
    reach = celled.groupBy("cell").agg(F.max("off").alias("reach"))
    cells = some.join(reach, F.col("cluster") == F.col("cell")).agg(F.collect_list(F.struct("cell", "z", "reach"))).scalar()
    near = F.transform("_p", lambda p: F.struct(p["cell"].alias("cell"), p["reach"].alias("reach"),
                                                 F.sqrt(square_distance(F.col("z"), p["z"], n).cast("double")).alias("gap")))
    p = points.withColumn("_p", cells).select("id", "z", near.alias("_c")).withColumn("_bound", F.array_min(F.transform("_c", lambda c: c["gap"])) + 1e-3)
    p = p.select("id", "z", "_bound", F.explode(F.filter("_c", lambda c: c["gap"] - c["reach"] <= F.col("_bound"))).alias("c"))
    p, c = p.select("id", "z", "_bound", "c.cell", "c.gap").alias("p"), celled.alias("c")
    met = p.join(c, (F.col("p.cell") == F.col("c.cell")) & (F.abs(F.col("p.gap") - F.col("c.off")) <= F.col("p._bound")))
    found = met.select("p.id", "p.z", F.struct(square_distance(F.col("p.z"), F.col("c.z"), n).alias("gap"), F.col("c.cluster").alias("cluster")).alias("m"))
    return found.groupBy("id").agg(F.any_value("z").alias("z"), F.min("m").alias("m")).select("id", "z", F.col("m.cluster").alias("cluster"))


def seeds(points: DataFrame, k: int | None, members: int, seed: int) -> DataFrame:
    """``(cluster, n, z)``: the first centres.  One pixel in ``members`` by its hash (at least the one of least hash), or, where ``k`` is
    given, the ``k`` of least hash."""
    order = draw(F.col("id"), seed, "seed")
    if k:
        drawn = points.orderBy(order, "id").limit(k)
    else:
        first = points.agg(F.min_by("id", F.struct(order, "id"))).scalar()
        drawn = points.where((order % members == 0) | (F.col("id") == first))
    return drawn.select(F.col("id").alias("cluster"), F.lit(0).cast("bigint").alias("n"), "z")


def cluster_pixels(features: DataFrame, id_col: str, cols: list[str], k: int | None = None, members: int = 50, seed: int = 2,
                   batches: int = 4, epochs: int = 1, weights: list[float] | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns pixel -> cluster, with the features; and the centroids: the mean of the raw member features, with their
    number.  Labels are not expected to equal another implementation's."""
    n = len(cols)
    points = stored(standardise(features, id_col, cols, weights), "features")
    centres = stored(seeds(points, k, members, seed), "centres")
    for step in range(batches * epochs):
        share = points.where(draw(F.col("id"), seed, "batch") % batches == step % batches)
        moved = nearest_centres(share, centres.select("cluster", "z"), n, seed).groupBy("cluster").agg(
            F.count(F.lit(1)).alias("m"), *[F.sum(F.get("z", F.lit(i))).alias(f"s{i}") for i in range(n)])
        at = [F.when(F.col("m") > 0, F.floor((F.col("n") * F.get("z", F.lit(i)) + F.col(f"s{i}")) / (F.col("n") + F.col("m"))))
              .otherwise(F.get("z", F.lit(i))).cast("bigint") for i in range(n)]
        centres = stored(centres.join(moved, "cluster", "left").select(
            "cluster", (F.col("n") + F.coalesce("m", F.lit(0))).alias("n"), F.array(*at).alias("z")), "centres")
    labels = nearest_centres(points, centres.select("cluster", "z"), n, seed).select(F.col("id").alias(id_col), "cluster")
    assigned = stored(features.select(id_col, *cols).join(labels, id_col), "clusters")
    centroids = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_pixels"), *[F.avg(c).alias(c) for c in cols])
    return assigned, centroids
