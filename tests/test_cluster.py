"""Mini-batch k-means with centres as a table: exact nearest centres, the same result however rows are spread."""

import random

import numpy as np
from pyspark.sql import functions as F

from firn.operators import cluster as C


def points(n, dims, seed, spread=1.0):
    rnd = random.Random(seed)
    hubs = [[rnd.gauss(0, 3) for _ in range(dims)] for _ in range(9)]
    return [(i, *[h + rnd.gauss(0, spread) for h in rnd.choice(hubs)]) for i in range(n)]


def frame(spark, rows, dims, parts=4):
    return spark.createDataFrame(rows, "pixel long, " + ", ".join(f"f{k} double" for k in range(dims))).repartition(parts)


def test_nearest_equals_brute_force(spark):
    for dims, k, seed in ((7, 90, 1), (2, 400, 2), (3, 1, 3)):
        rnd = random.Random(seed)
        pts = [(i, [int(x * C.UNIT) for x in p[1:]]) for i, p in enumerate(points(600, dims, seed))]
        ctr = [(1000 + i, [int(x * C.UNIT) for x in p[1:]]) for i, p in enumerate(points(k, dims, seed + 50))]
        ctr += [(5000 + i, list(c[1])) for i, c in enumerate(rnd.sample(ctr, min(k, 5)))]  # ties
        p, c = (spark.createDataFrame(x, f"{n} long, z array<long>") for x, n in ((pts, "id"), (ctr, "cluster")))
        got = {r.id: r.cluster for r in C.nearest_centres(p, c, dims).collect()}
        z = np.array([x[1] for x in ctr], dtype=object)
        for i, x in pts:
            gaps = ((z - np.array(x, dtype=object)) ** 2).sum(1)
            assert got[i] == min(ctr[j][0] for j in np.flatnonzero(gaps == gaps.min()))


def test_runs_agree_however_the_rows_are_spread(spark):
    rows = points(800, 4, 7)
    cols = [f"f{k}" for k in range(4)]
    runs = [{r.pixel: r.cluster for r in C.cluster_pixels(frame(spark, rows, 4, n), "pixel", cols, members=20)[0].collect()} for n in (1, 7)]
    assert runs[0] == runs[1] and len(runs[0]) == 800 and len(set(runs[0].values())) > 10


def test_clusters_are_compact(spark):
    """Far tighter than clusters of the same sizes drawn at random."""
    rows = points(1500, 5, 4, spread=0.3)
    cols = [f"f{k}" for k in range(5)]
    assigned, centroids = C.cluster_pixels(frame(spark, rows, 5), "pixel", cols, k=30, epochs=2)
    assert centroids.count() <= 30 and centroids.agg(F.sum("n_pixels")).first()[0] == 1500
    mean = {r.cluster: [r[c] for c in cols] for r in centroids.collect()}
    label = {r.pixel: r.cluster for r in assigned.collect()}
    own = sum(sum((a - b) ** 2 for a, b in zip(r[1:], mean[label[r[0]]])) for r in rows)
    whole = np.array([r[1:] for r in rows])
    assert own < 0.15 * ((whole - whole.mean(0)) ** 2).sum()


def test_odd_features(spark):
    rows = [(i, 5.0, None if i % 7 == 0 else float(i % 3), float(i)) for i in range(60)]  # constant, missing, a ramp
    f = spark.createDataFrame(rows, "pixel long, a double, b double, c double")
    assigned, _ = C.cluster_pixels(f, "pixel", ["a", "b", "c"], members=10, weights=[1.0, 0.0, 1.0])
    label = {r.pixel: r.cluster for r in assigned.collect()}
    assert len(label) == 60
    order = [label[i] for i in range(60)]
    assert sum(a != b for a, b in zip(order, order[1:])) == len(set(order)) - 1  # only the ramp counts: clusters are its pieces
    one, _ = C.cluster_pixels(f.limit(1), "pixel", ["a", "b", "c"])
    assert one.count() == 1


def test_centres_are_no_literals(spark, tmp_path):
    z = spark.range(400).select(F.col("id"), F.array(F.col("id") % 37, F.col("id") * 7 % 91).alias("z"))
    spark.createDataFrame([(k, [k * 3, k * 5]) for k in range(300)], "cluster long, z array<long>").write.parquet(str(tmp_path / "c"))
    plan = C.nearest_centres(z, spark.read.parquet(str(tmp_path / "c")), 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "cell" in plan and len(plan) < 30_000 and "CartesianProduct" not in plan
