"""Zone covers in run lengths and prefix counts against pixel lists; zonal means read their inputs once."""

import random
import re

import pytest
from pyspark.sql import functions as F

from firn.operators import geometry as G
from firn.operators import points as PT
from firn.operators import zonal as Z

RES = 10.0


def grid(spark, rows=40, cols=60, clusters=7, holes=0.1):
    rnd = random.Random(5)
    px = [(r * cols + c, r, c, 1000.0 + RES * c, 5000.0 - RES * r, rnd.randrange(clusters))
          for r in range(rows) for c in range(cols) if rnd.random() >= holes or c in (0, cols - 1)]
    return spark.createDataFrame(px, "pixel long, row_i int, col_i int, x double, y double, cluster int")


def polygons(spark, n=25):
    """Stars, slivers, rectangles through pixel centres, and one far away; with holes as further rings of a zone."""
    rnd, out = random.Random(9), []
    for k in range(n):
        x, y = 1000 + rnd.uniform(-50, 650), 5000 - rnd.uniform(-50, 450)
        m = rnd.randrange(3, 9)
        pts = [(x + rnd.uniform(-200, 200), y + rnd.uniform(-200, 200)) for _ in range(m)]
        if k % 5 == 0:  # edges on test points
            a, b, c, d = 1000 + RES * rnd.randrange(30), 5000 - RES * rnd.randrange(20), RES * rnd.randrange(1, 25), RES * rnd.randrange(1, 15)
            pts = [(a, b), (a + c, b), (a + c, b - d), (a, b - d)]
        out += [(f"z{k}", "r", [{"x": p, "y": q} for p, q in pts])] + ([(f"z{k}", "r", [{"x": p + 30, "y": q - 7} for p, q in pts])] if k % 4 == 0 else [])
    out.append(("far", "r", [{"x": 9e5, "y": 9e5}, {"x": 9e5 + 50, "y": 9e5}, {"x": 9e5, "y": 9e5 + 50}]))
    return G.ring_to_edges(spark.createDataFrame(out, "zone string, region string, ring array<struct<x:double,y:double>>"))


@pytest.mark.parametrize("coord", ["center", "corner_as_center"])
def test_runs_and_weights_equal_the_pixel_list(spark, coord):
    pixels, edges = grid(spark), polygons(spark)
    zp = G.zone_pixels(edges, pixels, RES, coord)
    want = {(r.zone, r.pixel) for r in zp.collect()}
    runs = G.zone_runs(edges, pixels, RES, coord)
    cells = runs.select("zone", "row_i", F.explode(F.sequence("first", "last")).alias("col_i")).join(pixels, ["row_i", "col_i"])
    got = [(r.zone, r.pixel) for r in cells.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 2000
    assert sorted(G.cluster_weights(runs, pixels).collect()) == sorted(G.pixel_weights(zp).select("zone", "cluster", "n").collect())


def test_factorised_mean_equals_the_mean_over_pixels(spark):
    pixels, edges = grid(spark, clusters=5), polygons(spark)
    rnd = random.Random(1)
    series = spark.createDataFrame([(c, f"2024-01-{d:02d}", None if rnd.random() < 0.2 or d == 4 else rnd.random()) for c in range(6) for d in range(1, 9)],
                                   "cluster int, day string, v double").withColumn("date", F.to_date("day")).drop("day")
    runs = G.zone_runs(edges, pixels, RES)
    fact = G.factorised_zonal_mean(G.cluster_weights(runs, pixels), series, ["date"], "v", edges.select("zone"))
    flat = G.zone_pixels(edges, pixels, RES).join(series, "cluster").select("date", "zone", F.col("v").alias("value"))
    plain = Z.zonal_mean(flat, edges.select("zone"), ("date",), key_rows=series)
    a, b = ({(r.date, r.zone): r.mean for r in x.collect()} for x in (fact, plain))
    assert a.keys() == b.keys() and len(a) == 8 * 26
    assert all((a[k] is None) == (b[k] is None) and (a[k] is None or abs(a[k] - b[k]) < 1e-12) for k in a)


def executed(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_weights_make_no_row_per_pixel(spark):
    """Only zone edges, ring corners and the clusters of a run are exploded."""
    pixels, edges = grid(spark), polygons(spark)
    plan = executed(G.cluster_weights(G.zone_runs(edges, pixels, RES), pixels))
    made = [line for line in plan.splitlines() if "Generate explode" in line]
    assert not any("col_i" in x or "first" in x and "sequence" in x for x in made), made


def test_inputs_are_read_once(spark, tmp_path):
    """The archive is scanned for its rows and for its points; a series once."""
    s = spark.range(1000).select((F.col("id") % 20).alias("cluster"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 20).cast("int")).alias("date"),
                                 F.lit(1).alias("prio"), F.col("id").alias("ord"), F.rand(1).alias("swe"))
    s.write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    plan = executed(PT.keep_last(a, a.withColumn("prio", F.lit(2)), ["cluster", "date"]))
    assert len(re.findall(r"Relation \[", plan)) == 4 and plan.count("Join") == 1


def test_points_of_one_side_pass_through(spark):
    row = "cluster int, date int, prio int, ord long, v string"
    a = spark.createDataFrame([(1, 1, 1, 1, "a"), (1, 1, 1, 1, "a"), (1, 1, 1, 2, "b"), (2, 1, 1, 1, "c"), (2, 1, 1, 5, "d"), (2, 2, 1, 1, "e")], row)
    b = spark.createDataFrame([(2, 1, 2, 0, "f"), (3, 1, 2, 1, "g"), (3, 1, 2, 1, "g")], row)
    got = sorted(r.v for r in PT.keep_last(a, b, ["cluster", "date"]).collect())
    assert got == ["a", "a", "b", "e", "f", "g", "g"]
