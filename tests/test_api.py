"""The README example on small hand-made tables with user column names."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from firn.functions.geodesy import tm_inverse
from firn.operators import forcing as P
from firn.operators import geometry as G
from firn.operators import points as PT
from firn.operators import zonal as Z


def test_forcing_steps_with_user_columns(spark):
    runs = spark.createDataFrame([(dt.datetime(2025, 1, 1), 1, s, float(s)) for s in (0, 3, 6, 12)],
                                 "run_time timestamp_ntz, cell int, step int, tp double")
    rate = P.deaccumulate(runs, ["run_time", "cell"], "tp")
    hourly = P.interpolate_hourly(rate.select("run_time", "cell", "step", "rate"), ["run_time", "cell"], "rate")
    assert hourly.count() == 13


def test_keep_last_with_line_numbers(spark):
    sch = "cluster int, date date, prio int, line_no int, swe double"
    a = spark.createDataFrame([(1, dt.date(2025, 1, 1), 1, 1, 1.0), (1, dt.date(2025, 1, 1), 1, 2, 2.0),
                               (2, dt.date(2025, 1, 1), 1, 1, 7.0), (2, dt.date(2025, 1, 1), 1, 3, 8.0)], sch)
    l = spark.createDataFrame([(1, dt.date(2025, 1, 1), 2, 1, 5.0)], sch)
    got = {r.cluster: r.swe for r in PT.keep_last(a, l, ["cluster", "date"], order="line_no").collect()}
    assert got[1] == 5.0
    # point 2 is in the archive only: it passes through with its duplicate
    both = PT.keep_last(a, l, ["cluster", "date"], order="line_no")
    assert sorted(r.swe for r in both.where("cluster = 2").collect()) == [7.0, 8.0]


def test_wgs84_zone_to_factorised_mean(spark):
    px = spark.createDataFrame([(r * 4 + c, r, c, 300000.0 + 500 * c, 4500000.0 - 500 * r, (r * 4 + c) % 2)
                                for r in range(4) for c in range(4)],
                               "pixel int, row_i int, col_i int, x double, y double, cluster int")
    ring = [(299900.0, 4500100.0), (301100.0, 4500100.0), (301100.0, 4498900.0), (299900.0, 4498900.0)]
    z = spark.createDataFrame([("Z", "R", ring)], "zone string, region string, ring array<struct<x:double,y:double>>")

    def to_ll(p):
        lon, lat = tm_inverse(p["x"], p["y"])
        return F.struct(lon.alias("lon"), lat.alias("lat"))
    ll = z.select("zone", "region", F.transform("ring", to_ll).alias("ring"))
    zp = G.zone_pixels(G.ring_to_edges(G.project_rings(ll)), px, res=500.0)
    assert sorted(r.pixel for r in zp.collect()) == [0, 1, 2, 4, 5, 6, 8, 9, 10]
    ser = spark.createDataFrame([(0, "SWE", dt.date(2025, 1, 1), 1.0), (1, "SWE", dt.date(2025, 1, 1), 3.0)],
                                "cluster int, variable string, date date, value double")
    zm = G.factorised_zonal_mean(G.pixel_weights(zp), ser, ["variable", "date"], "value", ll).first()
    # the same ring in two rows is two parts that cancel; a ring inside it is a hole
    hole = [(300400.0, 4499600.0), (300600.0, 4499600.0), (300600.0, 4499400.0), (300400.0, 4499400.0)]
    grid = spark.createDataFrame([("Z", "R", ring), ("Z", "R", hole)], z.schema)
    holed = G.zone_pixels(G.ring_to_edges(G.project_rings(grid, crs="EPSG:32642")), px, res=500.0)
    assert sorted(r.pixel for r in holed.collect()) == [0, 1, 2, 4, 6, 8, 9, 10]
    with pytest.raises(ValueError):
        G.project_rings(grid, crs="EPSG:3857")
    assert abs(zm.mean - 15.0 / 9.0) < 1e-12   # 6 pixels of cluster 0, 3 of cluster 1
