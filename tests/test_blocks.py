"""Joins whose rows are grouped by zone and day next are made in blocks of zones and days: what they join to is not shuffled."""

import contextlib
import datetime as dt
import io
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from firn.operators import common as CM
from firn.operators import geometry as G
from firn.operators import raster as R
from firn.operators import zonal as Z
from firn.sources.textio import stored


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


DAY = dt.date(2000, 1, 30)


def tables(spark):
    """Pixels of 30 zones and a series with empty values, a row without a day, one without a cluster and a cluster without pixels."""
    rnd = random.Random(5)
    pixels = [(f"z{rnd.randrange(30)}", p, p % 11 if p % 7 else None) for p in range(300)] + [(None, 900, 3)]
    series = [(c, DAY + dt.timedelta(3 * d), None if d == 4 or rnd.random() < 0.3 else rnd.random(), float(c)) for c in range(13) for d in range(9)]
    series += [(2, None, 5.0, 1.0), (None, DAY, 7.0, 1.0), (2, DAY, 0.5, 2.0), (12, DAY + dt.timedelta(200), 1.0, 1.0)]
    zones = [(f"z{k}",) for k in range(32)] * 2 + [(None,)]
    return (spark.createDataFrame(pixels, "zone string, pixel int, cluster int"),
            spark.createDataFrame(series, "cluster int, date date, v double, w double"), spark.createDataFrame(zones, "zone string"))


def plain(pixels, series, zones, value):
    """{(day, zone): mean over pixels}, by loops."""
    px, s = pixels.collect(), series.collect()
    out = {(d, z.zone): [] for d in {r.date for r in s if r.date} for z in zones.collect() if z.zone}
    for p in px:
        for r in s:
            if p.cluster is not None and p.cluster == r.cluster and (r.date, p.zone) in out and r[value] is not None:
                out[r.date, p.zone].append(r[value])
    return {k: sum(v) / len(v) if v else None for k, v in out.items()}


def same(rows, want, value="mean"):
    got = {(r.date, r.zone): r[value] for r in rows}
    assert len(rows) == len(got) and got.keys() == want.keys()
    assert all((got[k] is None) == (w is None) and (w is None or abs(got[k] - w) < 1e-12) for k, w in want.items())


@pytest.mark.parametrize("task_rows", [1 << 20, 20, 3])
def test_means_in_blocks(spark, monkeypatch, task_rows):
    monkeypatch.setattr(CM, "TASK_ROWS", task_rows)
    pixels, series, zones = tables(spark)
    want = plain(pixels, series, zones, "v")
    assert len(want) == 32 * 10 and any(v is None for v in want.values())
    fact = G.factorised_zonal_mean(G.pixel_weights(pixels), series, ["date"], "v", zones)
    same(fact.collect(), want)
    px, s = stored(pixels, "pixels"), stored(series, "series")
    blocks = CM.Blocks(s, px, zones, ["date"])
    assert (blocks.n_zone > CM.FEW) == (task_rows == 3)  # then a day's rows go only to zones of their cluster
    j = R.cluster_to_pixel_to_group(px, s, blocks=blocks)
    flat = Z.zonal_mean(j.select(CM.BLOCK, "date", "zone", F.col("v").alias("value")), zones, keys=("date",), key_rows=s, blocks=blocks)
    same(flat.collect(), want)
    both = G.factorised_zonal_mean(stored(G.pixel_weights(pixels), "weights"), s, ["date"], ["v", "w"], zones, blocks=blocks).collect()
    same(both, want, "v")
    same(both, plain(pixels, series, zones, "w"), "w")
    # a block is a task, and none has more of the zones and days than it is meant to
    assert {r[CM.BLOCK] for r in both} <= set(range(blocks.n_zone * blocks.n_day))


def test_joined_rows_are_not_shuffled(spark):
    """Only the two sides, the zones and the keys are brought together; groups and the grid need no exchange of their own."""
    pixels, series, zones = tables(spark)
    p = plan(G.factorised_zonal_mean(G.pixel_weights(pixels), series, ["date"], "v", zones))
    assert "ENSURE_REQUIREMENTS" not in p and "BroadcastExchange" not in p
    assert p.count("Exchange shufflepartitionidpassthrough") == 4
    px, s = stored(pixels, "pixels"), stored(series, "series")
    blocks = CM.Blocks(s, px, zones, ["date"])
    j = R.cluster_to_pixel_to_group(px, s, blocks=blocks).select(CM.BLOCK, "date", "zone", F.col("v").alias("value"))
    assert "ENSURE_REQUIREMENTS" not in plan(Z.zonal_mean(j, zones, keys=("date",), key_rows=s, blocks=blocks))


def test_queries_shuffle_no_joined_rows(spark):
    from conftest import SF_SMALL

    from firn.plans import registry
    registry.load_all()
    for name in ("m02_factorised_mean", "a01_polygon_zonal_mean"):
        assert "ENSURE_REQUIREMENTS" not in plan(registry.QUERIES[name](spark, SF_SMALL)), name
    p = plan(registry.QUERIES["chain_zone_products"](spark, SF_SMALL))
    made = [re.sub(r"#\d+", "", x) for x in re.findall(r"hashpartitioning\((.*?), \d+\), ENSURE_REQUIREMENTS", p)]
    # the list of zones, the region means and the products of regions; the zones' means and products stay where they are made
    assert sorted(made) == ["variable, date, region", "zone, date", "zone, region"]


def test_stored_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return sum(disk.getAllFiles().apply(k).getName().startswith("shuffle_") for k in range(disk.getAllFiles().size()))
    spark._jvm.System.gc()
    time.sleep(2)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, conf = shuffles(), spark.conf.get(key, None)
    out = stored(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "groups")
    assert spark.conf.get(key, None) == conf
    until = time.time() + 20
    while shuffles() > before and time.time() < until:
        time.sleep(0.5)
    assert shuffles() <= before and out.count() == 10
