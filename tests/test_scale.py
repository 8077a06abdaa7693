"""Shares of a task stay the same as tables grow: pieces by rows, and joins that neither shuffle nor sort what they expand."""

import contextlib
import io

from pyspark.sql import functions as F

from firn.operators import common as CM
from firn.operators import raster as R
from firn.sources import files as FL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def series(spark):
    """Ten days of nine clusters, one without a pixel, and one day without a date."""
    s = spark.range(90).select((F.col("id") % 9).alias("cluster"), F.expr("date '2000-01-20' + cast(id % 10 * 3 AS int)").alias("date"), F.col("id").cast("double").alias("v"))
    return s.unionByName(spark.createDataFrame([(1, None, 7.0)], s.schema))


def test_pixels_keep_the_order_of_the_series(spark, tmp_path):
    px = spark.range(400).select((F.col("id") % 8).alias("cluster"), F.col("id").alias("pixel"))
    long = CM.spread(series(spark), 91, "cluster").withColumn("month", F.month("date"))
    j = R.cluster_to_pixel_in_order(px, long, ["month", "date"])
    p = plan(j)
    assert p.index("ShuffledHashJoin") < p.index("Sort [")  # one sort, below the join
    assert p.count("Sort [") == 1
    want = sorted(map(tuple, R.cluster_to_pixel(px, long).select(j.columns).collect()), key=str)
    assert sorted(map(tuple, j.collect()), key=str) == want and len(want) == 80 * 50 + 50
    FL.write_partitioned(j, str(tmp_path / "out"), ["month"], gather=False)
    for f in (tmp_path / "out").glob("month=*/*.parquet"):
        days = [str(r.date) for r in spark.read.parquet(str(f)).select("date").collect()]
        assert days == sorted(days)


def test_pieces_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(CM, "TASK_ROWS", 10)
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(50).withColumn("k", F.col("id") % 7)
    assert CM.spread(df, 50, "k").rdd.getNumPartitions() == max(cores, 5)
    assert CM.spread(df, 10 * (cores + 30), "k").rdd.getNumPartitions() == cores + 30
    # 50 rows meet 40 each: 2000 joined rows, as many pieces as they need
    other = spark.range(280).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    j = CM.join_spread(df, other, "k")
    assert j.rdd.getNumPartitions() >= 200 and j.count() == 2000
    left = CM.join_spread(df, other.where("k < 3"), "k", "left")
    assert left.where("v IS NULL").count() == df.where("k >= 3").count() and left.count() == df.join(other.where("k < 3"), "k", "left").count()


def test_overlay_in_pieces(spark, monkeypatch):
    from firn.operators.points import keep_last
    rows = spark.range(400).select((F.col("id") % 20).alias("cluster"), (F.col("id") % 3).alias("date"), (F.col("id") % 2 + 1).cast("int").alias("prio"),
                                   F.col("id").alias("ord"), F.col("id").cast("double").alias("swe"))
    rows = rows.where("cluster % 4 < 2").unionByName(rows.where("cluster % 4 < 2").selectExpr("cluster", "date", "3 - prio AS prio", "ord + 400 AS ord", "swe"))
    one = {tuple(r) for r in keep_last(rows.where("prio = 1"), rows.where("prio = 2"), ["cluster", "date"]).collect()}
    monkeypatch.setattr(CM, "TASK_ROWS", 4)
    many = keep_last(rows.where("prio = 1"), rows.where("prio = 2"), ["cluster", "date"])
    assert "hashpartitioning(cluster" in plan(many) and "REPARTITION_BY_NUM" in plan(many)
    assert {tuple(r) for r in many.collect()} == one and len(one) == 30


def test_zonal_means_in_pieces(spark, monkeypatch):
    from firn.operators import geometry as G
    monkeypatch.setattr(CM, "TASK_ROWS", 5)
    weights = spark.createDataFrame([("A", 1, 2), ("A", 2, 1), ("B", 2, 4)], "zone string, cluster long, n long")
    s = spark.createDataFrame([(1, "2000-01-01", 3.0), (2, "2000-01-01", 6.0), (2, "2000-01-02", None), (9, "2000-01-05", 1.0)],
                              "cluster long, d string, v double").withColumn("date", F.to_date("d"))
    zones = spark.createDataFrame([("A",), ("B",), ("C",)], "zone string")
    got = {(str(r.date), r.zone): r["mean"] for r in G.factorised_zonal_mean(weights, s, ["date"], "v", zones).collect()}
    assert len(got) == 9 and got["2000-01-01", "A"] == 4.0 and got["2000-01-01", "B"] == 6.0
    assert all(v is None for k, v in got.items() if k not in {("2000-01-01", "A"), ("2000-01-01", "B")})


def test_wide_lines_by_position(spark, tmp_path):
    """First, last and middle columns empty, a null value and names that need quotes; a line needs no look-up by name."""
    from firn.sources import wide as W
    rows = [("2000-01-01", "b", 1.5), ("2000-01-01", "d,x", 2.0), ("2000-02-01", "a", None), ("2000-02-01", 'c"q', -3.0), ("2000-03-01", "e", 0.25),
            ("2000-04-01", None, 1.0)]
    long = spark.createDataFrame(rows, "d string, zone string, mean double").select(F.to_date("d").alias("date"), "zone", "mean")
    W.write_wide_chunks(long, str(tmp_path / "w"), "date", per_chunk=100)
    lines = [r.value for r in spark.read.text(str(tmp_path / "w")).collect()]
    assert sorted(lines) == sorted(['date,a,b,"c""q","d,x",e', "2000-01-01,,1.5,,2.0,", "2000-02-01,,,-3.0,,", "2000-03-01,,,,,0.25", "2000-04-01,,,,,"])
    back = {(str(r.date), r.zone): r["mean"] for r in W.read_wide_chunks(spark, str(tmp_path / "w"), "date").collect()}
    assert len(back) == 20 and {k: v for k, v in back.items() if v is not None} == {(d, z): v for d, z, v in rows if v is not None and z}
    from inspect import getsource
    assert "try_element_at" not in getsource(W.write_wide_chunks)


def test_clusters_in_pieces(spark, monkeypatch):
    from firn.operators import cluster as C
    pts = spark.range(300).select("id", F.array(F.col("id") % 17, F.col("id") * 7 % 91).alias("z"))
    ctr = spark.range(40).select(F.col("id").alias("cluster"), F.array(F.col("id") % 13, F.col("id") * 5 % 80).alias("z"))
    want = {tuple(r) for r in C.nearest_centres(pts, ctr, 2).select("id", "cluster").collect()}
    monkeypatch.setattr(CM, "TASK_ROWS", 50)  # 300 x 40 / 4 pairs: 60 pieces
    got = C.nearest_centres(pts, ctr, 2)
    assert "hashpartitioning(id" in plan(got) and ", 60), REPARTITION_BY_NUM" in plan(got)
    assert {tuple(r) for r in got.select("id", "cluster").collect()} == want and len(want) == 300


def test_text_sink_computes_its_rows_once(spark, tmp_path):
    """Range partitions would sample them, and so compute them twice."""
    from firn.sources import textio as TX
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rows = spark.range(60).selectExpr("concat('FSM_pt_', id % 3) AS point", "timestamp_ntz '2000-01-01' + make_dt_interval(cast(id AS int)) AS time", "cast(id AS double) AS swe")
    TX.write_point_text(rows.mapInArrow(count, rows.schema), str(tmp_path / "t"), "point", "time", ["swe"])
    assert seen.value == 60
    back = TX.read_point_text(spark, str(tmp_path / "t"), ["swe"])
    assert {(r.cluster, r.swe) for r in back.collect()} == {(i % 3, float(i)) for i in range(60)}
