"""Sinks as catalogues, pruning at run time, bucketed tables, wide tables in chunks."""

import datetime as dt
import glob
import random
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firn.sources import catalogue as CT
from firn.sources import wide as W

KEYS = ["variable", "date"]
SCHEMA = "v double, variable string, date date"


def rows(spark, *days, variable="SWE", n=3, v=1.0):
    return spark.createDataFrame([(v, variable, dt.date(2024, 1, d)) for d in days for _ in range(n)], SCHEMA)


def days(frame):
    return sorted(r.date.day for r in frame.collect())


def test_a_second_run_publishes_nothing_and_a_day_without_marker_comes_again(spark, tmp_path):
    path = str(tmp_path / "sink")
    assert days(CT.publish_new(rows(spark, 1, 2), path, KEYS, "a")) == [1, 2]
    assert days(CT.publish_new(rows(spark, 1, 2), path, KEYS, "b")) == []
    CT.write_partitions(rows(spark, 3, n=1, v=9.0), path, KEYS)  # a run that was lost before its marker
    types = StructType.fromDDL("variable string, date date")
    assert days(CT.published(spark, path, types)) == [1, 2]
    assert CT.read_published(spark, path, SCHEMA, KEYS).count() == 6
    assert days(CT.publish_new(rows(spark, 1, 2, 3, v=2.0), path, KEYS, "c")) == [3]
    got = CT.read_published(spark, path, SCHEMA, KEYS)
    assert sorted((r.date.day, r.v) for r in got.collect()) == [(1, 1.0)] * 3 + [(2, 1.0)] * 3 + [(3, 2.0)] * 3
    shutil.rmtree(glob.glob(f"{path}/variable=SWE/date=2024-01-02")[0])  # a folder that is gone is not published, whatever its marker
    assert days(CT.publish_new(rows(spark, 1, 2, 3), path, KEYS, "d")) == [2]
    assert days(CT.publish_new(rows(spark, 1, 2, 3, v=5.0), path, KEYS, "e", refresh_from="2024-01-03")) == [3]
    assert {(r.date.day, r.run) for r in CT.published(spark, path, types).collect()} == {(1, "a"), (2, "d"), (3, "e")}


def test_attributes_stand_once(spark, tmp_path):
    path = str(tmp_path / "sink")
    CT.publish_new(rows(spark, 1), path, KEYS, "a")
    CT.publish_new(rows(spark, 1, variable="X"), path, KEYS, "a")
    CT.write_attributes(spark.createDataFrame([("SWE", "mm")], "variable string, unit string"), path)
    got = CT.read_published(spark, path, SCHEMA, KEYS)
    assert {(r.variable, r.unit) for r in got.collect()} == {("SWE", "mm"), ("X", None)}
    assert spark.read.schema(SCHEMA).parquet(path).count() == 6  # neither markers nor attributes are read as data


def scanned(df):
    """Files that the scan of the last run of ``df`` read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
    text = df._jdf.queryExecution().executedPlan().toString()
    leaves, found = [plan], []
    while leaves:
        p = leaves.pop()
        name = p.nodeName()
        if "QueryStage" in name:
            leaves.append(p.plan())
        for k in range(p.children().size()):
            leaves.append(p.children().apply(k))
        if name.startswith("Scan parquet"):
            found.append(p.metrics().apply("numFiles").value())
    return text, found


def test_partitions_are_pruned_at_run_time(spark, tmp_path):
    path, cal = str(tmp_path / "sink"), str(tmp_path / "calendar")
    CT.write_partitions(rows(spark, *range(1, 31)), path, KEYS)
    spark.createDataFrame([(dt.date(2024, 1, d), d % 10) for d in range(1, 31)], "date date, k int").write.parquet(cal)
    counts = {}
    for n in (1, 4):
        j = CT.join_on_partitions(spark, path, SCHEMA, spark.read.parquet(cal).where(F.col("k") < n), ["date"])
        text, files = scanned(j)
        assert "dynamicpruning" in text
        counts[n] = max(files)
        assert j.count() == 3 * 3 * n
    assert counts[1] < counts[4] < 30


def test_bucketed_tables_need_no_shuffle(spark):
    a = spark.range(500).select((F.col("id") % 50).alias("k"), (F.col("id") / 50).cast("int").alias("d"), F.col("id").alias("v"))
    x = CT.save_bucketed(a, ["k", "d"], 4, "x")
    y = CT.save_bucketed(a.withColumnRenamed("v", "w"), ["k", "d"], 4, "y")
    j = x.join(y.hint("merge"), ["k", "d"]).groupBy("k", "d").agg(F.sum("v").alias("v"), F.sum("w").alias("w"))
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert j.where("v <> w").count() == 0 and j.count() == 500


def test_queries_on_buckets_and_pruned_partitions(spark):
    from conftest import SF_SMALL
    from firn.plans import registry
    registry.load_all()
    for name in ("j01_bucketed_merge", "j14_bucketed_product"):
        plan = registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, name
    assert "dynamicpruning" in registry.QUERIES["p10_pruned_rasters"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n,per_chunk", [(25_000, 1000), (7, 3), (1, 10)])
def test_wide_round_trip_of_any_number_of_zones(spark, tmp_path, n, per_chunk):
    path = str(tmp_path / "wide")
    long = spark.range(n).select(F.concat(F.lit("zone "), "id").alias("zone"), F.col("id")).crossJoin(
        spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)], "date date"))
    long = long.where((F.col("id") + F.dayofmonth("date")) % 3 > 0).select("date", "zone", (F.col("id") * 0.1 + F.dayofmonth("date")).alias("mean"))
    W.write_wide_chunks(long, path, "date", per_chunk=per_chunk)
    back = W.read_wide_chunks(spark, path, "date")
    n_days = long.select("date").distinct().count()
    assert back.count() == n_days * n
    both = back.join(long.withColumnRenamed("mean", "was"), ["date", "zone"], "left")
    assert both.where(~F.col("mean").eqNullSafe(F.col("was"))).count() == 0
    assert len(glob.glob(f"{path}/chunk=*")) >= n // per_chunk // 2
    some = W.read_wide_chunks(spark, path, "date", wanted=spark.createDataFrame([("zone 0",), ("nowhere",)], "zone string"))
    assert some.count() == n_days


def test_odd_names_and_repeated_headers(spark, tmp_path):
    path, names = str(tmp_path / "odd"), ['a,b', 'say "hi"', "plain", "", "ü é", "1"]
    rnd = random.Random(1)
    data = [(dt.date(2024, 1, d), z, rnd.random()) for d in (1, 2) for z in names]
    W.write_wide_chunks(spark.createDataFrame(data, "date date, zone string, mean double"), path, "date", per_chunk=100)
    assert sorted(tuple(r) for r in W.read_wide_chunks(spark, path, "date").collect()) == sorted(data)
    other = tmp_path / "given" / "chunk=0"
    other.mkdir(parents=True)
    (other / "file.csv").write_text("date,x,y,x,x\n2024-01-01,1,2,3,\n")
    got = {r.zone: r.mean for r in W.read_wide_chunks(spark, str(tmp_path / "given"), "date").collect()}
    assert got == {"x": 1.0, "y": 2.0, "x.1": 3.0, "x.2": None}
