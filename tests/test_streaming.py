"""Incremental behaviour of the streaming operators across micro-batches."""

import collections
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from firn.sources.textio import scratch_path
from firn.streaming import drops as D

SCHEMA = "lat_i int, lon_i int, time timestamp_ntz, value double, prio int, drop_no int, day date"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def r(day, hour, value, prio=1, drop=0):
    t = dt.datetime(2024, 1, day, hour)
    return (0, 0, t, value, prio, drop, t.date())


def test_dedupe_across_drops(spark):
    src = scratch_path(spark, "t-drops")
    out = scratch_path(spark, "t-out")
    ck = scratch_path(spark, "t-ck")
    rows(spark, [r(1, 0, 1.0), r(1, 1, 2.0)]).write.parquet(os.path.join(src, "d1"))
    stream = D.read_drops(spark, src + "/*", rows(spark, [r(1, 0, 0.0)]).schema)
    d = D.dedupe_stream(stream, ["lat_i", "lon_i"])
    D.run_to_end(d.writeStream.format("parquet").option("path", out), ck)
    # a second drop re-delivers hour 1 and adds hour 2
    rows(spark, [r(1, 1, 9.0), r(1, 2, 3.0)]).write.parquet(os.path.join(src, "d2"))
    D.run_to_end(d.writeStream.format("parquet").option("path", out), ck)
    got = sorted((x.time.hour, x.value) for x in spark.read.parquet(out).collect())
    assert got == [(0, 1.0), (1, 2.0), (2, 3.0)]


def revision(spark, path, **how):
    return D.RevisionStore(spark, str(path), ["lat_i", "lon_i", "time"], ["value"], SCHEMA, **how)


def test_revision_touches_only_redelivered_days(spark, tmp_path):
    store = revision(spark, tmp_path / "s")
    store.apply(rows(spark, [r(1, 0, 1.0, 2, 0), r(2, 0, 2.0, 2, 0), r(3, 0, 3.0, 2, 0)]))
    # drop 1 revises day 3 (newer forecast) and brings reanalysis for day 2
    changed = store.apply(rows(spark, [r(3, 0, 30.0, 2, 1), r(2, 0, 20.0, 1, 1), r(2, 0, 99.0, 2, 1)]))
    got = {x.time.day: x.value for x in store.read().collect()}
    assert got == {1: 1.0, 2: 20.0, 3: 30.0}
    assert changed == ["day=2024-01-02", "day=2024-01-03"]
    assert store.store.folders("table") == {"day=2024-01-01": 1, "day=2024-01-02": 2, "day=2024-01-03": 2}
    assert {x.time.day: x.value for x in store.read(version=1).collect()} == {1: 1.0, 2: 2.0, 3: 3.0}


def test_a_batch_that_fails_before_its_commit_leaves_the_old_version(spark, tmp_path, monkeypatch):
    """The stream fails between stage and commit; readers see the version before, and the restarted stream repeats the batch."""
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    rows(spark, [r(1, 0, 1.0, 2, 0), r(2, 0, 2.0, 2, 0)]).coalesce(1).write.parquet(src)
    store = revision(spark, tmp_path / "s", follow=products(spark))
    stream = D.read_drops(spark, src, rows(spark, [r(1, 0, 1.0)]).schema)
    D.run_to_end(stream.writeStream.foreachBatch(store.apply), ck)
    before = sorted(store.read().collect()), sorted(store.store.read("means").collect())
    rows(spark, [r(2, 0, 5.0, 1, 1), r(3, 0, 3.0, 2, 1)]).coalesce(1).write.mode("append").parquet(src)
    with monkeypatch.context() as m:
        m.setattr(store.store, "commit", lambda: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(Exception, match="lost driver"):
            D.run_to_end(stream.writeStream.foreachBatch(store.apply), ck)
    again = revision(spark, tmp_path / "s", follow=products(spark))
    assert (sorted(again.read().collect()), sorted(again.store.read("means").collect())) == before
    D.run_to_end(stream.writeStream.foreachBatch(again.apply), ck)
    assert {x.time.day: x.value for x in again.read().collect()} == {1: 1.0, 2: 5.0, 3: 3.0}
    again.apply(rows(spark, [r(2, 0, 5.0, 1, 1), r(3, 0, 3.0, 2, 1)]))  # a repeat after its commit changes nothing
    assert {x.time.day: x.value for x in again.read().collect()} == {1: 1.0, 2: 5.0, 3: 3.0}


def products(spark):
    zones = spark.createDataFrame([(0, 0, "a", "r"), (0, 1, "b", "r"), (9, 9, "empty", "q")], "lat_i int, lon_i int, zone string, region string")
    return D.DayProducts(zones, ["lat_i", "lon_i"], {"SWE": "value"}, "2024-01-03")


def test_kept_products_equal_the_full_rebuild_after_every_epoch(spark, tmp_path):
    """Also: an epoch reads the rows of the days it changes only (the others' files are damaged on purpose)."""
    store = revision(spark, tmp_path / "s", follow=products(spark), lookback=3)
    rnd = random.Random(3)
    for drop in range(4):
        data = [(0, lon, dt.datetime(2024, 1, day, h), rnd.random(), rnd.choice([1, 2]), drop, dt.date(2024, 1, day))
                for day in range(drop + 1, drop + 4) for lon in (0, 1) for h in range(0, 24, 6) if not (lon == 1 and day == 3)]
        changed = store.apply(rows(spark, data))
        assert changed == [f"day=2024-01-{d:02d}" for d in range(drop + 1, drop + 4)]
        full = collections.defaultdict(list)
        kept = store.read().collect()
        for x in kept:
            full[x.day, "ab"[x.lon_i]].append(x.value)
        days = {x.day for x in kept}
        want = {(d, z): sum(full[d, z]) / len(full[d, z]) if full[d, z] else None for d in days for z in ("a", "b", "empty")}
        got = {(x.day, x.zone): x.mean for x in store.follow.means(store.store.read("means")).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
        regions = {(x.day, x.region): x.mean for x in store.store.read("regions").collect()}
        for d in days:
            of = [want[d, z] for z in "ab" if want[d, z] is not None]
            assert regions[d, "r"] == pytest.approx(sum(of) / len(of)) and regions[d, "q"] is None
        product = {(x.day, x.zone): (x.Q5_SWE, x.Q95_SWE, x.FC) for x in store.store.read("product").collect()}
        assert product.keys() == want.keys()
        assert all(product[k] == (got[k], got[k], k[0] >= dt.date(2024, 1, 3)) for k in want)
    for f in (tmp_path / "s").glob("*/data/version=*/day=2024-01-01/*.parquet"):
        f.write_bytes(b"damaged")
    for f in (tmp_path / "s").glob("*/data/version=*/day=2024-01-01/.*.crc"):
        f.unlink()
    store.apply(rows(spark, [r(6, 0, 1.0, 2, 9)]))  # day 1 is neither read nor written
    with pytest.raises(Exception):
        store.read().collect()


def test_reanalysis_supersedes_a_hindcast_that_arrived_first(spark, tmp_path):
    """Values by precedence over a span longer than the watermark; what has no partner comes as well, once its time is up."""
    schema = "lat_i int, lon_i int, time timestamp_ntz, value double, prio int"
    paths = [str(tmp_path / n) for n in ("re", "fc")]

    def land(path, data):
        spark.createDataFrame([(k, 0, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), v, p) for k, d, v, p in data], schema).coalesce(1).write.mode("append").parquet(path)
    for day in range(0, 40, 2):  # forecasts of cells 0 to 2 come at once, twice from two sources
        land(paths[1], [(k, day, 100.0 + k, 2) for k in range(3)] + [(2, day, 999.0, 3), (3, day, 7.0, 3)])
    for day in range(0, 40, 2):  # reanalysis of cell 0, and of a cell without forecast, later
        land(paths[0], [(0, day, 1.0, 1), (4, day, 4.0, 1)])
    for p in paths:
        land(p, [(None, 200, None, 9)])
    a, b = (D.read_drops(spark, p, schema, max_files=3) for p in paths)
    j = D.first_wins_join(a, b, ["lat_i", "lon_i"], "value", delays=("6 days", "6 days"))
    D.run_to_end(j.where("lat_i IS NOT NULL").writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "ck"))
    got = collections.defaultdict(set)
    n = 0
    for x in spark.read.parquet(str(tmp_path / "out")).collect():
        got[x.lat_i].add((x.value, x.prio))
        n += 1
    assert got == {0: {(1.0, 1)}, 1: {(101.0, 2)}, 2: {(102.0, 2)}, 3: {(7.0, 3)}, 4: {(4.0, 1)}} and n == 5 * 20


def test_rows_later_than_the_watermark_are_an_error(spark, tmp_path):
    src = str(tmp_path / "src")
    for day in (20, 21, 1):
        rows(spark, [r(day, 0, 1.0)]).coalesce(1).write.mode("append").parquet(src)
    d = D.dedupe_stream(D.read_drops(spark, src, rows(spark, [r(1, 0, 1.0)]).schema, max_files=1), ["lat_i", "lon_i"], delay="2 days")
    with pytest.raises(D.LateRows):
        D.run_to_end(d.writeStream.format("parquet").option("path", str(tmp_path / "o")), str(tmp_path / "c"))


def test_day_completeness_counts_distinct_hours(spark):
    src = scratch_path(spark, "t-cmp")
    data = [r(1, h, 1.0) for h in range(24)] + [r(1, 5, 2.0)] + [r(2, h, 1.0) for h in range(10)]
    rows(spark, data).write.parquet(src)
    agg = D.day_completeness_stream(D.read_drops(spark, src, rows(spark, data[:1]).schema), ["lat_i"])
    agg = agg.select("lat_i", F.to_date("w.start").alias("day"), "n_hours")
    days = D.LatestDays(spark, scratch_path(spark, "t-cmp-out"), ["lat_i", "day"], agg.schema)
    ck = scratch_path(spark, "t-cmp-ck")
    D.run_to_end(agg.writeStream.outputMode("update").foreachBatch(days.apply), ck)
    assert {x.day: x.n_hours for x in days.read().collect()} == {dt.date(2024, 1, 1): 24, dt.date(2024, 1, 2): 10}
    # a second drop completes day 2 and starts day 3; day 1 is not written again
    rows(spark, [r(2, h, 1.0) for h in range(8, 24)] + [r(3, 0, 1.0)]).write.mode("append").parquet(src)
    D.run_to_end(agg.writeStream.outputMode("update").foreachBatch(days.apply), ck)
    assert {x.day: x.n_hours for x in days.read().collect()} == {
        dt.date(2024, 1, 1): 24, dt.date(2024, 1, 2): 24, dt.date(2024, 1, 3): 1}
    first = days.store.folders("days")["day=2024-01-01"]
    assert all(v > first for f, v in days.store.folders("days").items() if f != "day=2024-01-01")
    assert sorted(os.listdir(f"{days.store.path.removeprefix('file:')}/days/manifest"))  # one pointer a batch, no folder of epochs to scan


def test_revision_ranks_each_variable(spark, tmp_path):
    """A reanalysis that lacks a variable does not freeze its forecast."""
    schema = "k int, day date, prio int, drop_no int, a double, b double"
    day = dt.date(2024, 1, 1)
    store = D.RevisionStore(spark, str(tmp_path / "s"), ["k"], ["a", "b"], schema)
    for row in [(1, day, 2, 0, 10.0, 1.0), (1, day, 1, 1, None, 5.0), (1, day, 2, 2, 20.0, 9.0)]:
        store.apply(spark.createDataFrame([row], schema))
    got = store.read().first()
    assert (got.a, got.b) == (20.0, 5.0)


def test_revision_looks_back_so_far_only(spark, tmp_path):
    store = revision(spark, tmp_path / "s", lookback=2)
    store.apply(rows(spark, [r(1, 0, 1.0, 2, 0), r(2, 0, 2.0, 2, 0)]))
    # day 1 is two days behind day 3, the newest of drop 1; drop 2 in the same batch still reaches it
    store.apply(rows(spark, [r(1, 0, 9.0, 2, 1), r(3, 0, 3.0, 2, 1)]))
    assert {x.time.day: x.value for x in store.read().collect()} == {1: 1.0, 2: 2.0, 3: 3.0}
    store.apply(rows(spark, [r(1, 0, 9.0, 2, 2), r(2, 0, 8.0, 2, 2), r(3, 0, 4.0, 2, 3)]))
    assert {x.time.day: x.value for x in store.read().collect()} == {1: 9.0, 2: 8.0, 3: 4.0}
