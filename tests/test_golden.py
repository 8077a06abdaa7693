"""Hand-written micro-tables for the quirks (FIXTURES.md part 3) and the
"""

import datetime as dt

from pyspark.sql import functions as F

from firn.functions.timecols import ntz
from firn.operators import forcing as P
from firn.operators import geometry as G
from firn.operators import merge as M
from firn.operators import points as PT
from firn.operators import publish as PB
from firn.operators import quality as Q
from firn.operators import zonal as Z
from firn.sources import files as FL


def ts(s):
    return dt.datetime.fromisoformat(s)


def hourly(spark, times, src="f", value=1.0):
    return spark.createDataFrame([(src, ts(x), value) for x in times], "src string, time timestamp_ntz, value double")


def test_trim_day_both_cases(spark):
    fc = hourly(spark, [f"2024-01-0{d}T{h:02d}:00" for d in (4, 5, 6) for h in range(24)])
    for last, cut in (("2024-01-05 15:00:00", ts("2024-01-05T00:00")), ("2024-01-05 23:00:00", ts("2024-01-06T00:00"))):
        got = Q.trim_after(fc, ntz(last), day_boundary=True).agg(F.min("time")).first()[0]
        assert got == cut


def test_recent_days_boundary_and_empty(spark):
    import pytest
    f = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (15, 16, 17)], "date date")
    got = [r.date.day for r in Q.recent_days(f, "2024-01-25 10:30:00").collect()]
    assert got == [17]
    assert [r.date.day for r in Q.recent_days(f, "2024-01-25 00:00:00").collect()] == [16, 17]
    late = Q.recent_days(f, "2024-03-01 00:00:00")  # nothing runs yet
    with pytest.raises(Exception, match="no files"):
        late.collect()
    assert Q.recent_days(f, "2024-03-01 00:00:00", require_rows=False).collect() == []


def test_overlay_single_instant_keeps_both(spark):
    e = hourly(spark, ["2024-01-04T23:00", "2024-01-05T00:00"], "e")
    f = hourly(spark, ["2024-01-05T00:00", "2024-01-05T01:00"], "f")
    out = M.overlay(e, f)
    assert out.where(F.col("time") == ts("2024-01-05T00:00")).count() == 2


def test_overlay_tail_dropped(spark):
    e = spark.createDataFrame([("e", dt.datetime(2024, 1, d), 1.0) for d in range(1, 11)], "src string, time timestamp_ntz, value double")
    f = spark.createDataFrame([("f", dt.datetime(2024, 1, d), 2.0) for d in range(5, 9)], "src string, time timestamp_ntz, value double")
    out = M.overlay(e, f)
    kept_e = sorted(r.time.day for r in out.where(F.col("src") == "e").collect())
    assert kept_e == [1, 2, 3, 4]
    assert out.where(F.col("src") == "f").count() == 4


def test_merge_conflict_and_priority(spark):
    k = ["k"]
    a = spark.createDataFrame([(1, 1.0)], "k int, value double")
    b = spark.createDataFrame([(1, 2.0)], "k int, value double")
    assert M.merge_conflicts(a, b, k, ["value"]).count() == 1
    u = M.concat(a.withColumn("prio", F.lit(1)), b.withColumn("prio", F.lit(2)))
    assert M.priority_merge(u, k, ["value"]).first().value == 1.0


def test_merge_null_cellwise_vs_whole_row(spark):
    rows = [(1, 1, None, 1.0), (1, 2, 5.0, None), (1, 3, 7.0, None)]
    df = spark.createDataFrame(rows, "k int, prio int, v double, w double")
    j = M.priority_merge(df, ["k"], ["v", "w"]).first()
    assert (j.v, j.w) == (5.0, 1.0)
    a = df.withColumn("ord", F.lit(0))
    kl = PT.keep_last(a.where("prio < 3"), a.where("prio = 3"), ["k"], point="k").first()
    assert (kl.v, kl.w) == (7.0, None)


def test_duplicates_mask_gap(spark):
    s = hourly(spark, ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T01:00", "2024-01-01T03:00"])
    assert Q.coverage(s, ["src"]).first().missing == 0
    assert [r.time.hour for r in Q.missing_hours(s, ["src"]).collect()] == [2]
    assert Q.duplicate_hours(s, ["src"]).first().n_extra == 1


def test_one_sided_passes_through(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, v double")
    assert PT.keep_last(a, None, ["k"]).count() == 2


def test_hydro_order(spark):
    d = spark.createDataFrame([(dt.date(2024, 1, 5), 1), (dt.date(2024, 9, 1), 2), (dt.date(2023, 12, 31), 3),
                               (dt.date(2025, 8, 30), 4)], "date date, seq int").withColumn("c", F.lit(1))
    got = [r.date for r in PT.hydro_sort(d, ["c"], "date", "seq").collect()]
    assert got == [dt.date(2024, 9, 1), dt.date(2023, 12, 31), dt.date(2024, 1, 5), dt.date(2025, 8, 30)]


def test_deaccumulate_null_propagates(spark):
    d = spark.createDataFrame([(0, 0, 1.0), (0, 3, None), (0, 6, 5.0)], "r int, step int, acc double")
    got = [r.rate for r in P.deaccumulate(d, ["r"], "acc").orderBy("step").collect()]
    assert got == [1.0 / 3, None, None]


def test_deaccumulate_inverts_cumsum(spark):
    steps = [0, 3, 6, 9, 12, 18, 24]
    acc, rows = 0.0, []
    for i, s in enumerate(steps):
        acc += i + 1.5
        rows.append((0, s, acc))
    d = spark.createDataFrame(rows, "r int, step int, acc double")
    out = P.deaccumulate(d, ["r"], "acc", switch=12).orderBy("step").collect()
    back = 0.0
    for r, (_, s, a) in zip(out, rows):
        back += r.rate * (3 if s <= 12 else 6)
        assert abs(back - a) < 1e-9


def test_linear_knots_exact(spark):
    d = spark.createDataFrame([(0, t, 2.0 * t + 1) for t in (0, 3, 6, 12)], "r int, step int, v double")
    out = P.interpolate_hourly(d, ["r"], "v").orderBy("hour").collect()
    assert [r.hour for r in out] == list(range(13))
    assert all(abs(r.v - (2 * r.hour + 1)) < 1e-12 for r in out)


def test_interpolation_hits_every_knot(spark):
    knots = [(0, 0, 1.0), (0, 3, 4.0), (0, 6, -2.0), (0, 12, 7.5), (0, 18, 0.0)]
    d = spark.createDataFrame(knots, "r int, step int, v double")
    out = {r.hour: r.v for r in P.interpolate_hourly(d, ["r"], "v").collect()}
    assert len(out) == 19
    assert all(out[s] == v for _, s, v in knots)


def test_interpolation_hits_a_knot_before_a_null(spark):
    d = spark.createDataFrame([(1, 0, 1.0), (1, 3, 4.0), (1, 6, None), (1, 9, 7.0)], "r int, step int, v double")
    out = {x.hour: x.v for x in P.interpolate_hourly(d, ["r"], "v").collect()}
    assert out == {0: 1.0, 1: 2.0, 2: 3.0, 3: 4.0, 4: None, 5: None, 6: None, 7: None, 8: None, 9: 7.0}


def test_natural_sort(spark):
    d = spark.createDataFrame([("FSM_pt_10",), ("FSM_pt_2",), ("fsm_pt_1",)], "name string")
    got = [r.name for r in d.orderBy(PT.natural_sort_key(F.col("name"))).collect()]
    assert got == ["fsm_pt_1", "FSM_pt_2", "FSM_pt_10"]


def test_region_mean_unweighted(spark):
    zm = spark.createDataFrame([("a", None), ("b", 5.0), ("c", 4.0)], "zone string, mean double")
    zm = zm.withColumn("variable", F.lit("SWE")).withColumn("date", F.lit(dt.date(2024, 1, 1)))
    zr = spark.createDataFrame([("a", "R"), ("b", "R"), ("c", "R")], "zone string, region string")
    assert Z.region_mean(zm, zr).first().mean == 4.5


def test_half_pixel_shift(spark):
    # 2x2 pixels of 500 m, centres at x 250/750, y 750/250; zone covers the
    # NW quarter of the NW pixel only (x 0..250, y 750..1000)
    px = spark.createDataFrame([(r * 2 + c, r, c, 250.0 + 500 * c, 750.0 - 500 * r) for r in (0, 1) for c in (0, 1)],
                               "pixel int, row_i int, col_i int, x double, y double")
    ring = [(-10.0, 1010.0), (240.0, 1010.0), (240.0, 760.0), (-10.0, 760.0)]
    edges = spark.createDataFrame([("Z", "R", i + 1, *ring[i], *ring[(i + 1) % 4]) for i in range(4)],
                                  "zone string, region string, edge int, x1 double, y1 double, x2 double, y2 double")
    assert G.zone_pixels(edges, px, 500.0, coord="center").count() == 0
    assert [r.pixel for r in G.zone_pixels(edges, px, 500.0, coord="corner_as_center").collect()] == [0]


def test_rolling_bundle_sizes(spark):
    d = spark.createDataFrame([(dt.date(2024, 1, k),) for k in range(1, 13)], "date date")
    b = PB.rolling_bundles(d, F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 5)), 10)
    n = {r.bundle_date.day: r["count"] for r in b.groupBy("bundle_date").count().collect()}
    assert n[1] == n[2] == n[3] == 10 and n[5] == 8


def test_bad_names(spark):
    d = spark.createDataFrame([("SWE_20251301.nc",), ("SWE_20251001.nc",), ("SWE.nc",)], "name string")
    got = FL.dated_files(d).collect()
    assert [(r.name, r.date) for r in got] == [("SWE_20251001.nc", dt.date(2025, 10, 1))]


def test_priority_merge_idempotent(spark):
    d = spark.createDataFrame([(1, 1, None), (1, 2, 3.0), (2, 2, 4.0), (2, 1, 1.0)], "k int, prio int, v double")
    once = M.priority_merge(d, ["k"], ["v"])
    twice = M.priority_merge(once.withColumn("prio", F.lit(1)), ["k"], ["v"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_supersede_partitions_input(spark):
    h = spark.createDataFrame([(dt.date(2024, 1, d), float(d)) for d in range(1, 6)], "date date, v double")
    r = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2)], "date date")
    out = Q.supersede(h, r)
    assert out.count() == 5
    assert out.where("state = 'archive'").count() == 2


def test_keep_last_keys_unique(spark):
    from firn.sources import standins as S
    from firn.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    s = S.s5(t)
    k = PT.keep_last(s.where("src = 'archive'"), s.where("src = 'latest'"), ["cluster", "date"])
    both = k.where(~(F.col("cluster") % 10).isin(S.ARCHIVE_ONLY, S.LATEST_ONLY))
    assert both.count() == both.select("cluster", "date").distinct().count()
    alone = s.where((F.col("cluster") % 10).isin(S.ARCHIVE_ONLY, S.LATEST_ONLY))
    assert alone.count() == k.count() - both.count() > alone.select("cluster", "date").distinct().count()


def test_allow_list_raises(spark):
    import pytest
    d = spark.createDataFrame([("SWE",), ("GST",)], "parameter string")
    with pytest.raises(Exception):
        PB.assert_allowed(d).collect()
    assert PB.assert_allowed(d.where("parameter = 'SWE'")).count() == 1


def test_text_roundtrip_with_nulls(spark):
    from firn.sources import textio
    rows = [("FSM_pt_7", ts("2024-01-01T00:00"), None, 2.0, 3.0), ("FSM_pt_7", ts("2024-01-01T01:00"), 1.0, None, None)]
    d = spark.createDataFrame(rows, "point string, time timestamp_ntz, swe double, snd double, rof double")
    path = textio.scratch_path(spark, "nulls")
    textio.write_point_text(d, path, "point", "time", ["swe", "snd", "rof"])
    back = textio.read_point_text(spark, path, ["swe", "snd", "rof"]).orderBy("time").collect()
    assert [tuple(r)[2:] for r in back] == [(None, 2.0, 3.0), (1.0, None, None)] and {r.cluster for r in back} == {7}


def test_wide_csv_goes_by_header(spark):
    from firn.sources.textio import scratch_path
    path = scratch_path(spark, "header")
    spark.createDataFrame([(dt.date(2024, 1, 1), 2.0, 1.0)], "date date, B double, A double").write.option("header", True).csv(path)
    got = {r.zone: r.mean for r in FL.read_wide_csv(spark, path, "date", ["A", "B"]).collect()}
    assert got == {"A": 1.0, "B": 2.0} == {r.zone: r.mean for r in FL.read_wide_csv(spark, path, "date").collect()}


def test_bilinear_edges_and_outside(spark):
    src = spark.createDataFrame([(i, j, ts("2024-01-01T00:00"), 10.0 * i + j) for i in (0, 1) for j in (0, 1)],
                                "lat_i int, lon_i int, time timestamp_ntz, value double")
    at = {(0.0, 0.0): 0.0, (1.0, 1.0): 11.0, (1.0, 0.5): 10.5, (0.5, 1.0): 6.0, (0.5, 0.5): 5.5, (2.0, 0.0): None, (1.5, 0.5): None}
    got = M.bilinear_regrid(src, spark.createDataFrame(list(at), "t_lat double, t_lon double"), "value", 0.0, 1.0, 0.0, 1.0)
    assert {(r.t_lat, r.t_lon): r.value for r in got.collect()} == at


def test_overlay_corrected(spark):
    e = spark.createDataFrame([("e", dt.datetime(2024, 1, d), 1.0) for d in range(1, 11)], "src string, time timestamp_ntz, value double")
    f = spark.createDataFrame([("f", dt.datetime(2024, 1, d), 2.0) for d in range(5, 9)], "src string, time timestamp_ntz, value double")
    out = M.overlay(e, f, corrected=True)
    assert sorted(r.time.day for r in out.where("src = 'e'").collect()) == [1, 2, 3, 4, 9, 10]


def test_outer_merge_conflict_raises(spark):
    import pytest
    a = spark.createDataFrame([(1, 1.0), (2, None)], "k int, value double")
    b = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, value double")
    assert sorted(map(tuple, M.outer_merge(a, b, ["k"], ["value"]).collect())) == [(1, 1.0), (2, 3.0)]
    with pytest.raises(Exception, match="conflicting"):
        M.outer_merge(a, b, ["k"], ["value"], on_conflict="error").collect()


def test_natural_sort_of_long_digit_runs(spark):
    names = ["p_100000000000000000002", "p_99999999999999999999", "p_100000000000000000001", "p_007", "p_7a"]
    d = spark.createDataFrame([(n,) for n in names], "name string").withColumn("k", PT.natural_sort_key(F.col("name")))
    got = [r.name for r in d.orderBy("k").collect()]
    assert got == ["p_007", "p_7a", "p_99999999999999999999", "p_100000000000000000001", "p_100000000000000000002"]


def test_conflicting_knots_fail(spark):
    import pytest
    d = spark.createDataFrame([(0, 0, 1.0), (0, 0, 1.0), (0, 3, 2.0)], "r int, step int, acc double")
    assert P.deaccumulate(d, ["r"], "acc").count() == 2
    with pytest.raises(Exception, match="different values"):
        P.deaccumulate(d.union(spark.createDataFrame([(0, 3, 5.0)], d.schema)), ["r"], "acc").collect()
