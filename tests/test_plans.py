"""Plan guards: no cartesian or nested-loop joins; filters reach the scan;
windows only on partitions bounded by construction."""

import contextlib
import io

import pytest

from firn.plans import registry

from conftest import SF_SMALL

registry.load_all()
# windows on partitions that are bounded by construction: a run's steps (run, cell), the crossings of a pixel
# row (zone, row), the rows of a cell's day, a point's calendar day, a month's files, a source's days
BOUNDED_WINDOWS = {"w01_deaccumulate", "w02_interpolate", "w03_hindcast_day", "j11_zone_pixels", "j11_zone_runs", "m02_cluster_weights",
                   "j11_corner_as_center", "a01_polygon_zonal_mean", "m02_factorised_mean",
                   "chain_hourly_forcing", "chain_zone_products", "p06_level_hpa", "so04_merge_time",
                   "so02_hydro_sort", "so03_sort_by_date", "a10_days_first_seen"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_pairwise_joins(spark, name):
    p = plan(registry.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    if name not in BOUNDED_WINDOWS:
        assert "Window " not in p and "Window\n" not in p, "unexpected window"


def test_filters_pushed(spark):
    p = plan(registry.QUERIES["p10_water_year_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "LessThan(l_shipdate" in p
    p = plan(registry.QUERIES["p01_bbox"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


@pytest.mark.parametrize("name,fn", [("a07_keep_last", "partial_max_by"), ("j01_priority_merge", "partial_min_by"),
                                     ("w04_latest_run", "partial_max_by"), ("a06_dedupe_first", "partial_min_by")])
def test_row_pickers_combine_map_side(spark, name, fn):
    """Copies of a hot key are reduced before the shuffle, by hash."""
    p = plan(registry.QUERIES[name](spark, SF_SMALL))
    assert fn in p and "SortAggregate" not in p


@pytest.mark.parametrize("name,most", [("j08_month_completeness", 3), ("a12_missing_steps", 3), ("j05_conflict_variables", 4),
                                       ("u04_common_dates", 7), ("a03_pivot_wide", 5), ("p10_water_year_filter", 3)])
def test_exchanges(spark, name, most):
    """Shuffles of the initial plan (a query on S1 has one for S1 itself)."""
    import re
    p = registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", p)) <= most, p


def test_hot_key_third_of_rows(spark):
    """One (cluster, date) holds a third of all rows: the overlay still
    returns one whole winning row per key."""
    from pyspark.sql import functions as F

    from firn.operators.points import keep_last
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("cluster"),
        F.lit(1).alias("date"), (F.col("id") % 2 + 1).alias("prio"),
        F.col("id").alias("ord"), F.col("id").cast("double").alias("swe"))
    out = keep_last(df.where("prio = 1"), df.where("prio = 2"), ["cluster", "date"])
    assert out.count() == out.select("cluster", "date").distinct().count() == 1 + (n - n // 3)  # the others are one-sided
    hot = out.where("cluster = 0").first()
    # latest (prio 2 = odd ids) wins, last position among them
    assert hot.prio == 2 and hot.swe == float(max(i for i in range(0, n, 3) if i % 2 == 1))
