"""Point (cluster) series: overlay of fresh results on an archive, run
concatenation, name sets and sorts (A07, J20, U02, SO01, SO02, A11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.functions.names import natural_key
from firn.functions.timecols import hydro_month
from firn.operators.common import best_row, spread


def keep_last(archive: DataFrame | None, latest: DataFrame | None, keys: list[str], point: str = "cluster",
              order: str = "ord", prio: str = "prio") -> DataFrame:
    """Archive then latest, one row per key, the *whole* row of the latest
    wins and, inside one input, the last in file order (A07).

    The rule holds per point, as each point is a file: a point that only one input has passes
    through unchanged, duplicates kept.  ``order`` is a long below 2^61 that gives the
    file order.  Which inputs have a point is one aggregate, joined once; a row of a one-sided point is then a group of
    its own.  The winner is a partial+final aggregate over one long rank, so copies of a hot key
    are combined on the map side, by hash where the columns have fixed widths.  Rows come together by point in
    pieces of bounded size, where they are grouped.
    """
    if archive is None or latest is None:
        return archive if latest is None else latest
    both = archive.unionByName(latest)
    sides = archive.select(point, F.lit(1).alias("_side")).union(latest.select(point, F.lit(2).alias("_side")))
    sides = sides.groupBy(point).agg(F.bit_or("_side").alias("_sides"))
    rows = spread(both, both.count(), point).join(sides, point)
    alone = F.when(F.col("_sides") < 3, F.monotonically_increasing_id())
    rank = F.col(prio).cast("bigint") * F.lit(1 << 61) + F.col(order)
    return best_row(rows.withColumn("_alone", alone).drop("_sides"), [*keys, "_alone"], rank).select(*archive.columns)


# Name prefix of point series files.
POINT_PREFIX = "FSM_pt_"


def point_name(cluster: Column, prefix: str = POINT_PREFIX) -> Column:
    return F.concat(F.lit(prefix), cluster.cast("string"))


def concat_runs(runs: DataFrame, run_col: str, name_col: str, first_run) -> DataFrame:
    """Concatenate runs per point; the point list comes from the first run
    only (J20).  Semi-join on the (small) name set of that run."""
    names = runs.where(F.col(run_col) == F.lit(first_run)).select(name_col).distinct()
    return runs.join(names, name_col, "left_semi")


def name_union(a: DataFrame, b: DataFrame, name_col: str = "name") -> DataFrame:
    """Distinct union of the point names of two sets."""
    return a.select(name_col).union(b.select(name_col)).distinct()


def natural_sort_key(name: Column, sep: str = "|") -> Column:
    """String form of the natural sort key (SO01): ordering by it equals
    ordering by the digit-aware key, for digit runs of any length."""
    return F.array_join(natural_key(name), sep)


def hydro_sort(df: DataFrame, keys: list[str], date_col: str, order: str,
               start_month: int = 9) -> DataFrame:
    """Hydrological order: (month with Sep first, day), stable on ``order``;
    the year is not part of the key (SO02).  A distributed range sort; ``order`` breaks ties."""
    d = F.col(date_col)
    out = df.withColumn("hydro_month", hydro_month(d, start_month)).withColumn(
        "dom", F.dayofmonth(d).cast("int"))
    return out.orderBy(*keys, "hydro_month", "dom", order)
