"""Zonal statistics and zone products (A01-A03, J13, J14, P09, P10, P15,
P16, P20, U04)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.functions.timecols import date_lit, water_year, water_year_bounds
from firn.operators.common import BLOCK, Blocks, block_of, distinct_values, spread
from firn.sources.textio import stored

# The nodata sentinel of the rasters.
NODATA = -9999.0
# Product variables in output order, and the quantile labels
# that all carry the same value.
PRODUCT_VARIABLES = ("SWE", "HS", "ROF")
QUANTILES = ("Q5", "Q50", "Q95")


def nodata_to_null(c: Column, sentinel: float = NODATA) -> Column:
    """-9999 and NaN become NULL."""
    return F.when(F.isnan(c) | (c == F.lit(sentinel)), F.lit(None).cast("double")).otherwise(c)


def with_water_year(df: DataFrame, date_col: str = "date", start_month: int = 9) -> DataFrame:
    """Adds ``water_year``."""
    return df.withColumn("water_year", water_year(F.col(date_col), start_month))


def filter_water_year(df: DataFrame, year: int, date_col: str = "date",
                      start_month: int = 9) -> DataFrame:
    """Rows of one water year, 1 Sep .. 31 Aug inclusive (P10).  A plain
    range predicate, so it prunes date partitions and pushes into the scan."""
    lo, hi = water_year_bounds(year, start_month)
    return df.where(F.col(date_col).between(date_lit(lo), date_lit(hi)))


def every_zone(means: DataFrame, zones: DataFrame, keys=("variable", "date"), zone_col: str = "zone",
               date_col: str = "date") -> DataFrame:
    """A row for every zone of ``zones`` and every key in ``means``, NULL where ``means`` has none.
    A key that has no zone at all stands in ``means`` with a NULL zone.

    ``means`` is stored first, as keys, their span and the values all come from it.  The zones generate the days
    between the first and the last key, which are joined to the keys by date and to the means by key and
    zone: equi-joins only, in pieces by the number of rows, and the list of zones stays a table."""
    keys = list(keys)
    means = stored(means.select(*keys, zone_col, "mean"), "zone-means")
    present = means.select(*keys).distinct()
    span = means.agg(F.struct(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))).scalar()
    days = F.sequence(span.getField("lo"), span.getField("hi"), F.expr("INTERVAL 1 DAY"))
    grid = (zones.select(zone_col).where(F.col(zone_col).isNotNull()).distinct().where(span.getField("lo").isNotNull())
            .withColumn(date_col, F.explode(days)).join(present, date_col))
    rows = zones.select(zone_col).distinct().count() * present.count()
    grid, means = (spread(d, rows, *keys, zone_col) for d in (grid, means))
    return grid.join(means, [*keys, zone_col], "left").select(*keys, zone_col, "mean")


def every_zone_in_blocks(means: DataFrame, blocks: Blocks, values=("mean",)) -> DataFrame:
    """The same for ``means`` in blocks: a block's zones and keys are joined to its means where they are, so means are
    neither stored nor shuffled.  The rows stay in their blocks."""
    on = [BLOCK, *blocks.keys, blocks.zone]
    return blocks.grid().join(means.hint("shuffle_hash"), on, "left").select(*on, *values)


def zonal_mean(values: DataFrame, zones: DataFrame, keys=("variable", "date"),
               zone_col: str = "zone", value_col: str = "value",
               key_rows: DataFrame | None = None, blocks: Blocks | None = None) -> DataFrame:
    """Mean of valid pixel values per key and zone; every zone appears for
    every key present, NULL when it has no valid pixel (A01).

    ``values`` carries one row per (pixel, key) already tagged with its zone
    (a pixel in overlapping zones appears once per zone).  The mean is a
    partial+final aggregate, so a hot zone is combined map-side, and stays long: the number of zones
    is not limited.  ``key_rows`` names keys that must appear even where no zone has a value.
    ``values`` in ``blocks`` are grouped and filled up inside them; zones and keys are then those of the blocks.
    """
    keys = list(keys)
    v = values.select(*block_of(values), *keys, zone_col, nodata_to_null(F.col(value_col)).alias(value_col))
    if blocks is not None:
        means = v.groupBy(BLOCK, *keys, zone_col).agg(F.avg(value_col).alias("mean"))
        return every_zone_in_blocks(means, blocks).drop(BLOCK)
    if key_rows is not None:
        none = [F.lit(None).cast(v.schema[c].dataType).alias(c) for c in (zone_col, value_col)]
        v = v.unionByName(key_rows.select(*keys).distinct().select(*keys, *none))
    means = v.groupBy(*keys, zone_col).agg(F.avg(value_col).alias("mean"))
    return every_zone(means, zones, keys, zone_col)


def zonal_mean_of_files(values: DataFrame, units: DataFrame, zones: DataFrame, key: str = "variable", month: str = "month",
                        date_col: str = "date", zone_col: str = "zone", value_col: str = "value") -> DataFrame:
    """A01 from rasters in monthly files: ``values`` are the rows of the good ones, ``units`` lists all files with a
    ``reason`` for the bad ones.  A bad file has no rows to tell its days, so it stands for every day of the month
    in its name; all zones are NULL on these days."""
    days = F.explode(F.sequence(F.col(month), F.last_day(month), F.expr("INTERVAL 1 DAY")))
    lost = units.where("reason IS NOT NULL").select(key, days.alias(date_col))
    present = values.select(key, date_col).distinct().union(lost)
    return zonal_mean(values, zones, (key, date_col), zone_col, value_col, key_rows=present)


def region_mean(zone_means: DataFrame, zone_region: DataFrame, keys=("variable", "date"),
                zone_col: str = "zone", region_col: str = "region", blocks: Blocks | None = None) -> DataFrame:
    """Plain mean of catchment means per region, NULLs skipped.
    Not pixel-weighted: each catchment counts once.  Means in ``blocks`` meet the zone map there and are not shuffled."""
    keys = list(keys)
    zr = zone_region.select(zone_col, region_col).distinct()
    if blocks is not None:
        zr = blocks.of_zones(zr).hint("shuffle_hash")
    # the zone map is a small parquet-backed table: the planner broadcasts
    # it from its size statistics (and AQE from its runtime size)
    return (zone_means.join(zr, [*block_of(zr), zone_col])
            .groupBy(*keys, region_col).agg(F.avg("mean").alias("mean")))


def pivot_wide(long: DataFrame, zones: list[str], key: str = "date", zone_col: str = "zone",
               value_col: str = "mean") -> DataFrame:
    """Long -> wide: ``key`` plus one column per zone, in the given order.
    Only a wide table needs the list of zones, which becomes its columns."""
    return long.groupBy(key).pivot(zone_col, zones).agg(F.first(value_col)).select(key, *zones)


def zone_product(zone_means: DataFrame, as_of: str, zone_col: str = "zone",
                 variables=PRODUCT_VARIABLES) -> DataFrame:
    """Per-zone product table.

    One row per (zone, date) where every variable has a date row (inner
    semantics of the three-way date join, NULL values kept); the three
    quantile columns carry the same value; FC = date >= as_of.
    A single conditional aggregate replaces the three joins; means in blocks are grouped where they are.
    """
    aggs = []
    for v in variables:
        aggs.append(F.max(F.when(F.col("variable") == v, F.lit(1))).alias(f"_has_{v}"))
        aggs.append(F.max(F.when(F.col("variable") == v, F.col("mean"))).alias(f"_v_{v}"))
    g = zone_means.where(F.col("variable").isin(*variables)).groupBy(*block_of(zone_means), zone_col, "date").agg(*aggs)
    g = g.where(reduce(lambda a, b: a & b, [F.col(f"_has_{v}").isNotNull() for v in variables]))
    cols = [F.col(f"_v_{v}").alias(f"{q}_{v}") for q in QUANTILES for v in variables]
    return g.select(zone_col, "date", *cols, (F.col("date") >= date_lit(as_of)).alias("FC"))


def common_dates(values: DataFrame, variables, date_col: str = "date", variable_col: str = "variable") -> DataFrame:
    """Dates that every one of ``variables`` has (U04): one aggregate over the
    distinct (variable, date) of the source, no statistics needed."""
    have = values.where(F.col(variable_col).isin(*variables)).select(variable_col, date_col).distinct()
    return (have.groupBy(date_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(set(variables)))
            .select(date_col))


def ensure_columns(df: DataFrame, cols: list[str], dtype: str = "double") -> DataFrame:
    """Fixed column order; absent columns appear as NULL (P20)."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(dtype).alias(c) for c in cols])


def zones_of(zone_region: DataFrame, zone_col: str = "zone") -> list[str]:
    """Sorted zone names, for the columns of a wide table."""
    return distinct_values(zone_region, zone_col)
