"""Forcing preparation: subset, renames, derived fields, deaccumulation,
interpolation, run selection (P01-P07, W01-W04, A06).

Per-run windows (lag/lead, row_number) are partitioned by (run, cell): a
forecast run has a bounded number of steps (65 operationally), so no
window partition grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firn.functions.geodesy import geopotential_level, geopotential_surface
from firn.operators.common import best_row

# Default bounding box of the domain (inclusive).
DEFAULT_LAT = (32.0, 45.0)
DEFAULT_LON = (59.0, 81.0)
# Renames from forecast parameter names to reanalysis names.
SURFACE_RENAMES = {"2t": "t2m", "2d": "d2m"}
PRECIP_NAMES = ("tp", "param193.1.0")
# Accumulated parameters.
ACCUMULATED = ("tp", "ssrd", "strd")


def bbox(df: DataFrame, lat=DEFAULT_LAT, lon=DEFAULT_LON, lat_col="lat", lon_col="lon") -> DataFrame:
    """Inclusive bounding-box subset (P01); a plain range predicate that
    reaches the parquet scan."""
    return df.where(F.col(lat_col).between(*lat) & F.col(lon_col).between(*lon))


def rename_with_fallback(df: DataFrame, renames: dict[str, str] = SURFACE_RENAMES,
                         alternatives: tuple[str, ...] = PRECIP_NAMES, target: str = "tp") -> DataFrame:
    """Rename parameters; ``target`` comes from the first alternative
    name present (P02)."""
    have = set(df.columns)
    mapping = {k: v for k, v in renames.items() if k in have}
    for alt in alternatives:
        if alt in have:
            if alt != target:
                mapping[alt] = target
            break
    return df.withColumnsRenamed(mapping)


def drop_fields(df: DataFrame, *cols: str) -> DataFrame:
    """Drop variables and singleton dimensions."""
    return df.drop(*cols)


def with_surface_geopotential(df: DataFrame, t="t2m", p="sp", p0="msl", out="z") -> DataFrame:
    """z = 287 T ln(P0/P)."""
    return df.withColumn(out, geopotential_surface(F.col(t), F.col(p), F.col(p0)))


def with_level_geopotential(df: DataFrame, gh="gh", out="z") -> DataFrame:
    """z = gh * 9.81."""
    return df.withColumn(out, geopotential_level(F.col(gh)))


def to_hpa(df: DataFrame, plev="plev", out="level") -> DataFrame:
    """Pressure level Pa -> hPa."""
    return df.withColumn(out, F.col(plev) / 100.0)


def allow_list(df: DataFrame, keys: list[str], params: list[str], levels=None,
               level_col="level") -> DataFrame:
    """Projection to the parameter allow-list and level filter (P07);
    both prune/push into the scan."""
    out = df.select(*keys, *params)
    if levels is not None:
        out = out.where(F.col(level_col).isin(*levels))
    return out


def step_width(step: Column, switch: int = 144, fine: int = 3, coarse: int = 6) -> Column:
    return F.when(step <= switch, F.lit(fine)).otherwise(F.lit(coarse))


def unique_knots(df: DataFrame, run_keys: list[str], step: str, value: str) -> DataFrame:
    """One row per (run, step): repeated deliveries of a knot collapse in a
    partial+final aggregate before any per-run window, so a window
    partition never holds more rows than the run has steps.  Deliveries of
    one knot that differ are a data error: the job fails on them rather than choose one."""
    low, high = F.min(value), F.max(value)
    alike = F.when(low == high, high).when(low.isNull(), high).otherwise(
        F.raise_error(F.concat(F.lit("different values for one knot, step "), F.col(step).cast("string"))).cast("double"))
    return df.groupBy(*run_keys, step).agg(alike.alias(value))


def deaccumulate(df: DataFrame, run_keys: list[str], acc: str, step: str = "step",
                 out: str = "rate", switch: int = 144, fine: int = 3, coarse: int = 6) -> DataFrame:
    """(a_t - a_prev) / step width, the first step minus 0 (W01).  The
    default 0 applies only at the run edge; a NULL neighbour gives NULL."""
    df = unique_knots(df, run_keys, step, acc)
    w = Window.partitionBy(*run_keys).orderBy(step)
    prev = F.lag(F.col(acc), 1, 0.0).over(w)
    return df.withColumn(out, (F.col(acc) - prev) / step_width(F.col(step), switch, fine, coarse))


def interpolate_hourly(knots: DataFrame, run_keys: list[str], value: str, step: str = "step",
                       out_step: str = "hour") -> DataFrame:
    """Piecewise-linear hourly values between irregular knots.

    Equals the chained 6h->3h->1h interpolations; each knot emits the
    hours up to (not including) the next knot, the last knot itself.  Every knot keeps its value; hours between
    knots of which one is NULL are NULL.
    Only knots are shuffled; the hours are generated after the shuffle.
    """
    w = Window.partitionBy(*run_keys).orderBy(step)
    k = (unique_knots(knots, run_keys, step, value).withColumn("_s2", F.lead(step).over(w))
         .withColumn("_v2", F.lead(value).over(w)))
    hrs = F.when(F.col("_s2").isNull(), F.array(F.col(step))).otherwise(
        F.sequence(F.col(step), F.col("_s2") - 1))
    k = k.withColumn(out_step, F.explode(hrs))
    frac = (F.col(out_step) - F.col(step)) / (F.col("_s2") - F.col(step))
    # at a knot its own value, also where the next knot has none
    v = F.when(F.col("_s2").isNull() | (F.col(out_step) == F.col(step)), F.col(value)).otherwise(
        F.col(value) + (F.col("_v2") - F.col(value)) * frac)
    return k.select(*run_keys, out_step, v.alias(value))


def first_hours(df: DataFrame, run_keys: list[str], order: str, n: int = 24,
                label_from: str | None = None, label: str = "label_date") -> DataFrame:
    """First ``n`` rows of each run, labelled by the day of its first row."""
    w = Window.partitionBy(*run_keys).orderBy(order)
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
    if label_from:
        out = out.withColumn(label, F.to_date(F.min(label_from).over(Window.partitionBy(*run_keys))))
    return out


def latest_run(df: DataFrame, keys: list[str], run_col: str, prefer: str = "latest") -> DataFrame:
    """Whole row of one run per key (W04).  ``latest`` takes the newest run;
    ``first`` is the variant of the operational merge, in which the row that comes first in file order
    (the oldest run) stays.  ``run_col`` is a long or a date."""
    run = F.col(run_col)
    rank = F.unix_date(run) if dict(df.dtypes)[run_col] == "date" else run
    return best_row(df, keys, rank, least=prefer == "first")


def first_in_order(df: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """Dedupe on ``keys`` keeping the row with the lowest explicit merge
    rank (A06)."""
    return best_row(df, keys, rank, least=True)
