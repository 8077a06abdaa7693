"""Merging sources of different precedence (J01-J05, J19, U01, SO04).

Two semantics are kept apart on purpose: ``priority_merge`` coalesces cell
by cell and variable by variable; ``overlay`` (and ``keep_last`` in
points.py) replaces whole rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firn.functions.timecols import add_hours
from firn.operators import quality as Q


def concat(*frames: DataFrame) -> DataFrame:
    """Concatenate, duplicates kept; columns matched by name, missing -> NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_time(*frames: DataFrame, time: str = "time", ties: tuple[str, ...] = ()) -> DataFrame:
    """Time-ordered merge without removing duplicates (SO04).  ``ties`` are further
    order columns; they also let the range sort split an instant that holds many rows."""
    return concat(*frames).orderBy(time, *ties)


def priority_merge(frames: DataFrame, keys: list[str], variables: list[str],
                   prio: str = "prio", source: str | None = None) -> DataFrame:
    """Per key and per variable the first non-NULL value by ascending
    priority (J01).  One shuffle on the key for any number of sources, and
    the aggregate is partial+final, so hot keys combine map-side.
    ``source`` names a column for the priority that the first variable came from."""
    aggs = [F.min_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(prio))).alias(v) for v in variables]
    if source:
        aggs.append(F.min(F.when(F.col(variables[0]).isNotNull(), F.col(prio))).alias(source))
    return frames.groupBy(*keys).agg(*aggs)


def gap_days(reanalysis: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Days with at least one missing hour inside the reanalysis span."""
    return (Q.missing_hours(reanalysis.select(*keys, time).distinct(), keys, time)
            .select(*keys, F.to_date(time).alias("_day")).distinct())


def gap_limited_fill(reanalysis: DataFrame, hindcast: DataFrame, keys: list[str],
                     merge_keys: list[str], variables: list[str], time: str = "time",
                     prio: str = "prio") -> DataFrame:
    """Use a hindcast day only if the reanalysis misses an hour of it within
    its own span, then priority-merge (J02)."""
    gaps = gap_days(reanalysis, keys, time)
    h = (hindcast.withColumn("_day", F.to_date(time))
         .join(gaps, [*keys, "_day"], "left_semi").drop("_day"))
    return priority_merge(concat(reanalysis, h), merge_keys, variables, prio)


def append_missing_days(reanalysis: DataFrame, hindcast: DataFrame, continuous: DataFrame,
                        time: str = "time") -> DataFrame:
    """Reanalysis + hindcast rows of missing days + all continuous rows, no
    dedupe (J03).  As coded, "missing" tests the exact instants first,
    first + 1 day, ... up to the last reanalysis time."""
    b = reanalysis.agg(F.min(time).alias("start"), F.max(time).alias("end"))
    days = b.select(F.explode(F.sequence("start", "end", Q.one_day())).alias(time))
    have = reanalysis.select(time).distinct()
    missing = days.join(have, time, "left_anti").select(F.to_date(time).alias("_day"))
    h = (hindcast.withColumn("_day", F.to_date(time))
         .join(missing, "_day", "left_semi").drop("_day"))
    return concat(reanalysis, h, continuous)


def overlay(earlier: DataFrame, forecast: DataFrame, time: str = "time", corrected: bool = False) -> DataFrame:
    """Forecast overlay (J04): if the time ranges share more than one
    instant, keep earlier rows before the overlap start only, then append
    the forecast.  As coded, a single shared instant is not an overlap (it
    stays twice) and earlier rows behind the forecast's end are lost; ``corrected`` keeps every earlier
    row outside the forecast's range and none inside."""
    def bounds(df):
        return df.agg(F.struct(F.min(time).alias("lo"), F.max(time).alias("hi"))).scalar()
    e, f = bounds(earlier), bounds(forecast)
    t = F.col(time)
    if corrected:
        keep = f.getField("lo").isNull() | (t < f.getField("lo")) | (t > f.getField("hi"))
    else:
        o0 = F.greatest(e.getField("lo"), f.getField("lo"))
        o1 = F.least(e.getField("hi"), f.getField("hi"))
        keep = (o1 <= o0) | (t <= add_hours(o0, -1))
    return concat(earlier.where(keep), forecast)


def regrid_overlay(earlier: DataFrame, forecast: DataFrame, targets: DataFrame, value: str, lat0: float, dlat: float,
                   lon0: float, dlon: float, time: str = "time", corrected: bool = False) -> DataFrame:
    """The whole overlay step (J04): the forecast, on its own regular grid, is interpolated
    to the ``targets`` (the earlier data's points, t_lat and t_lon) and then overlaid."""
    on_grid = bilinear_regrid(forecast, targets, value, lat0, dlat, lon0, dlon, time)
    return overlay(earlier.select(*targets.columns, time, value), on_grid, time, corrected)


def outer_merge(left: DataFrame, right: DataFrame, keys: list[str], variables: list[str],
                on_conflict: str = "left") -> DataFrame:
    """Full outer merge on keys (J05).  Where both sides hold different values, ``left`` lets the
    left one win, and ``error`` fails the job, as the operational merge does."""
    l = left.select(*keys, *[F.col(v).alias(f"_l_{v}") for v in variables])
    r = right.select(*keys, *[F.col(v).alias(f"_r_{v}") for v in variables])
    j = l.join(r, keys, "full_outer")

    def value(v):
        one = F.coalesce(f"_l_{v}", f"_r_{v}")
        if on_conflict == "left":
            return one
        return F.when(F.col(f"_l_{v}") != F.col(f"_r_{v}"), F.raise_error(F.lit(f"conflicting values of {v}")).cast(
            dict(left.dtypes)[v])).otherwise(one)
    return j.select(*keys, *[value(v).alias(v) for v in variables])


def merge_conflicts(left: DataFrame, right: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """Keys where both sides hold different non-NULL values (J05: the
    library raises; here they are returned as a table).  One join for all variables."""
    pairs = F.array(*[F.struct(F.col(f"l.{v}").cast("double").alias("left_value"), F.col(f"r.{v}").cast("double").alias("right_value"),
                               F.lit(v).alias("variable")) for v in variables])
    both = left.select(*keys, *variables).alias("l").join(right.select(*keys, *variables).alias("r"), keys)
    rows = both.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*")
    return rows.where(F.col("left_value") != F.col("right_value"))


def bilinear_regrid(source: DataFrame, targets: DataFrame, value: str, lat0: float, dlat: float, lon0: float,
                    dlon: float, time: str = "time") -> DataFrame:
    """Bilinear interpolation from a regular source grid (index columns
    ``lat_i``/``lon_i``) to target points (``t_lat``, ``t_lon``) at every time of the source (J19).

    Each target explodes into its corners of non-zero weight (one on a grid node, two on a
    grid line, else four) and is equi-joined to the source.  A target gets NULL where one of these is missing or
    NULL, so also outside the grid.  Each target generates the hours of the source's span, of
    which those that the source has stay: no product is joined.
    """
    fy = (F.col("t_lat") - F.lit(lat0)) / F.lit(dlat)
    fx = (F.col("t_lon") - F.lit(lon0)) / F.lit(dlon)
    corners = F.filter(F.array(*[F.struct(
        (F.floor(fy).cast("int") + di).alias("lat_i"), (F.floor(fx).cast("int") + dj).alias("lon_i"),
        ((fy - F.floor(fy) if di else 1 - (fy - F.floor(fy))) * (fx - F.floor(fx) if dj else 1 - (fx - F.floor(fx)))).alias("w"))
        for di in (0, 1) for dj in (0, 1)]), lambda c: c["w"] > 0)
    key = targets.columns
    t = targets.withColumn("_corners", corners)
    at = t.select(*key, F.size("_corners").alias("_need"), F.explode("_corners").alias("_c")).select(
        *key, "_need", "_c.lat_i", "_c.lon_i", "_c.w")
    got = (at.join(source.select("lat_i", "lon_i", time, value), ["lat_i", "lon_i"]).groupBy(*key, time)
           .agg(F.sum(F.col("w") * F.col(value)).alias("_s"), F.count(value).alias("_n"), F.max("_need").alias("_need"))
           .where(F.col("_n") == F.col("_need")).select(*key, time, F.col("_s").alias(value)))
    have = source.select(time).distinct()
    span = have.agg(F.struct(F.min(time).alias("start"), F.max(time).alias("end"))).scalar()
    dense = Q.hour_range(targets.where(span.getField("start").isNotNull()).withColumn("_s", span.getField("start"))
                         .withColumn("_e", span.getField("end")), "_s", "_e", time).drop("_s", "_e")
    return dense.join(have, time, "left_semi").join(got, [*key, time], "left").select(*key, time, value)
