"""Series quality: generators, gaps, duplicates, coverage, trims
(G01-G04, J06-J10, A04, A05, A08-A10, A12, P11-P14, P18, P19, U03).

Expected timelines are generated per series from its own bounds, two
levels deep (days, then hours inside each day) so that no single row
expands into an unbounded array; comparisons with the data are equi- or
anti-joins on (series, time), which never concentrate a series in one
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.functions.timecols import add_days, add_hours, date_lit, day_start, ntz

def one_hour() -> Column:
    return F.expr("INTERVAL 1 HOUR")


def one_day() -> Column:
    return F.expr("INTERVAL 1 DAY")


def hour_range(bounds: DataFrame, start: str = "start", end: str = "end",
               out: str = "time") -> DataFrame:
    """Every whole hour from ``start`` to ``end`` inclusive, per row.
    Bounds are hour-aligned TIMESTAMP_NTZ."""
    s, e = F.col(start), F.col(end)
    days = bounds.withColumn("_day", F.explode(F.sequence(F.to_date(s), F.to_date(e))))
    lo = F.greatest(s, F.col("_day").cast("timestamp_ntz"))
    hi = F.least(e, add_hours(F.col("_day").cast("timestamp_ntz"), 23))
    return days.withColumn(out, F.explode(F.sequence(lo, hi, one_hour()))).drop("_day")


def day_range(bounds: DataFrame, start: str = "start", end: str = "end",
              out: str = "date") -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive (G02); empty when end < start."""
    s, e = F.to_date(F.col(start)), F.to_date(F.col(end))
    return (bounds.where(s <= e)
            .withColumn(out, F.explode(F.sequence(s, e, one_day()))))


def step_list(switch: int = 144, fine: int = 3, coarse: int = 6, last: int = 240) -> Column:
    """Irregular forecast steps: 0..switch by ``fine``, then by ``coarse`` up
    to ``last`` (G04; defaults are the operational 0..144/3, 150..240/6)."""
    return F.concat(F.sequence(F.lit(0), F.lit(switch), F.lit(fine)),
                    F.sequence(F.lit(switch + coarse), F.lit(last), F.lit(coarse)))


def series_bounds(series: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    return series.groupBy(*keys).agg(F.min(time).alias("start"), F.max(time).alias("end"))


def missing_hours(series: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Hours in [min, max] of each series that have no row."""
    expected = hour_range(series_bounds(series, keys, time), out=time).select(*keys, time)
    return expected.join(series.select(*keys, time), [*keys, time], "left_anti")


def duplicate_hours(series: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Extra occurrences of a time after the first, per series."""
    return (series.groupBy(*keys, time).agg((F.count(F.lit(1)) - 1).alias("n_extra"))
            .where(F.col("n_extra") > 0))


def coverage(series: DataFrame, keys: list[str], time: str = "time",
             distinct_hours: bool = False) -> DataFrame:
    """First, last, rows, expected and missing hours per series.

    As in the operational summary, rows are counted, so duplicates mask
    gaps (missing can even go negative); ``distinct_hours=True`` counts
    distinct hours instead."""
    n = F.count_distinct(time) if distinct_hours else F.count(F.lit(1))
    g = series.groupBy(*keys).agg(F.min(time).alias("first"), F.max(time).alias("last"),
                                  n.alias("n_rows"))
    expected = F.timestamp_diff("HOUR", F.col("first"), F.col("last")) + 1
    return g.withColumn("expected", expected).withColumn("missing", F.col("expected") - F.col("n_rows"))


def last_full_day(series: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Last timestamp whose hour is 23, NULL if none."""
    t = F.col(time)
    return series.groupBy(*keys).agg(F.max(F.when(F.hour(t) == 23, t)).alias("last_full"))


def month_completeness(series: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Per monthly file: hours expected from the first day 00:00 to the last
    day 23:00 of its month, hours present, hours missing (J08, A12).  A row counts
    if its time is one of the expected hours, so one off the hour hides no gap, nor does a copy."""
    month = F.trunc(F.col(time), "month")
    present = series.groupBy(*keys, month.alias("month")).agg(_expected_hours(time).alias("n_present"))
    return _completeness(present)


def _expected_hours(time: str) -> Column:
    on_the_hour = F.date_trunc("hour", F.col(time)) == F.col(time)
    return F.count_distinct(F.when(on_the_hour, F.col(time)))


def _completeness(present: DataFrame) -> DataFrame:
    missing = (F.lit(24) * F.dayofmonth(F.last_day("month")) - F.col("n_present")).cast("bigint")
    return present.withColumn("n_missing", missing).withColumn("complete", F.col("n_missing") == 0)


def file_completeness(units: DataFrame, rows: DataFrame, keys: list[str], month: str = "month",
                      time: str = "time") -> DataFrame:
    """J08 and A12 by file: a row for every file listed in ``units`` (``keys`` and ``month`` name it, ``reason`` says
    what is wrong with it), also where nothing of it can be read.  Only times inside the file's own month count.
    ``reason`` becomes ``missing hours`` for a readable file with gaps; the bad files are those with a reason."""
    inside = rows.where(F.trunc(F.col(time), "month") == F.col(month))
    present = inside.groupBy(*keys, month).agg(_expected_hours(time).alias("n_present"))
    j = units.select(*keys, month, "reason").alias("u").join(
        present.alias("p"), [F.col(f"u.{k}").eqNullSafe(F.col(f"p.{k}")) for k in (*keys, month)], "left")
    j = _completeness(j.select(*[F.col(f"u.{k}") for k in keys], F.col(f"u.{month}").alias("month"), "u.reason",
                               F.coalesce("p.n_present", F.lit(0)).alias("n_present")))
    reason = F.coalesce("reason", F.when(~F.col("complete"), "missing hours"))
    return j.select(*keys, F.col("month").alias(month), "n_present", "n_missing", reason.alias("reason"))


def missing_days(day_classes: DataFrame, classes: tuple[str, str], first_class: str,
                 latest: str, class_col: str = "file_class", day_col: str = "date") -> DataFrame:
    """Days from the first day of ``first_class`` to ``latest`` that lack
    either class (J06).  With no files at all, just ``latest``."""
    have = day_classes.where(F.col(class_col).isin(*classes))
    both = (have.groupBy(day_col).agg(F.count_distinct(class_col).alias("_n"))
            .where(F.col("_n") == len(classes)).select(day_col))
    first = (have.where(F.col(class_col) == first_class)
             .agg(F.min(day_col).alias("start"), F.lit(date_lit(latest)).alias("end")))
    first = first.select(F.coalesce("start", "end").alias("start"), "end")
    days = day_range(first, out=day_col).select(day_col)
    return days.join(both, day_col, "left_anti")


def backfill_candidates(last_reanalysis_day: Column, hindcast_days: DataFrame, as_of: str,
                        max_age: int = 3, day_col: str = "date") -> DataFrame:
    """Days strictly after the last reanalysis day and before ``as_of`` with
    no hindcast yet and at most ``max_age`` days old, as (date, offset=-age)
    (J09)."""
    spark = hindcast_days.sparkSession
    b = spark.range(1).select(F.date_add(last_reanalysis_day, 1).alias("start"),
                              F.date_sub(date_lit(as_of), 1).alias("end"))
    days = day_range(b, out=day_col).select(day_col)
    age = F.datediff(date_lit(as_of), F.col(day_col))
    return (days.join(hindcast_days.select(day_col), day_col, "left_anti")
            .where(age <= max_age).select(day_col, (-age).alias("offset")))


def supersede(hindcast: DataFrame, reanalysis_days: DataFrame, day_col: str = "date") -> DataFrame:
    """Tag hindcast rows ``archive`` when their day now has reanalysis, else
    ``live`` (J10).  The archive and live sets partition the input."""
    days = reanalysis_days.select(day_col).distinct().withColumn("_has", F.lit(True))
    return (hindcast.join(days, day_col, "left")
            .withColumn("state", F.when(F.col("_has"), "archive").otherwise("live")).drop("_has"))


def recent_days(files: DataFrame, as_of_ts: str, days: int = 9, day_col: str = "date",
                require_rows: bool = True) -> DataFrame:
    """File days with ``day >= as_of - days`` compared as timestamps (P11):
    the boundary day drops out unless ``as_of`` is midnight.  As in the
    operational code an empty window is an error: the job that reads the result fails
    (a count of the window stands as a scalar beside the filter; nothing runs while the plan is built)."""
    cutoff = add_days(ntz(as_of_ts), -days)
    out = files.where(F.col(day_col).cast("timestamp_ntz") >= cutoff)
    if not require_rows:
        return out
    n = out.agg(F.count(F.lit(1))).scalar()
    check = F.when(n > 0, F.lit(True)).otherwise(F.raise_error(
        F.lit(f"no files on or after {days} days before {as_of_ts}")).cast("boolean"))
    # a row of its own carries the check, so that it also runs on an empty window
    probe = files.sparkSession.range(1).select(check.alias("_ok"))
    kept = out.withColumn("_ok", F.lit(True))
    return kept.unionByName(probe.where(~F.col("_ok")), allowMissingColumns=True).drop("_ok")


def trim_after(forecast: DataFrame, last_time: Column, time: str = "time",
               day_boundary: bool | str = False) -> DataFrame:
    """Forecast rows from ``last_time + 1h`` on (P12); with ``day_boundary``
    the cut is the midnight of that instant (P13, as coded: a last time of
    15:00 keeps the same day, 23:00 starts the next).  ``day_boundary="next"`` is the corrected
    cut, the midnight after ``last_time``, so no day mixes both sources."""
    cut = add_hours(last_time, 1)
    if day_boundary == "next":
        cut = add_days(day_start(last_time), 1)
    elif day_boundary:
        cut = day_start(cut)
    return forecast.where(F.col(time) >= cut)


def simulation_window(series: DataFrame, keys: list[str], start: Column, time: str = "time") -> DataFrame:
    """Rows from ``start`` to the last full day of their series (P14).  The
    bounds are one row for each series, joined back; a series that holds many rows is
    split by the skew join or needs no shuffle when the bounds are small."""
    bounds = last_full_day(series, keys, time)
    return (series.join(bounds, keys).where(F.col(time).between(start, F.col("last_full"))).drop("last_full"))


def hours_since_start(series: DataFrame, keys: list[str], time: str = "time",
                      out: str = "hours") -> DataFrame:
    """Hours since the first timestamp of each series (P18); the first
    timestamps are a small aggregate joined back (no per-series window)."""
    first = series.groupBy(*keys).agg(F.min(time).alias("_t0"))
    return (series.join(first, keys)
            .withColumn(out, F.timestamp_diff("HOUR", F.col("_t0"), F.col(time))).drop("_t0"))


def full_day_of_month(t: Column) -> Column:
    """Day of month if hour = 23 else day - 1 (P19; can be 0)."""
    return (F.dayofmonth(t) - F.when(F.hour(t) < 23, 1).otherwise(0)).cast("int")
