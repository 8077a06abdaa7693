"""Series quality queries on the S1 forcing stand-in (and S2 for steps)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firn.functions.timecols import ntz
from firn.operators import quality as Q
from firn.plans.registry import register
from firn.sources import standins as S
from firn.sources.tables import Tables

# Query parameters.
SERIES = ["source", "lat_i", "lon_i"]
CELL = ["lat_i", "lon_i"]
LATEST_AVAILABLE = "2024-01-24"
BACKFILL_AS_OF = "2024-02-02"
RECENT_AS_OF = "2024-01-25 10:30:00"
SIM_AS_OF = "2024-01-25"
ARCHIVE_START = "2024-01-03"
# The two reanalysis file classes (even lon_i -> PLEV, odd -> SURF).
FILE_CLASSES = ("PLEV", "SURF")


def s1d(t: Tables):
    return S.s1(t).withColumn("date", F.to_date("time"))


def reanalysis_classes(t: Tables):
    r = S.s1(t).where(F.col("source") == "reanalysis")
    return r.select(F.when(F.col("lon_i") % 2 == 0, "PLEV").otherwise("SURF").alias("file_class"),
                    F.to_date("time").alias("date")).distinct()


def q(body: str, *names: str) -> str:
    return S.with_ctes(body, *(names or ("s1",)))


@register("g01_hour_range", q("""
SELECT source, unnest(generate_series(min(time), max(time), INTERVAL 1 HOUR)) AS time
FROM s1 GROUP BY source"""))
def g01_hour_range(t: Tables):
    """Every hour between the first and last time of each source."""
    b = Q.series_bounds(S.s1(t), ["source"])
    return Q.hour_range(b).select("source", "time")


_EXPECTED = """
b AS (SELECT source, lat_i, lon_i, min(time) AS s, max(time) AS e FROM s1 GROUP BY ALL),
x AS (SELECT source, lat_i, lon_i, unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS time FROM b)"""


@register("j07_missing_hours", S.with_ctes("""
SELECT source, lat_i, lon_i, time FROM x
EXCEPT SELECT source, lat_i, lon_i, time FROM s1""", "s1", extra=_EXPECTED))
def j07_missing_hours(t: Tables):
    """Hours missing inside each (source, cell) series."""
    return Q.missing_hours(S.s1(t), SERIES)


@register("j07_duplicate_hours", q("""
SELECT lat_i, lon_i, time, count(*) - 1 AS n_extra FROM s1 GROUP BY ALL HAVING count(*) > 1"""))
def j07_duplicate_hours(t: Tables):
    """Extra occurrences per (cell, time) after concatenating all sources."""
    return Q.duplicate_hours(S.s1(t), CELL)


@register("u03_expected_minus_actual", S.with_ctes("""
SELECT source, time FROM (SELECT source, unnest(generate_series(min(time), max(time), INTERVAL 1 HOUR)) AS time
                          FROM s1 GROUP BY source)
EXCEPT ALL SELECT DISTINCT source, time FROM s1""", "s1"))
def u03_expected_minus_actual(t: Tables):
    """Expected hours of each source minus the hours it has (EXCEPT ALL)."""
    s = S.s1(t)
    exp = Q.hour_range(Q.series_bounds(s, ["source"])).select("source", "time")
    return exp.exceptAll(s.select("source", "time").distinct())


_COV = """
SELECT lat_i, lon_i, min(time) AS first, max(time) AS last, {n} AS n_rows,
       date_diff('hour', min(time), max(time)) + 1 AS expected,
       date_diff('hour', min(time), max(time)) + 1 - {n} AS missing
FROM s1 GROUP BY lat_i, lon_i"""


@register("a04_coverage", q(_COV.format(n="count(*)")))
def a04_coverage(t: Tables):
    """Coverage of the concatenated sources per cell; duplicates mask gaps."""
    return Q.coverage(S.s1(t), CELL)


@register("a04_coverage_distinct", q(_COV.format(n="count(DISTINCT time)")))
def a04_coverage_distinct(t: Tables):
    """Coverage counting distinct hours (the corrected variant)."""
    return Q.coverage(S.s1(t), CELL, distinct_hours=True)


@register("a05_last_full_day", q("""
SELECT source, max(time) FILTER (WHERE hour(time) = 23) AS last_full FROM s1 GROUP BY source"""))
def a05_last_full_day(t: Tables):
    """Last timestamp at 23:00 per source."""
    return Q.last_full_day(S.s1(t), ["source"])


@register("a08_last_date", q("""
SELECT source, max(CAST(time AS DATE)) AS last_date, count(DISTINCT CAST(time AS DATE)) AS n_dates
FROM s1 GROUP BY source"""))
def a08_last_date(t: Tables):
    """Last available date and number of dates per source."""
    return (s1d(t).groupBy("source")
            .agg(F.max("date").alias("last_date"), F.count_distinct("date").alias("n_dates")))


@register("a08_existing_dates", q("SELECT DISTINCT source, CAST(time AS DATE) AS date FROM s1"))
def a08_existing_dates(t: Tables):
    """Set of existing (source, date)."""
    return s1d(t).select("source", "date").distinct()


@register("a09_last_time", q("SELECT source, lat_i, lon_i, max(time) AS last_time FROM s1 GROUP BY ALL"))
def a09_last_time(t: Tables):
    """Last timestamp of each series."""
    return S.s1(t).groupBy(*SERIES).agg(F.max("time").alias("last_time"))


@register("a10_days_first_seen", q("""
SELECT source, date, first_time, row_number() OVER (PARTITION BY source ORDER BY first_time) AS rank
FROM (SELECT source, CAST(time AS DATE) AS date, min(time) AS first_time FROM s1 GROUP BY 1, 2)"""))
def a10_days_first_seen(t: Tables):
    """Distinct days of each source in the order of their first timestamp (``rank``)."""
    days = s1d(t).groupBy("source", "date").agg(F.min("time").alias("first_time"))
    by_time = Window.partitionBy("source").orderBy("first_time")  # one row a day
    return days.withColumn("rank", F.row_number().over(by_time).cast("bigint"))


_MONTHS = """
f AS (SELECT DISTINCT source, CAST(date_trunc('month', time) AS DATE) AS month, time FROM s1),
m AS (SELECT DISTINCT source, month FROM f),
x AS (SELECT source, month, unnest(generate_series(CAST(month AS TIMESTAMP),
                                                   CAST(last_day(month) AS TIMESTAMP) + INTERVAL 23 HOUR,
                                                   INTERVAL 1 HOUR)) AS time FROM m),
mi AS (SELECT source, month, count(*) AS n_missing
       FROM (SELECT * FROM x EXCEPT SELECT source, month, time FROM f) GROUP BY 1, 2),
pr AS (SELECT source, month, count(*) AS n_present FROM f GROUP BY 1, 2)"""


@register("j08_month_completeness", S.with_ctes("""
SELECT pr.source, pr.month, n_present, coalesce(n_missing, 0) AS n_missing, coalesce(n_missing, 0) = 0 AS complete
FROM pr LEFT JOIN mi USING (source, month)""", "s1", extra=_MONTHS))
def j08_month_completeness(t: Tables):
    """Hourly completeness of each monthly file (source, month)."""
    return Q.month_completeness(S.s1(t), ["source"])


@register("a12_missing_steps", S.with_ctes("""
SELECT source, month, n_missing FROM mi WHERE n_missing > 0""", "s1", extra=_MONTHS))
def a12_missing_steps(t: Tables):
    """Missing-step count of each incomplete monthly file."""
    return (Q.month_completeness(S.s1(t), ["source"]).where(~F.col("complete"))
            .select("source", "month", "n_missing"))


_CLASSES = """
c AS (SELECT DISTINCT CASE WHEN lon_i % 2 = 0 THEN 'PLEV' ELSE 'SURF' END AS file_class, CAST(time AS DATE) AS date
      FROM s1 WHERE source = 'reanalysis')"""


@register("j06_missing_days", S.with_ctes(f"""
SELECT CAST(unnest(generate_series(coalesce((SELECT min(date) FROM c WHERE file_class = 'PLEV'), DATE '{LATEST_AVAILABLE}'),
                                   DATE '{LATEST_AVAILABLE}', INTERVAL 1 DAY)) AS DATE) AS date
EXCEPT SELECT date FROM c GROUP BY date HAVING count(DISTINCT file_class) = 2""", "s1", extra=_CLASSES))
def j06_missing_days(t: Tables):
    """Days lacking either reanalysis file class up to the latest available day."""
    return Q.missing_days(reanalysis_classes(t), FILE_CLASSES, "PLEV", LATEST_AVAILABLE)


@register("j09_backfill_candidates", q(f"""
SELECT date, CAST(-date_diff('day', date, DATE '{BACKFILL_AS_OF}') AS INTEGER) AS offset
FROM (SELECT CAST(unnest(generate_series((SELECT max(CAST(time AS DATE)) FROM s1 WHERE source = 'reanalysis') + 1,
                                         DATE '{BACKFILL_AS_OF}' - 1, INTERVAL 1 DAY)) AS DATE) AS date)
WHERE date NOT IN (SELECT CAST(time AS DATE) FROM s1 WHERE source = 'daily_fc')
  AND date_diff('day', date, DATE '{BACKFILL_AS_OF}') <= 3"""))
def j09_backfill_candidates(t: Tables):
    """Days after the last reanalysis day with no hindcast, at most 3 days old."""
    d = s1d(t)
    last = d.where(F.col("source") == "reanalysis").agg(F.max("date")).scalar()
    hind = d.where(F.col("source") == "daily_fc").select("date").distinct()
    return Q.backfill_candidates(last, hind, BACKFILL_AS_OF)


@register("j10_supersede", q("""
SELECT source, lat_i, lon_i, time, value, CAST(time AS DATE) AS date,
       CASE WHEN CAST(time AS DATE) IN (SELECT CAST(time AS DATE) FROM s1 WHERE source = 'reanalysis')
            THEN 'archive' ELSE 'live' END AS state
FROM s1 WHERE source = 'daily_fc'"""))
def j10_supersede(t: Tables):
    """Hindcast rows tagged archive (day has reanalysis) or live."""
    d = s1d(t).select("source", "lat_i", "lon_i", "time", "value", "date")
    return Q.supersede(d.where(F.col("source") == "daily_fc"),
                       d.where(F.col("source") == "reanalysis"))


@register("p11_recent_days", q(f"""
SELECT DISTINCT source, CAST(time AS DATE) AS date FROM s1
WHERE CAST(CAST(time AS DATE) AS TIMESTAMP) >= TIMESTAMP '{RECENT_AS_OF}' - INTERVAL 9 DAY"""))
def p11_recent_days(t: Tables):
    """File days within 9 days of a mid-day as_of (boundary day drops out)."""
    return Q.recent_days(s1d(t).select("source", "date").distinct(), RECENT_AS_OF)


@register("p12_trim_forecast", q("""
SELECT source, lat_i, lon_i, time, value FROM s1
WHERE source = 'cont_fc' AND time >= (SELECT max(time) FROM s1 WHERE source = 'reanalysis') + INTERVAL 1 HOUR"""))
def p12_trim_forecast(t: Tables):
    """Continuous forecast from one hour after the last reanalysis time."""
    s = S.s1(t).select("source", "lat_i", "lon_i", "time", "value")
    last = s.where(F.col("source") == "reanalysis").agg(F.max("time")).scalar()
    return Q.trim_after(s.where(F.col("source") == "cont_fc"), last)


@register("p13_trim_day", q("""
SELECT source, lat_i, lon_i, time, value FROM s1
WHERE source = 'daily_fc'
  AND time >= CAST(CAST((SELECT max(time) FROM s1 WHERE source = 'reanalysis') + INTERVAL 1 HOUR AS DATE) AS TIMESTAMP)"""))
def p13_trim_day(t: Tables):
    """Hindcast trimmed at the day boundary of last reanalysis + 1h (as coded)."""
    s = S.s1(t).select("source", "lat_i", "lon_i", "time", "value")
    last = s.where(F.col("source") == "reanalysis").agg(F.max("time")).scalar()
    return Q.trim_after(s.where(F.col("source") == "daily_fc"), last, day_boundary=True)


_P14 = """
SELECT s1.source, lat_i, lon_i, time, value FROM s1
JOIN (SELECT source, max(time) FILTER (WHERE hour(time) = 23) AS last_full FROM s1 GROUP BY source) l USING (source)
WHERE time BETWEEN {start} AND last_full"""


@register("p13_trim_day_corrected", q("""
SELECT source, lat_i, lon_i, time, value FROM s1
WHERE source = 'daily_fc' AND CAST(time AS DATE) > (SELECT CAST(max(time) AS DATE) FROM s1 WHERE source = 'reanalysis')"""))
def p13_trim_day_corrected(t: Tables):
    """Hindcast from the first day that the reanalysis does not touch (corrected: no day from both)."""
    s = S.s1(t).select("source", "lat_i", "lon_i", "time", "value")
    last = s.where(F.col("source") == "reanalysis").agg(F.max("time")).scalar()
    return Q.trim_after(s.where(F.col("source") == "daily_fc"), last, day_boundary="next")


@register("p14_sim_window", q(_P14.format(start=f"TIMESTAMP '{SIM_AS_OF} 00:00:00' - INTERVAL 7 DAY")))
def p14_sim_window(t: Tables):
    """Forecast simulation window: as_of - 7 days .. last full day, per source."""
    s = S.s1(t).select("source", "lat_i", "lon_i", "time", "value")
    return Q.simulation_window(s, ["source"], Q.add_days(ntz(f"{SIM_AS_OF} 00:00:00"), -7))


@register("p14_archive_window", q(_P14.format(start=f"TIMESTAMP '{ARCHIVE_START} 00:00:00'")))
def p14_archive_window(t: Tables):
    """Archive simulation window: a start date .. last full day, per source."""
    s = S.s1(t).select("source", "lat_i", "lon_i", "time", "value")
    return Q.simulation_window(s, ["source"], ntz(f"{ARCHIVE_START} 00:00:00"))


@register("p18_hours_since_start", q("""
SELECT source, lat_i, lon_i, time, date_diff('hour', min(time) OVER (PARTITION BY source, lat_i, lon_i), time) AS hours
FROM s1"""))
def p18_hours_since_start(t: Tables):
    """Time re-encoded as hours since the first timestamp of the series."""
    return Q.hours_since_start(S.s1(t).select(*SERIES, "time"), SERIES)


@register("p19_full_day_dom", q("""
SELECT source, lat_i, lon_i, time, CAST(day(time) - CASE WHEN hour(time) < 23 THEN 1 ELSE 0 END AS INT) AS full_day
FROM s1"""))
def p19_full_day_dom(t: Tables):
    """Full-day day-of-month helper (day if hour = 23 else day - 1)."""
    return S.s1(t).select(*SERIES, "time", Q.full_day_of_month(F.col("time")).alias("full_day"))


@register("g02_day_range", q("""
SELECT source, CAST(unnest(generate_series(CAST(min(time) AS DATE), CAST(max(time) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date
FROM s1 GROUP BY source"""))
def g02_day_range(t: Tables):
    """Every day from the first to the last day of each source, inclusive."""
    return Q.day_range(Q.series_bounds(S.s1(t), ["source"])).select("source", "date")


@register("g03_month_files", q("""
SELECT file_type, month, file_type || '_' || strftime(month, '%Y%m') AS file_name
FROM (SELECT CAST(unnest(generate_series(
             make_date(CAST(year(min(time)) - CASE WHEN month(min(time)) < 9 THEN 1 ELSE 0 END AS INT), 9, 1),
             CAST(date_trunc('month', max(time)) AS DATE), INTERVAL 1 MONTH)) AS DATE) AS month FROM s1) m,
     (SELECT unnest(['SURF', 'PLEV']) AS file_type) ty"""))
def g03_month_files(t: Tables):
    """Monthly file names from September of the first water year to the last month."""
    from firn.functions.timecols import water_year
    s = S.s1(t)
    b = s.agg(F.min("time").alias("t0"), F.max("time").alias("t1")).select(
        F.make_date(water_year(F.col("t0")), F.lit(9), F.lit(1)).alias("start"),
        F.trunc("t1", "month").alias("end"))
    m = b.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    m = m.select("month", F.explode(F.array(F.lit("SURF"), F.lit("PLEV"))).alias("file_type"))
    return m.select("file_type", "month",
                    F.concat_ws("_", "file_type", F.date_format("month", "yyyyMM")).alias("file_name"))


@register("g04_missing_steps", S.with_ctes("""
SELECT r.run_date, r.cell, st.step
FROM (SELECT DISTINCT run_date, cell FROM s2) r,
     (SELECT CAST(unnest(generate_series(0, 12, 3)) AS INTEGER) AS step
      UNION ALL SELECT CAST(unnest(generate_series(18, 18, 6)) AS INTEGER)) st
EXCEPT SELECT run_date, cell, step FROM s2""", "s2"))
def g04_missing_steps(t: Tables):
    """Knots of the irregular step list (3 h to 12, then 6 h) absent from each run."""
    runs = S.s2(t).select("run_date", "cell").distinct()
    exp = runs.select("run_date", "cell", F.explode(Q.step_list(12, 3, 6, 18)).alias("step"))
    return exp.join(S.s2(t).select("run_date", "cell", "step"), ["run_date", "cell", "step"], "left_anti")
