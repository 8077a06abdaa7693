"""Zone-free time expressions on TIMESTAMP_NTZ / DATE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(text: str) -> Column:
    """TIMESTAMP_NTZ literal (comparisons with it push down to parquet)."""
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def date_lit(text: str) -> Column:
    return F.expr(f"DATE '{text}'")


def trunc_hour(c: Column) -> Column:
    """Floor to the hour without a detour through the session time zone."""
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))


def day_start(c: Column) -> Column:
    """Midnight of the day of ``c`` as TIMESTAMP_NTZ."""
    return F.to_date(c).cast("timestamp_ntz")


def add_hours(c: Column, n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return c + F.make_dt_interval(F.lit(0), n)


def add_days(c: Column, n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return c + F.make_dt_interval(n)


def water_year(d: Column, start_month: int = 9) -> Column:
    """Hydrological year: the calendar year when month >= start_month,
    else the year before (P09)."""
    return (F.year(d) - F.when(F.month(d) < start_month, 1).otherwise(0)).cast("int")


def water_year_bounds(year: int, start_month: int = 9) -> tuple[str, str]:
    """Inclusive first and last day of a water year (P10)."""
    import datetime as _dt
    first = _dt.date(year, start_month, 1)
    nxt = _dt.date(year + 1, start_month, 1)
    return first.isoformat(), (nxt - _dt.timedelta(days=1)).isoformat()


def hydro_month(d: Column, start_month: int = 9) -> Column:
    """Month rank inside a water year: start_month first (SO02 key)."""
    return F.when(F.month(d) < start_month, F.month(d) + 12).otherwise(F.month(d)).cast("int")
