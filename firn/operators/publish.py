"""Publishing: allow-list check, skip of published partitions, rolling
and open-ended bundles, publish paths (P08, J16, J17, J18, IO10, SO03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.functions.names import PUBLISH_PARAMETERS, publish_path
from firn.functions.timecols import date_lit


def allow_list_violations(df: DataFrame, param: str = "parameter",
                          allowed=PUBLISH_PARAMETERS) -> DataFrame:
    """Rows whose parameter is not publishable (P08), as a table."""
    return df.where(~F.col(param).isin(*allowed))


def assert_allowed(df: DataFrame, param: str = "parameter", allowed=PUBLISH_PARAMETERS) -> DataFrame:
    """Pass rows through; the job fails on the first unknown parameter."""
    ok = F.col(param).isin(*allowed)
    # a predicate that is true or raises: unlike a dropped helper column,
    # a filter cannot be pruned away by the optimizer
    check = F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("parameter not allowed: "), F.col(param))).cast("boolean"))
    return df.where(check)


def skip_published(candidates: DataFrame, published: DataFrame, keys: list[str],
                   refresh_from: str | None = None, date_col: str = "date") -> DataFrame:
    """Partitions not yet published (J16).  As coded, a published day is
    never refreshed; ``refresh_from`` re-admits days on or after it."""
    pub = published.select(*keys).distinct()
    if refresh_from is not None:
        pub = pub.where(F.col(date_col) < date_lit(refresh_from))
    return candidates.join(pub, keys, "left_anti")


def rolling_bundles(daily: DataFrame, first_start: Column, last_start: Column, n_days: int = 10,
                    date_col: str = "date", bundle_col: str = "bundle_date") -> DataFrame:
    """For every start day in [first_start, last_start] the days start ..
    start+N-1 (J17).  Written as an equi-join: each row lists the (at
    most N) bundle starts it belongs to, so no interval join is planned;
    empty bundles simply do not appear."""
    d = F.col(date_col)
    lo = F.greatest(F.date_sub(d, n_days - 1), first_start)
    hi = F.least(d, last_start)
    return (daily.where(lo <= hi)
            .withColumn(bundle_col, F.explode(F.sequence(lo, hi))))


def open_bundle(files: DataFrame, start: str, param: str, class_col: str = "parameter",
                date_col: str = "date", prefix_match: bool = False) -> DataFrame:
    """All days on or after ``start`` of one parameter (J18).  The class
    match is exact; ``prefix_match=True`` reproduces the name-prefix
    behaviour where ``HS`` also catches ``HS24``."""
    cls = F.col(class_col).startswith(param) if prefix_match else (F.col(class_col) == param)
    return files.where(cls & (F.col(date_col) >= date_lit(start)))


def with_publish_path(df: DataFrame, model: str, param: str = "parameter", date_col: str = "date",
                      forecast: Column | bool = False, out: str = "path") -> DataFrame:
    """Adds the publish layout path (IO10)."""
    return df.withColumn(out, publish_path(model, F.col(param), F.col(date_col), forecast))
