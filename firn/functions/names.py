"""File-name and product-name expressions (dates in names, sort keys,
publish paths)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The name patterns that carry a date, and their formats.
DATE_PATTERNS = (
    (r"_(\d{8})\.", "yyyyMMdd"),        # SWE_20240105.nc
    (r"_FC_(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"),  # PLEV_FC_2024-01-05.nc
    (r"_(\d{6})(?:\D|$)", "yyyyMM"),    # SURF_202401.nc
)

# Publishable parameters.
PUBLISH_PARAMETERS = ("HS", "SWE", "ROF", "HS24")


def date_from_name(name: Column) -> Column:
    """First pattern that both matches and parses; NULL for bad names (IO02)."""
    out = None
    for pat, fmt in DATE_PATTERNS:
        text = F.regexp_extract(name, pat, 1)
        # parse only what matched: a failed parse is costly, an empty match is not
        d = F.when(text != "", F.to_date(F.try_to_timestamp(text, F.lit(fmt))))
        out = d if out is None else F.coalesce(out, d)
    return out


def natural_key(name: Column) -> Column:
    """Sortable array: a digit run as the length of its digits without leading zeros,
    itself prefixed by how many digits that length has, then those digits; text case-folded (SO01)."""
    def number(p: Column) -> Column:
        digits = F.regexp_replace(p, r"^0+(?=.)", "")
        size = F.length(digits).cast("string")
        return F.concat(F.length(size).cast("string"), size, F.lit(":"), digits)
    parts = F.regexp_extract_all(name, F.lit(r"([0-9]+|[^0-9]+)"), 1)
    return F.transform(parts, lambda p: F.when(p.rlike(r"^[0-9]+$"), number(p)).otherwise(F.lower(p)))


def cluster_from_name(name: Column) -> Column:
    """Point id from names like FSM_pt_12.txt."""
    return F.regexp_extract(name, r"_(\d+)", 1).cast("bigint")


def publish_path(model: str, param: Column, d: Column, forecast: Column | bool = False) -> Column:
    """{model}/[forecast/]{param}/{YYYY}/{YYYYMM}/{param}_{YYYYMMDD} (IO10)."""
    fc = forecast if isinstance(forecast, Column) else F.lit(forecast)
    return F.concat(F.lit(model + "/"), F.when(fc, F.lit("forecast/")).otherwise(F.lit("")),
                    param, F.lit("/"), F.date_format(d, "yyyy"), F.lit("/"),
                    F.date_format(d, "yyyyMM"), F.lit("/"), param, F.lit("_"),
                    F.date_format(d, "yyyyMMdd"))
