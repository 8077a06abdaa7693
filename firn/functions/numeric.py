"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results are snapped to multiples of 2^-20 (about 1e-6).  Scaling by a
# power of two is exact, so two engines that sum in different orders agree
# after snapping unless a value lies within a few ulps of a grid midpoint,
# which decimal-derived data practically never does (decimal rounding, by
# contrast, hits exact ties such as x.xxxxxx5 all the time).
GRID_BITS = 20


def rnd(c, bits: int = GRID_BITS) -> Column:
    """Snap a double to the 2^-bits grid (half away from zero)."""
    c = F.col(c) if isinstance(c, str) else c
    s = float(2 ** bits)
    return F.round(c * F.lit(s)) / F.lit(s)


def rnd_sql(expr: str, bits: int = GRID_BITS) -> str:
    s = float(2 ** bits)
    return f"(round(({expr}) * {s!r}) / {s!r})"
