"""Conditional helpers: flag counts, clipping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._cols import ColumnOrName, col


def flag(cond: Column) -> Column:
    """Boolean condition -> integer 0/1 (null condition -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def flag_sum(cond: Column) -> Column:
    """Count of rows where ``cond`` holds (null on empty input, like SUM)."""
    return F.sum(flag(cond))


def clip(c: ColumnOrName, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to ``[lo, hi]``; either bound may be omitted."""
    out = col(c)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out
