"""Calendar column expressions.

All day arithmetic assumes ``spark.sql.session.timeZone=UTC`` (see
:mod:`geodemand.session`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._cols import ColumnOrName, col

# Meteorological seasons by month (northern hemisphere).
SEASON_MONTHS: dict[str, tuple[int, int, int]] = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "autumn": (9, 10, 11),
}

_EPOCH = dt.date(1970, 1, 1)


def _as_date(d: dt.date | str) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def epoch_to_day(c: ColumnOrName) -> Column:
    """Epoch seconds -> calendar day (UTC)."""
    return F.to_date(F.timestamp_seconds(col(c)))


def epoch_day_range(c: ColumnOrName, lo: dt.date | str, hi: dt.date | str) -> Column:
    """``lo <= epoch_to_day(c) <= hi`` written on the raw seconds.

    A half-open range on the stored column is what parquet statistics can use
    to skip row groups; a predicate on the derived day is not pushed down.
    """
    lo_s = (_as_date(lo) - _EPOCH).days * 86400
    hi_s = ((_as_date(hi) - _EPOCH).days + 1) * 86400
    return (col(c) >= F.lit(lo_s)) & (col(c) < F.lit(hi_s))


def between_dates(c: ColumnOrName, lo: dt.date | str, hi: dt.date | str) -> Column:
    """Inclusive day range on a date column."""
    return col(c).between(F.lit(_as_date(lo)), F.lit(_as_date(hi)))


def remap_month(c: ColumnOrName, year: int, month: int, overflow: str = "error") -> Column:
    """Re-date to ``year-month`` keeping the day of month.

    ``overflow="error"`` raises (ANSI) when the day does not exist in the target
    month; ``"clamp"`` moves it to the month's last day.
    """
    day = F.dayofmonth(col(c))
    if overflow == "error":
        return F.make_date(F.lit(year), F.lit(month), day)
    if overflow == "clamp":
        last = F.dayofmonth(F.last_day(F.make_date(F.lit(year), F.lit(month), F.lit(1))))
        return F.make_date(F.lit(year), F.lit(month), F.least(day, last))
    raise ValueError(f"overflow must be 'error' or 'clamp', got {overflow!r}")


def weekday(c: ColumnOrName) -> Column:
    """Day of week, Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(col(c))


def is_weekend(c: ColumnOrName) -> Column:
    """1 on Saturday and Sunday, else 0 (integer flag)."""
    return F.when(F.dayofweek(col(c)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def season(c: ColumnOrName) -> Column:
    """Meteorological season name of a date's month."""
    m = F.month(col(c))
    expr = None
    for name, months in SEASON_MONTHS.items():
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def horizon(anchor: ColumnOrName, n_days: int) -> Column:
    """Array of ``n_days`` consecutive days starting at ``anchor``.

    Explode it to get one row per day; applied per row of a small key table
    this builds a key x day scaffold without a join.
    """
    if n_days < 1:
        raise ValueError("n_days must be >= 1")
    a = col(anchor)
    return F.sequence(a, F.date_add(a, n_days - 1), F.expr("INTERVAL 1 DAY"))
