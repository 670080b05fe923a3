"""String column expressions: place names, postcodes, "City, ST" labels (H1-H4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._cols import ColumnOrName, col


def norm_text(c: ColumnOrName, case: str | None = "lower") -> Column:
    """Trim, blank -> null, then lower/upper case (``case=None`` keeps case)."""
    out = F.nullif(F.trim(col(c)), F.lit(""))
    if case == "lower":
        return F.lower(out)
    if case == "upper":
        return F.upper(out)
    if case is None:
        return out
    raise ValueError(f"case must be 'lower', 'upper' or None, got {case!r}")


def norm_key(c: ColumnOrName) -> Column:
    """Join key form of a place attribute: ``upper(trim(c))``."""
    return F.upper(F.trim(col(c)))


def title_place(c: ColumnOrName) -> Column:
    """Display form: every space-separated word capitalised, the rest lower."""
    return F.initcap(F.lower(col(c)))


def strip_decimal_suffix(c: ColumnOrName) -> Column:
    """Trim, then drop exactly one trailing ``.0`` (``90012.0`` -> ``90012``)."""
    return F.regexp_replace(F.trim(col(c)), r"\.0$", "")


def clean_postcode(c: ColumnOrName) -> Column:
    """Five-digit ZIP from a raw postcode, or null.

    After :func:`strip_decimal_suffix`: exactly four digits are left-padded to
    five (a ZIP that lost its leading zero); otherwise the first run of five
    digits is taken; otherwise null.
    """
    stripped = strip_decimal_suffix(c)
    four = F.regexp_extract(stripped, r"^(\d{4})$", 1)
    five = F.nullif(F.regexp_extract(stripped, r"(\d{5})", 1), F.lit(""))
    return F.when(four != "", F.lpad(four, 5, "0")).otherwise(five)


def place_label(city: ColumnOrName, state: ColumnOrName) -> Column:
    """``"City, ST"``."""
    return F.concat_ws(", ", col(city), col(state))


def split_label(label: ColumnOrName) -> tuple[Column, Column]:
    """Inverse of :func:`place_label`: trimmed (city, state)."""
    parts = F.split(col(label), ",", 2)
    return F.trim(parts.getItem(0)), F.trim(parts.getItem(1))
