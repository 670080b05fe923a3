"""Small shared helpers for column arguments."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    if isinstance(x, str):
        return [x]
    return list(x)


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "input") -> None:
    """Raise ``ValueError`` naming every missing column, sorted."""
    missing = sorted(set(cols).difference(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: " + ", ".join(missing))
