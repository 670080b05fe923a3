"""Report views over a forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import place_label

# Context measures a report can show next to the prediction,
# by display label.
CONTEXT_MEASURES: dict[str, str | None] = {
    "None": None,
    "Temp avg": "temp_avg",
    "Temp max": "temp_max",
    "Temp min": "temp_min",
    "Precip total": "precip_total",
    "Rain": "rain",
    "Snow": "snow",
    "Cloud cover": "cloud_cover",
    "Humidity": "humidity",
    "Wind speed": "wind_speed",
    "UV": "uv",
}


def join_suffixed(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str = "_weather", how: str = "left"
) -> DataFrame:
    """Join keeping every left column name; clashing right columns get ``suffix``."""
    on = list(on)
    clash = set(left.columns) - set(on)
    r = right.select(*on, *[F.col(c).alias(c + suffix if c in clash else c) for c in right.columns if c not in on])
    return left.join(r, on, how)


def place_options(df: DataFrame, city: str = "city", state: str = "state", label: str = "label") -> DataFrame:
    """Distinct places ordered by state then city, with a "City, ST" label."""
    return (
        df.select(city, state)
        .distinct()
        .withColumn(label, place_label(city, state))
        .orderBy(state, city)
    )


def place_report(
    df: DataFrame,
    city: str,
    state: str,
    cols: Sequence[str],
    context: str | None = None,
    date: str = "date",
) -> DataFrame:
    """One place's rows in day order: ``date``, ``cols`` and optionally one
    context measure chosen by its label in :data:`CONTEXT_MEASURES` (or by
    column name)."""
    extra = []
    if context is not None:
        c = CONTEXT_MEASURES.get(context, context)
        if c is not None and c not in cols:
            extra.append(c)
    return (
        df.where((F.col("city") == city) & (F.col("state") == state))
        .select(date, *cols, *extra)
        .orderBy(date)
    )
