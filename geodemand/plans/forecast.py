"""Weekday-profile proxy forecast.

For each place and each day of an N-day horizon: the place's mean for that
weekday, falling back *per measure* to the place's overall mean, with the
number of history rows behind the weekday mean and the history span.

One partial aggregate per (key, weekday) keeps sums, non-null counts, row
counts and day bounds; a second aggregate rolls those seven rows per key up to
one, with the weekdays as a map, so the fact is scanned and shuffled once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import horizon
from ..operators.measures import MeasureSpec


def horizon_days(spark, anchor: dt.date | str, n_days: int, date_name: str = "date") -> DataFrame:
    """``n_days`` rows, one per day from ``anchor`` (H8). Pass the anchor
    explicitly: results must not depend on the day the job runs."""
    a = anchor if isinstance(anchor, dt.date) else dt.date.fromisoformat(anchor)
    return spark.range(1).select(F.explode(horizon(F.lit(a), n_days)).alias(date_name))


def scaffold(
    places: DataFrame, anchor: dt.date | str | Column, n_days: int, date_name: str = "date"
) -> DataFrame:
    """Every place row once per horizon day: an explode per row, no join."""
    a = anchor if isinstance(anchor, Column) else F.lit(
        anchor if isinstance(anchor, dt.date) else dt.date.fromisoformat(anchor)
    )
    return places.withColumn(date_name, F.explode(horizon(a, n_days)))


def dow_profile_forecast(
    history: DataFrame,
    places: DataFrame,
    keys: Sequence[str],
    measures: MeasureSpec,
    anchor: dt.date | str | Column,
    n_days: int = 10,
    date_col: str = "day",
    place_cols: Sequence[str] = (),
    per_key_max: Mapping[str, str] | None = None,
    provenance: Mapping[str, object] | None = None,
    date_name: str = "date",
) -> DataFrame:
    """Horizon rows for the ``places`` that have history.

    ``places`` holds ``keys`` plus ``place_cols`` (one row per place); the
    planner broadcasts it if it turns out small. Places without any history
    drop out (inner joins).
    ``per_key_max`` maps output names to history columns taken as ``max`` per
    key (e.g. coordinates).
    """
    keys = list(keys)
    per_key_max = dict(per_key_max or {})
    p = places.select(*keys, *[c for c in place_cols if c not in keys])
    h = history.join(p.select(*keys).distinct(), keys)
    dow = F.dayofweek(F.col(date_col))
    aggs = [
        F.count(F.lit(1)).alias("_n"),
        F.min(date_col).alias("_min"),
        F.max(date_col).alias("_max"),
        *[F.max(F.col(src)).alias(f"_x_{out}") for out, src in per_key_max.items()],
    ]
    for n, m in measures.items():
        v = m.value(n)
        aggs += [F.sum(v).alias(f"_s_{n}"), F.count(v).alias(f"_c_{n}")]
    partial = h.groupBy(*keys, dow.alias("_dow")).agg(*aggs)

    # One row per key: its totals, and its at most seven weekdays as a map.
    week = F.struct(F.col("_n").alias("n"), *[F.col(f"_{k}_{n}").alias(f"{k}_{n}") for n in measures for k in "sc"])
    by_key = partial.groupBy(*keys).agg(
        F.sum("_n").alias("proxy_source_rows_total"),
        F.min("_min").alias("source_data_min_date"),
        F.max("_max").alias("source_data_max_date"),
        F.map_from_entries(F.collect_list(F.struct(F.col("_dow"), week))).alias("_week"),
        *[F.max(f"_x_{out}").alias(out) for out in per_key_max],
        *[F.try_divide(F.sum(f"_s_{n}"), F.sum(f"_c_{n}")).alias(f"_a_{n}") for n in measures],
    )
    days = scaffold(p, anchor, n_days, date_name).withColumn("_dow", F.dayofweek(F.col(date_name)))
    j = days.join(by_key, keys).withColumn("_own", F.try_element_at("_week", F.col("_dow")))
    out = j.select(
        *keys,
        *[c for c in place_cols if c not in keys],
        date_name,
        *list(per_key_max),
        *[
            m.finish(F.coalesce(F.try_divide(F.col(f"_own.s_{n}"), F.col(f"_own.c_{n}")), F.col(f"_a_{n}"))).alias(n)
            for n, m in measures.items()
        ],
        F.coalesce(F.col("_own.n"), F.lit(0)).cast("long").alias("proxy_hist_rows_for_dow"),
        "proxy_source_rows_total",
        "source_data_min_date",
        "source_data_max_date",
    )
    if provenance:
        out = out.withColumns({k: F.lit(v) for k, v in provenance.items()})
    return out
