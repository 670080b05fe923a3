"""Grain, null, span and coverage checks.

Each check is one aggregation pass returning a small DataFrame; nothing is
collected here. Duplicate-key checks should come back empty.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.logic import flag_sum


def duplicate_keys(df: DataFrame, keys: Sequence[str | Column], count_name: str = "cnt") -> DataFrame:
    """Keys with more than one row, and how many (empty when the grain holds)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def duplicate_surplus(df: DataFrame, key: str, name: str = "duplicate_rows") -> DataFrame:
    """Rows minus distinct keys (0 when the grain holds)."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.col(key))).alias(name))


def null_profile(df: DataFrame, cols: Sequence[str], prefix: str = "null_") -> DataFrame:
    """One row: count of nulls per column (null on empty input, like SUM)."""
    return df.agg(*[flag_sum(F.col(c).isNull()).alias(f"{prefix}{c}") for c in cols])


def _key_set(df: DataFrame, on: Sequence[str], marker: str) -> DataFrame:
    return df.select(*on).distinct().withColumn(marker, F.lit(True))


def coverage_left(
    facts: DataFrame,
    ref: DataFrame,
    on: Sequence[str],
    total_name: str = "fact_rows",
    missing_name: str = "fact_rows_without_match",
) -> DataFrame:
    """Fact rows, and fact rows whose key has no match in ``ref``.

    Facts are first counted per key (partially aggregated, so a hot key is
    one row before the join) and ``ref`` is reduced to its distinct keys, so a
    repeated key in the reference can not inflate the counts.
    """
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    r = _key_set(ref, on, "_matched")
    j = counts.join(r, list(on), "left")
    return j.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias(total_name),
        F.sum(F.when(F.col("_matched").isNull(), F.col("_n")).otherwise(F.lit(0))).alias(missing_name),
    )


def coverage_full(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_missing: str = "left_keys_missing_right",
    right_missing: str = "right_keys_missing_left",
    union_name: str = "total_distinct_keys_union",
) -> DataFrame:
    """Distinct keys on each side, full outer joined: keys missing on either
    side and the size of the union."""
    lk = _key_set(left, on, "_in_left")
    rk = _key_set(right, on, "_in_right")
    j = lk.join(rk, list(on), "full_outer")
    return j.agg(
        flag_sum(F.col("_in_right").isNull()).alias(left_missing),
        flag_sum(F.col("_in_left").isNull()).alias(right_missing),
        F.count(F.lit(1)).alias(union_name),
    )


def row_counts(frames: Mapping[str, DataFrame], name_col: str = "table", count_col: str = "rows") -> DataFrame:
    """One row per input: its name and row count."""
    if not frames:
        raise ValueError("row_counts needs at least one input")
    parts = [
        df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(n).alias(name_col), count_col)
        for n, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def column_profile(
    df: DataFrame,
    cols: Sequence[str],
    patterns: Mapping[str, tuple[str, str]] | None = None,
    unique_keys: Sequence[str] = (),
) -> DataFrame:
    """One aggregation pass: rows, null-or-blank count, min and max per column
    (in the column's own order, shown as text), count of values matching a regex per named pattern, and
    distinct count per key column."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for c in cols:
        v = F.col(c).cast("string")
        aggs += [
            F.count_if(v.isNull() | (F.trim(v) == "")).alias(f"{c}_null_or_blank"),
            F.min(F.col(c)).cast("string").alias(f"{c}_min"),
            F.max(F.col(c)).cast("string").alias(f"{c}_max"),
        ]
    for name, (c, rx) in (patterns or {}).items():
        aggs.append(F.count_if(F.col(c).cast("string").rlike(rx)).alias(name))
    for k in unique_keys:
        aggs.append(F.count_distinct(F.col(k)).alias(f"{k}_distinct"))
    return df.agg(*aggs)
