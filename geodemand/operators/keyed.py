"""Per-key picks and repairs.

Every "pick one row per key" here is an aggregate of a struct, not a window
sort: ``max(struct(...))`` is partially aggregated on the map side, so a key
holding a third of all rows is reduced before the shuffle instead of being
sorted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._cols import as_list, col

_PICK = "_pick"


def open_version(valid_to: str = "valid_to") -> Column:
    """1 when a version is open-ended (``valid_to`` null or blank), else 0."""
    v = F.col(valid_to)
    return F.when(v.isNull() | (F.trim(v) == ""), F.lit(1)).otherwise(F.lit(0))


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], by: Sequence[Column | str]
) -> DataFrame:
    """One row per ``key``: the row with the greatest ``by`` tuple.

    ``by`` is compared left to right (nulls lowest); ties are broken by the
    greatest remaining columns, so the result is deterministic. Columns are
    returned in the input order.
    """
    keys = as_list(key)
    rest = [c for c in df.columns if c not in keys]
    order = [col(c).alias(f"_o{i}") for i, c in enumerate(by)]
    picked = df.groupBy(*keys).agg(
        F.max(F.struct(*order, *[F.col(c) for c in rest])).alias(_PICK)
    )
    return picked.select(*keys, *[F.col(f"{_PICK}.{c}").alias(c) for c in rest]).select(
        *df.columns
    )


def latest_version(
    df: DataFrame, key: str = "customer_id", valid_from: str = "valid_from", valid_to: str = "valid_to"
) -> DataFrame:
    """Latest version per key: open-ended rows first, then greatest ``valid_from``."""
    return latest_per_key(df, key, [open_version(valid_to), F.col(valid_from)])


def mode_reference(
    df: DataFrame, key: str, cols: Sequence[str], count_name: str = "n"
) -> DataFrame:
    """Most frequent combination of ``cols`` per ``key``; ties go to the
    alphabetically first combination. Rows with a null key or any null value
    in ``cols`` do not vote.

    Two partial aggregations: count per (key, combination), then
    ``min(struct(-count, combination))`` per key.
    """
    cols = list(cols)
    voters = df.where(F.col(key).isNotNull())
    for c in cols:
        voters = voters.where(F.col(c).isNotNull())
    counts = voters.groupBy(key, *cols).agg(F.count(F.lit(1)).alias(count_name))
    best = counts.groupBy(key).agg(
        F.min(F.struct((-F.col(count_name)).alias("_neg"), *[F.col(c) for c in cols], F.col(count_name))).alias(
            _PICK
        )
    )
    return best.select(key, *[F.col(f"{_PICK}.{c}").alias(c) for c in cols], F.col(f"{_PICK}.{count_name}").alias(count_name))


def fill_from_reference(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    cols: Mapping[str, str],
    resolved: Mapping[str, str] | None = None,
    flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Fill only the missing attributes of ``df`` from ``ref`` by ``key``.

    ``cols`` maps each attribute of ``df`` to its column in ``ref``. Each
    attribute is filled independently (a row may end with a pair its key never
    had). Adds ``resolved[c]`` (default ``resolved_<c>``) and a boolean
    ``flags[c]`` (default ``<c>_repaired``) that is true when the value came
    from the reference.
    """
    resolved = dict(resolved or {})
    flags = dict(flags or {})
    r = ref.select(F.col(key).alias("_ref_key"), *[F.col(rc).alias(f"_ref_{c}") for c, rc in cols.items()])
    j = df.join(r, F.col(key) == F.col("_ref_key"), "left")
    out = {}
    for c in cols:
        mine, theirs = F.col(c), F.col(f"_ref_{c}")
        out[resolved.get(c, f"resolved_{c}")] = F.coalesce(mine, theirs)
        out[flags.get(c, f"{c}_repaired")] = mine.isNull() & theirs.isNotNull()
    return j.withColumns(out).drop("_ref_key", *[f"_ref_{c}" for c in cols])


def enforce_grain(
    df: DataFrame, keys: Sequence[Column | str], aggs: Mapping[str, Column]
) -> DataFrame:
    """Re-aggregate to one row per ``keys`` (e.g. sum for sales, mean for
    weather), guaranteeing the grain whatever the input holds."""
    return df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggs.items()])
