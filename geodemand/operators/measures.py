"""Measure lists and their aggregates.

A :class:`Measure` names a source column, its type, a scale applied after
averaging (fraction -> percent) and an optional rounding. One spec maps
different sources onto one vocabulary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._cols import col


@dataclass(frozen=True)
class Measure:
    src: str | None = None  # source column; defaults to the output name
    type: str = "double"
    scale: float = 1.0  # multiplier applied to the aggregate
    digits: int | None = None  # round the aggregate to this many places
    valid_min: float | None = None  # values below are a missing-value code -> null

    def source(self, name: str) -> str:
        return self.src or name

    def value(self, name: str) -> Column:
        """The typed source value (before aggregation)."""
        v = F.col(self.source(name)).cast(self.type)
        if self.valid_min is not None:
            v = F.when(v >= F.lit(self.valid_min), v)
        return v

    def finish(self, agg: Column) -> Column:
        """Scale then round an aggregate; the result is always a double.

        With a decimal ``type`` the sum behind an average is exact, so the
        result does not depend on the order rows were added in.
        """
        out = agg * F.lit(self.scale) if self.scale != 1.0 else agg
        if self.digits is not None:
            out = F.round(out, self.digits)
        return out if self.type == "double" else out.cast("double")


MeasureSpec = Mapping[str, Measure]


def spec(names: Sequence[str], **kw) -> dict[str, Measure]:
    """Same-named measures with shared settings."""
    return {n: Measure(**kw) for n in names}


def project_measures(df: DataFrame, measures: MeasureSpec, keep: Sequence[str | Column] = ()) -> DataFrame:
    """Typed, renamed projection: ``keep`` columns then one column per measure."""
    return df.select(*keep, *[m.value(n).alias(n) for n, m in measures.items()])


def mean_measures(
    df: DataFrame,
    keys: Sequence[str | Column],
    measures: MeasureSpec,
    distinct_counts: Mapping[str, str] | None = None,
    row_count: str | None = None,
    approx_distinct: float | None = None,
) -> DataFrame:
    """Per-key mean of every measure, scaled and rounded per its spec.

    ``distinct_counts`` adds ``COUNT(DISTINCT col)`` outputs (e.g. member
    stations), ``row_count`` a row count. With ``approx_distinct`` (a relative
    standard deviation, e.g. 0.01) the distinct counts are HyperLogLog++
    estimates: fixed-size sketches instead of a shuffle of distinct values.
    """
    aggs: list[Column] = []
    if row_count:
        aggs.append(F.count(F.lit(1)).alias(row_count))
    for name, c in (distinct_counts or {}).items():
        if approx_distinct is None:
            aggs.append(F.count_distinct(F.col(c)).alias(name))
        else:
            aggs.append(F.approx_count_distinct(F.col(c), approx_distinct).alias(name))
    aggs += [m.finish(F.avg(m.value(n))).alias(n) for n, m in measures.items()]
    return df.groupBy(*keys).agg(*aggs)


def dow_profile(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    measures: MeasureSpec,
    dow_name: str = "dow",
    count_name: str = "hist_rows_for_dow",
) -> DataFrame:
    """Mean of each measure per key and weekday (Sunday = 1), with the
    number of history rows behind it."""
    return df.groupBy(*keys, F.dayofweek(F.col(date_col)).alias(dow_name)).agg(
        F.count(F.lit(1)).alias(count_name),
        *[m.finish(F.avg(m.value(n))).alias(n) for n, m in measures.items()],
    )


def bounds(
    df: DataFrame,
    keys: Sequence[str | Column],
    date_col: str,
    min_name: str = "min_date",
    max_name: str = "max_date",
    rows_name: str = "rows",
    days_name: str | None = "days",
) -> DataFrame:
    """History span per key: first day, last day, rows, distinct days."""
    d = F.col(date_col)
    aggs = [F.min(d).alias(min_name), F.max(d).alias(max_name), F.count(F.lit(1)).alias(rows_name)]
    if days_name:
        aggs.append(F.count_distinct(d).alias(days_name))
    return df.groupBy(*keys).agg(*aggs)


def per_key_max(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """A per-key constant taken as ``max`` (e.g. a station's coordinates)."""
    return df.groupBy(*keys).agg(*[F.max(F.col(src)).alias(out) for out, src in cols.items()])


def stamp(df: DataFrame, **consts) -> DataFrame:
    """Add constant provenance columns (source, method, unit system, ...)."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (presentation; keeps results stable across
    engines that sum floating values in different orders)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("double", "float"):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


__all__ = [
    "Measure",
    "MeasureSpec",
    "bounds",
    "col",
    "dow_profile",
    "mean_measures",
    "per_key_max",
    "project_measures",
    "round_doubles",
    "spec",
    "stamp",
]
