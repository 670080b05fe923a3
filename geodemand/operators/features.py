"""Row features for place-day tables.

Lag and rolling features count *rows*, not calendar days: a gap in the days is
skipped over, as in the reference. Their windows are partitioned by place on
input that is already one row per place and day, so a partition holds at most
one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.logic import clip
from ..functions.text import norm_key, title_place


def _day_number(order: str):
    return F.datediff(F.col(order).cast("date"), F.lit("1970-01-01").cast("date"))


def lag_feature(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    col: str,
    n: int = 1,
    name: str | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Value of ``col`` ``n`` rows earlier within each key (null at the start).

    ``calendar=True``: the value exactly ``n`` days earlier (``order`` is a
    date), null when that day is missing, instead of the previous row.
    """
    out = name or f"{col}_lag_{n}"
    if calendar:
        w = Window.partitionBy(*keys).orderBy(_day_number(order)).rangeBetween(-n, -n)
        return df.withColumn(out, F.first(F.col(col)).over(w))
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(out, F.lag(F.col(col), n).over(w))


def rolling_prev_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    col: str,
    n: int = 7,
    name: str | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Mean of up to ``n`` previous rows within each key, current row excluded.

    ``calendar=True``: the mean over the previous ``n`` calendar days (days
    without a row simply contribute nothing).
    """
    out = name or f"{col}_roll{n}_mean_prev"
    if calendar:
        w = Window.partitionBy(*keys).orderBy(_day_number(order)).rangeBetween(-n, -1)
    else:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-n, -1)
    return df.withColumn(out, F.avg(F.col(col)).over(w))


def weather_features(
    df: DataFrame,
    max_col: str | None = "temp_max",
    min_col: str | None = "temp_min",
    rain_col: str | None = "rain",
    precip_col: str | None = "precip_total",
    range_name: str = "temp_range",
    rainy_name: str = "is_rainy",
    rainy_above: float = 0.0,
) -> DataFrame:
    """``temp_range = max - min``; ``is_rainy = coalesce(rain, precip, 0) > rainy_above``.

    Rain is looked at first: a 0.0 rain is not null, so precipitation falling
    as snow leaves the flag at 0. Absent columns are skipped (the range) or
    left out of the coalesce (the flag).
    """
    out = {}
    if max_col in df.columns and min_col in df.columns:
        out[range_name] = F.col(max_col) - F.col(min_col)
    wet = [F.col(c) for c in (rain_col, precip_col) if c and c in df.columns]
    out[rainy_name] = F.when(F.coalesce(*wet, F.lit(0.0)) > F.lit(float(rainy_above)), F.lit(1)).otherwise(F.lit(0))
    return df.withColumns(out)


def place_keys(df: DataFrame, city: str = "city", state: str = "state", date: str = "date") -> DataFrame:
    """Add normalised join keys ``city_key, state_key`` and a typed ``date``."""
    return df.withColumns(
        {"city_key": norm_key(city), "state_key": norm_key(state), date: F.col(date).cast("date")}
    )


def place_labels(df: DataFrame, city: str = "city", state: str = "state") -> DataFrame:
    """Place names in the form that training rows carry: city in title case, state in upper case."""
    return df.withColumns({city: title_place(norm_key(city)), state: norm_key(state)})


@dataclass(frozen=True)
class EffectsSpec:
    """Deterministic additive score: base, per-category lift, stepped penalty,
    distance-from-comfort bonus, weighted terms, floor."""

    base: float
    category_col: str
    category_lift: Mapping[str, float]
    step_col: str
    # (threshold, value) from the highest threshold down; ``step_else`` when
    # no threshold is exceeded.
    steps: Sequence[tuple[float, float]]
    step_else: float
    comfort_col: str
    comfort_at: float
    comfort_max: float
    comfort_slope: float
    weights: Mapping[str, float] = field(default_factory=dict)
    floor: float | None = None


# The demo score's coefficients (seasonal lift, rain steps,
# comfort temperature, per-unit effects, floor).
DEMO_EFFECTS = EffectsSpec(
    base=185.0,
    category_col="season",
    category_lift={"winter": 18.0, "spring": 8.0, "summer": 26.0, "autumn": 12.0},
    step_col="precipitation_mm",
    steps=((12.0, -22.0), (0.0, -8.0)),
    step_else=6.0,
    comfort_col="temperature_c",
    comfort_at=21.0,
    comfort_max=38.0,
    comfort_slope=2.4,
    weights={
        "is_weekend": 24.0,
        "is_holiday": 30.0,
        "discount_pct": 3.8,
        "humidity_pct": -0.22,
        "wind_speed_kmh": -0.35,
    },
    floor=35.0,
)


def effects_score(df: DataFrame, spec: EffectsSpec = DEMO_EFFECTS, name: str = "score") -> DataFrame:
    """Add the additive-effects score column ``name``."""
    cat = F.col(spec.category_col)
    lift = None
    for k, v in spec.category_lift.items():
        lift = F.when(cat == k, F.lit(v)) if lift is None else lift.when(cat == k, F.lit(v))
    lift = lift.otherwise(F.lit(0.0)) if lift is not None else F.lit(0.0)
    step_c = F.col(spec.step_col)
    step = None
    for thr, v in spec.steps:
        step = F.when(step_c > thr, F.lit(v)) if step is None else step.when(step_c > thr, F.lit(v))
    step = step.otherwise(F.lit(spec.step_else)) if step is not None else F.lit(spec.step_else)
    comfort = F.lit(spec.comfort_max) - F.abs(F.col(spec.comfort_col) - F.lit(spec.comfort_at)) * F.lit(
        spec.comfort_slope
    )
    score: Column = F.lit(spec.base) + lift + step + comfort
    for c, w in spec.weights.items():
        score = score + F.col(c) * F.lit(w)
    return df.withColumn(name, clip(score, lo=spec.floor))
