"""Training table: place-day sales features joined to place-day weather.

Order matters and follows the reference: sales are re-aggregated to the
grain, lag and rolling features are computed on *all* sales days, and only then
is weather joined (inner), so days lost in the join still feed the features.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_weekend
from ..functions.text import norm_key, title_place
from ..operators.features import lag_feature, rolling_prev_mean, weather_features

# The weather features of the training table, in output order.
TRAINING_WEATHER = (
    "temp_max",
    "temp_min",
    "temp_avg",
    "cloud_cover",
    "precip_total",
    "rain",
    "snow",
    "uv",
    "humidity",
    "wind_speed",
)

KEYS = ("city_key", "state_key", "date")


def _keyed(df: DataFrame) -> DataFrame:
    return df.select(
        norm_key("city").alias("city_key"),
        norm_key("state").alias("state_key"),
        F.col("date").cast("date").alias("date"),
        *[c for c in df.columns if c not in ("city", "state", "date")],
    )


def place_day_training(
    sales: DataFrame,
    weather: DataFrame,
    measures: Sequence[str] | None = None,
    sales_col: str = "sales_amount",
    lag_rows: int = 1,
    roll_rows: int = 7,
) -> DataFrame:
    """One row per place and day with sales, weather means, derived flags and
    the previous-row sales features.

    ``measures`` defaults to the :data:`TRAINING_WEATHER` columns present in
    ``weather``.
    """
    if measures is None:
        measures = [m for m in TRAINING_WEATHER if m in weather.columns]
    s = _keyed(sales).groupBy(*KEYS).agg(F.sum(F.col(sales_col).cast("double")).alias(sales_col))
    lag_name = f"{sales_col}_lag_{lag_rows}d"
    roll_name = f"{sales_col}_roll{roll_rows}_mean_prev"
    s = lag_feature(s, ["city_key", "state_key"], "date", sales_col, lag_rows, lag_name)
    s = rolling_prev_mean(s, ["city_key", "state_key"], "date", sales_col, roll_rows, roll_name)
    w = _keyed(weather).groupBy(*KEYS).agg(*[F.avg(F.col(m).cast("double")).alias(m) for m in measures])
    j = weather_features(s.join(w, list(KEYS)))
    extra = [c for c in ("temp_range",) if c in j.columns]
    return j.select(
        title_place("city_key").alias("city"),
        F.col("state_key").alias("state"),
        "date",
        sales_col,
        *measures,
        *extra,
        is_weekend("date").alias("is_weekend"),
        "is_rainy",
        lag_name,
        roll_name,
    )
