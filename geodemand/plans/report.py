"""Forecast report: predictions with weather context for one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.report import join_suffixed, place_options, place_report

# The columns the report shows next to the date.
REPORT_COLUMNS = ("sales_amount_pred", "temp_avg", "precip_total", "cloud_cover", "wind_speed", "humidity", "uv")


def forecast_report(
    forecast: DataFrame,
    weather: DataFrame,
    city: str | None = None,
    state: str | None = None,
    cols: Sequence[str] = REPORT_COLUMNS,
    context: str | None = None,
    keys: Sequence[str] = ("city", "state", "date"),
) -> tuple[DataFrame, DataFrame]:
    """(place options, report rows).

    The forecast is left-joined to the weather on place and day (weather
    columns that clash get ``_weather``). Without ``city``/``state`` the first
    option in (state, city) order is shown; only that single first row of the
    small ordered option list is fetched.
    """
    f = forecast.withColumn("date", F.col("date").cast("date"))
    w = weather.withColumn("date", F.col("date").cast("date"))
    joined = join_suffixed(f, w, list(keys), "_weather")
    options = place_options(joined)
    if city is None or state is None:
        first = options.first()
        if first is None:
            raise ValueError("Forecast is empty. Run the forecast first.")
        city, state = first["city"], first["state"]
    present = [c for c in cols if c in joined.columns]
    return options, place_report(joined, city, state, present, context)
