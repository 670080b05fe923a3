"""Composite jobs built from the operators."""

from .forecast import dow_profile_forecast, horizon_days, scaffold
from .report import forecast_report
from .resolve import repair_funnel, resolve_all, resolve_places, zip_reference
from .sales import place_day_sales
from .training import place_day_training
from .weather import PLACE_DAY_WEATHER, place_day_weather

__all__ = [
    "dow_profile_forecast", "horizon_days", "scaffold", "forecast_report", "repair_funnel", "resolve_all",
    "resolve_places", "zip_reference", "place_day_sales", "place_day_training", "PLACE_DAY_WEATHER",
    "place_day_weather",
]
