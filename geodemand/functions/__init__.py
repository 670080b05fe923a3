"""Column-expression helpers (pure ``Column -> Column``; JVM built-ins only)."""

from .dates import (
    SEASON_MONTHS,
    between_dates,
    epoch_day_range,
    epoch_to_day,
    horizon,
    is_weekend,
    remap_month,
    season,
    weekday,
)
from .geo import EARTH_RADIUS_KM, KM_PER_DEGREE, haversine_km
from .logic import clip, flag, flag_sum
from .money import LINE_ITEM_PRICING_TYPE, LINE_ITEM_TYPE, line_amount, parse_lines
from .text import (
    clean_postcode,
    norm_key,
    norm_text,
    place_label,
    split_label,
    strip_decimal_suffix,
    title_place,
)

__all__ = [
    "SEASON_MONTHS", "between_dates", "epoch_day_range", "epoch_to_day", "horizon",
    "is_weekend", "remap_month", "season", "weekday",
    "EARTH_RADIUS_KM", "KM_PER_DEGREE", "haversine_km",
    "clip", "flag", "flag_sum",
    "LINE_ITEM_PRICING_TYPE", "LINE_ITEM_TYPE", "line_amount", "parse_lines",
    "clean_postcode", "norm_key", "norm_text", "place_label", "split_label",
    "strip_decimal_suffix", "title_place",
]
