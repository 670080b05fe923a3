"""DataFrame operators (keyed picks, measures, nearest place, order lines,
features, quality checks, report views, model training)."""

from .features import (
    DEMO_EFFECTS,
    EffectsSpec,
    effects_score,
    place_labels,
    lag_feature,
    place_keys,
    rolling_prev_mean,
    weather_features,
)
from .keyed import enforce_grain, fill_from_reference, latest_per_key, latest_version, mode_reference, open_version
from .lines import explode_lines, order_amounts, priced_orders
from .measures import Measure, bounds, dow_profile, mean_measures, per_key_max, project_measures, round_doubles, stamp
from .quality import (
    column_profile,
    coverage_full,
    coverage_left,
    duplicate_keys,
    duplicate_surplus,
    null_profile,
    row_counts,
)
from .reduce import keep_possible, key_bits
from .report import CONTEXT_MEASURES, join_suffixed, place_options, place_report
from .sizing import bounded_broadcast
from .spatial import centre_cells, dense_candidates, nearest_place, place_day_measures, stations

__all__ = [
    "DEMO_EFFECTS", "EffectsSpec", "effects_score", "place_labels", "lag_feature", "place_keys",
    "rolling_prev_mean", "weather_features",
    "enforce_grain", "fill_from_reference", "latest_per_key", "latest_version", "mode_reference", "open_version",
    "explode_lines", "order_amounts", "priced_orders",
    "Measure", "bounds", "dow_profile", "mean_measures", "per_key_max", "project_measures", "round_doubles", "stamp",
    "column_profile", "coverage_full", "coverage_left", "duplicate_keys", "duplicate_surplus", "null_profile",
    "row_counts",
    "keep_possible", "key_bits",
    "CONTEXT_MEASURES", "join_suffixed", "place_options", "place_report",
    "bounded_broadcast",
    "centre_cells", "dense_candidates", "nearest_place", "place_day_measures", "stations",
]
