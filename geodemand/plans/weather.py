"""Postal-code daily weather -> place-day weather."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from ..operators.measures import Measure, MeasureSpec
from ..operators.reduce import keep_possible
from ..operators.spatial import nearest_place, place_day_measures, stations

# The place-day weather vocabulary with its rounding (and the
# fraction -> percent scale of cloud cover), keyed by output name.
PLACE_DAY_WEATHER: dict[str, Measure] = {
    "temp_max": Measure(digits=2),
    "temp_min": Measure(digits=2),
    "temp_avg": Measure(digits=2),
    "cloud_cover": Measure(scale=100.0, digits=1),
    "precip_total": Measure(digits=5),
    "rain": Measure(digits=5),
    "snow": Measure(digits=5),
    "uv": Measure(digits=2),
    "humidity": Measure(digits=2),
    "wind_speed": Measure(digits=2),
    "wind_gust_max_mph": Measure(digits=2),
}


def place_day_weather(
    fact: DataFrame,
    centres: DataFrame,
    max_km: float = 80.0,
    measures: MeasureSpec | None = None,
    key: str = "postal_code",
    date_col: str = "day",
    lat: str = "lat",
    lon: str = "lon",
    where: Column | None = None,
    consts: Mapping[str, object] | None = None,
    reduce_bits: int = 1 << 22,
) -> DataFrame:
    """Each station mapped to its nearest centre within ``max_km``, then
    place-day means over member stations and their count.

    A station with several coordinates competes with each of them (the
    nearest pair wins) and all its rows count towards its place.

    ``measures`` defaults to the :data:`PLACE_DAY_WEATHER` entries whose
    source column exists in ``fact``.
    """
    if measures is None:
        measures = {n: m for n, m in PLACE_DAY_WEATHER.items() if m.source(n) in fact.columns}
    # The station list reads only the key and coordinate columns of the fact
    # (a pruned scan with a partial distinct). The second scan keeps the rows of
    # mapped stations (a filter of hashed station bits), so only these are summed
    # per (station, day) and shuffled. Two scans, because all rows of a station
    # count once any of its coordinates is near enough.
    f = fact if where is None else fact.where(where)
    pts = stations(f, key, lat, lon)
    mapping = nearest_place(pts, centres, max_km, point_key=key, point_lat=lat, point_lon=lon)
    return place_day_measures(keep_possible(f, mapping, key, reduce_bits), mapping, key, date_col, measures, consts=consts)
