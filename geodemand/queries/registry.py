"""Registered queries: one per operator of the survey inventory.

Each query takes ``(spark, sf_dir)``, reads the driver tables (through the
roles in :mod:`geodemand.sources.roles`) and returns a lazy DataFrame. Its
DuckDB twin, where one exists, is in :data:`ORACLE` under the same name.
Double outputs are rounded on both sides (6 places, 4 for values near 1e8): engines sum floating
values in different orders.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.measures import Measure, round_doubles
from ..plans.resolve import resolve_places
from ..plans.sales import place_day_sales
from ..plans.training import place_day_training
from ..plans.weather import PLACE_DAY_WEATHER, place_day_weather
from ..sources import roles
from .oracle_roles import spark_round, with_roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


# Session settings the queries' semantics rely on: day boundaries in UTC.
QUERY_CONF = {"spark.sql.session.timeZone": "UTC"}


def _with_conf(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for k, v in QUERY_CONF.items():
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        return fn(spark, sf_dir)

    return run


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = _with_conf(fn)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def rounded_sql(body: str, double_cols: list[str], digits: int = 6) -> str:
    """Round the named double columns of ``body`` (mirror of ``round_doubles``)."""
    if not double_cols:
        return body
    rep = ", ".join(f"{spark_round(c, digits)} AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{body}\n) q"


# --------------------------------------------------------------------------
# Shared building blocks (Spark side).
# --------------------------------------------------------------------------


def resolved_customers(spark: SparkSession, d: str) -> DataFrame:
    return resolve_places(roles.customer_versions(spark, d), roles.target_places(spark, d))


def sales_2024_01(spark: SparkSession, d: str) -> DataFrame:
    """Place-day sales, every month re-dated into January 2024."""
    return place_day_sales(roles.orders_json(spark, d), resolved_customers(spark, d), year=2024, month=1)


# The registered weather measures are averaged as decimals: an exact sum makes
# the rounded means independent of summation order, so Spark and DuckDB agree
# to the last digit. (The library default, PLACE_DAY_WEATHER, averages doubles
# as the reference does.)
WEATHER_DEC = {
    n: Measure(type="decimal(12,4)", scale=m.scale, digits=m.digits)
    for n, m in PLACE_DAY_WEATHER.items()
    if n in ("temp_max", "temp_min", "temp_avg", "precip_total", "uv", "humidity", "wind_speed")
}


def weather_history(spark: SparkSession, d: str) -> DataFrame:
    return place_day_weather(roles.station_day(spark, d), roles.places(spark, d), 80.0, WEATHER_DEC)


# --------------------------------------------------------------------------
# Flagship: the training table.
# --------------------------------------------------------------------------

TRAINING_DOUBLES = [
    "sales_amount", "temp_max", "temp_min", "temp_avg", "precip_total", "uv", "humidity",
    "wind_speed", "temp_range", "sales_amount_lag_1d", "sales_amount_roll7_mean_prev",
]


@register(
    "place_day_training",
    rounded_sql(with_roles("SELECT * FROM training", "training"), TRAINING_DOUBLES, 4),
)
def q_place_day_training(spark: SparkSession, d: str) -> DataFrame:
    return round_doubles(place_day_training(sales_2024_01(spark, d), weather_history(spark, d)), 4)


# Register the query modules (each registers on import).
from . import q_basic  # noqa: E402,F401
from . import q_model  # noqa: E402,F401
from . import q_checks  # noqa: E402,F401
