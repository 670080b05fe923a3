"""Plan-shape checks: the physical plans keep the properties the design
relies on at scale."""

import os

import pytest

from geodemand.queries import registry
from geodemand.operators.keyed import latest_version, mode_reference
from geodemand.sources import roles

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
MODEL_QUERIES = {"fit_forest", "fit_boosted", "select_best", "model_round_trip", "score_forecast", "end_to_end_forecast", "job_forecast"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyed_picks_are_partial_aggregates_not_window_sorts(spark):
    for df in (
        latest_version(roles.customer_versions(spark, SF)),
        mode_reference(roles.customers_raw(spark, SF).where("postcode IS NOT NULL"), "postcode", ["city", "state"]),
    ):
        p = plan(df)
        assert "Window" not in p
        assert "partial_max" in p or "partial_min" in p


def test_nearest_place_has_no_pair_join(spark):
    p = plan(registry.QUERIES["nearest_place"](spark, SF))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "Window"):
        assert bad not in p
    assert "partial_min" in p


def test_order_pricing_does_not_explode(spark):
    p = plan(registry.QUERIES["place_day_sales"](spark, SF))
    assert "explode(from_json" not in p  # line items are priced in the row, not exploded
    assert "partial_sum" in p


def formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_epoch_range_reaches_the_scan(spark):
    p = formatted(spark, registry.QUERIES["filter_date_range"](spark, SF))
    assert "GreaterThanOrEqual(order_datetime,820454400)" in p
    assert "LessThan(order_datetime,828316800)" in p


def test_no_python_in_any_query_plan(spark):
    for name, q in registry.QUERIES.items():
        if name in MODEL_QUERIES:
            continue
        p = plan(q(spark, SF))
        assert not any(n in p for n in PYTHON_NODES), name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def below(p: str, upper: str, lower: str) -> bool:
    """Whether ``lower`` first stands in the same branch of the plan under the last ``upper``."""
    lines = p.splitlines()
    at = max(i for i, x in enumerate(lines) if upper in x)
    return any(lower in x for x in lines[at:])


def test_orders_are_reduced_to_target_customers_before_their_json_is_parsed(spark):
    p = plan(registry.QUERIES["place_day_sales"](spark, SF))
    assert below(p, "from_json", "_reduce_bits") and below(p, "partial_sum", "_reduce_bits")
    assert "BroadcastHashJoin [_reduce_word" in p


def test_station_days_are_reduced_to_mapped_stations_before_they_are_summed(spark):
    from geodemand.plans.weather import place_day_weather
    from geodemand.operators.measures import Measure

    fact = spark.range(1000).selectExpr("id % 50 AS postal_code", "date'2024-01-01' AS day", "id % 90 * 1.0 AS lat", "id % 90 * 1.0 AS lon", "1.0 AS temp_avg")
    p = plan(place_day_weather(fact, roles.places(spark, SF), 80.0, {"temp_avg": Measure()}))
    sums = [i for i, x in enumerate(p.splitlines()) if "partial_sum" in x and "partial_count" in x]
    reduced = [i for i, x in enumerate(p.splitlines()) if "_reduce_word" in x and "BroadcastHashJoin" in x]
    exchanges = [i for i, x in enumerate(p.splitlines()) if "Exchange hashpartitioning(postal_code" in x]
    assert sums and reduced and max(i for i in sums if i < reduced[0]) < reduced[0] < min(i for i in [*exchanges, 10**6] if i > reduced[0])
