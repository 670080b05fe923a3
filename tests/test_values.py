"""Imputation, profiles, prices and orders at the edges of their types."""

import decimal

import pytest
from geodemand.functions.money import line_amount
from geodemand.operators import ml
from geodemand.operators.features import place_labels
from geodemand.operators.quality import column_profile
from geodemand.plans.job import JobConfig, build_tables
from geodemand.sources import roles
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("kind,values,median", [
    ("int", [1, 2, 3, 10, None], 2.5),
    ("decimal(10,0)", [decimal.Decimal(v) for v in (1, 2, 3, 10)] + [None], 2.5),
    ("long", [5, None, 6], 5.5),
    ("double", [-1.7e308, 0.0, 1.0, 1.7e308, None], 0.5),
    ("double", [1.7e308, 1.7e308, None], 1.7e308),
])
def test_medians_are_not_cut_to_the_column_type(spark, kind, values, median):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    filled = [r["x"] for r in ml.impute_median(df, ["x"]).collect()]
    assert filled[values.index(None)] == median
    fitted = ml.MedianModeImputer(numericCols=["x"], modeCols=[]).fit(df).transform(df)
    assert [r["x"] for r in fitted.collect()][values.index(None)] == median


@pytest.mark.parametrize("values", [[-1.7e308, 1.7e308, 0.0, 1.0, 2.0], [5e-324, 0.0, 1e-323, 5e-324], [3.0] * 7 + [4.0]])
def test_narrowing_ends_for_extreme_ranges(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    s = sorted(values)
    mid = (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2
    assert ml.exact_median(df, "x", step_bits=6) == mid


def test_a_feature_without_values_is_named(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    with pytest.raises(ValueError, match="b"):
        ml.MedianModeImputer(numericCols=["a", "b"], modeCols=[]).fit(df)


def test_profile_orders_numbers_and_dates_by_value(spark):
    df = spark.sql("SELECT * FROM VALUES (9, DATE '2024-01-09'), (10, DATE '2023-12-31'), (100, NULL) t(n, d)")
    r = column_profile(df, ["n", "d"]).first()
    assert (r["n_min"], r["n_max"], r["d_min"], r["d_max"], r["d_null_or_blank"]) == ("9", "100", "2023-12-31", "2024-01-09", 1)


def test_an_amount_that_does_not_fit_is_null(spark):
    df = spark.createDataFrame([("10000000000", "10000000000", 0.0), ("2.50", "4", 0.1), ("x", "1", None)], "p string, q string, d double")
    assert [r[0] for r in df.select(line_amount("p", "q", "d")).collect()] == [None, decimal.Decimal("9.00"), None]


def test_a_long_order_is_one_row(spark, tmp_path):
    orders = spark.sql("SELECT 1L AS o_orderkey, 7L AS o_custkey, TIMESTAMP '2024-01-01' AS o_orderdate")
    lines = spark.range(200).select(
        F.lit(1).cast("long").alias("l_orderkey"), (F.col("id") + 1).cast("int").alias("l_linenumber"),
        F.lit(2.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(1.0).alias("l_quantity"),
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = roles.orders_json(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0]["number_of_line_items"] == 200 and rows[0]["ordered_products"].count("price") == 200


def test_the_horizon_names_places_as_training_does(spark):
    t = build_tables(spark, JobConfig(sf_dir=SF))
    ml.require_known_places(t["horizon"], t["training"])
    other = place_labels(spark.createDataFrame([("  atlantis ", "xx")], "city string, state string"))
    with pytest.raises(ValueError, match="Atlantis, XX"):
        ml.require_known_places(other, t["training"])
