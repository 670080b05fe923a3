"""Driver tables -> the reference's input roles.

The reference reads postal-code daily weather, a customer table with validity
versions and sales orders whose line items are JSON text. The driver tables are
TPC-H-like; these functions stand those roles up from them with plain column
expressions, so every query's work grows with the driver tables. The DuckDB
oracle (:mod:`geodemand.queries.oracle_roles`) writes the same expressions in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import LINE_ITEM_TYPE
from ..operators.features import weather_features

# Fixed value: the day the registered forecast queries start from (day after
# the last events day), never current_date(), so results are reproducible.
HORIZON_ANCHOR = dt.date(2024, 1, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One place per region: display name, state code, centre, and a
    representative postal code (the station of the same number)."""
    r = table(spark, sf_dir, "region")
    return r.select(
        F.col("r_name").alias("city"),
        F.upper(F.substring("r_name", 1, 2)).alias("state"),
        (F.lit(30) + 4 * F.col("r_regionkey")).cast("double").alias("center_lat"),
        (F.lit(-120) + 10 * F.col("r_regionkey")).cast("double").alias("center_lon"),
        F.lpad(F.col("r_regionkey").cast("string"), 5, "0").alias("postal_code"),
    )


def target_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target (city, state) pairs in normalised form: lower city, upper state."""
    r = table(spark, sf_dir, "region")
    return r.select(
        F.lower("r_name").alias("target_city_norm"),
        F.upper(F.substring("r_name", 1, 2)).alias("target_state"),
    )


def station_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postal-code daily weather: one row per station (user) and day.

    Coordinates are a function of the user id placed around the region
    centres; each measure is an aggregate of one event type's values.
    """
    e = table(spark, sf_dir, "events")
    u = F.col("user_id")

    def mean_of(kind: str):
        return F.avg(F.when(F.col("event_type") == kind, F.col("value")))

    return e.groupBy(u, F.to_date("ts").alias("day")).agg(
        F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("temp_max"),
        F.min(F.when(F.col("event_type") == "view", F.col("value"))).alias("temp_min"),
        mean_of("view").alias("temp_avg"),
        mean_of("click").alias("humidity"),
        mean_of("purchase").alias("precip_total"),
        mean_of("error").alias("wind_speed"),
        mean_of("signup").alias("uv"),
    ).select(
        F.lpad(u.cast("string"), 5, "0").alias("postal_code"),
        "day",
        ((F.lit(30) + 4 * (u % 5)).cast("double") + ((u * 7) % 13 - 6).cast("double") * 0.15).alias("lat"),
        ((F.lit(-120) + 10 * (u % 5)).cast("double") + ((u * 11) % 17 - 8).cast("double") * 0.15).alias("lon"),
        "temp_max", "temp_min", "temp_avg", "humidity", "precip_total", "wind_speed", "uv",
    )


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer geography with the defects the repair must handle: missing,
    blank and wrong cities, missing states, postcodes with ``.0`` and ZIP+4
    suffixes and lost leading zeros."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    base = F.when(F.col("c_nationkey") < 5, F.col("c_nationkey") + 1000).otherwise(
        F.col("c_nationkey") + 10000
    ).cast("string")
    suffix = F.when(k % 2 == 0, F.lit(".0")).when(k % 3 == 0, F.lit("-1234")).otherwise(F.lit(""))
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, F.col("n_regionkey") == r.r_regionkey)
        .select(
            k.alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.when(k % 6 == 0, F.lit(None).cast("string"))
            .when(k % 11 == 0, F.lit("  "))
            .when(k % 17 == 0, F.lit("ASIA"))
            .otherwise(F.lower("r_name"))
            .alias("city"),
            F.when(k % 13 == 0, F.lit(None).cast("string"))
            .otherwise(F.lower(F.substring("r_name", 1, 2)))
            .alias("state"),
            F.when(k % 29 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(base, suffix))
            .alias("postcode"),
            F.col("c_mktsegment").alias("loyalty_segment"),
        )
    )


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity-versioned customers: every customer has an open row; every
    fourth also has an older closed row with an upper-cased city.

    Built in one scan by exploding a version index, not by a union.
    """
    raw = customers_raw(spark, sf_dir)
    k = F.col("customer_id")
    v = raw.withColumn(
        "_v", F.explode(F.when(k % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    closed = F.col("_v") == 1
    return v.select(
        "customer_id",
        "customer_name",
        F.when(closed, F.upper("city")).otherwise(F.col("city")).alias("city"),
        "state",
        "postcode",
        "loyalty_segment",
        (F.lit(1500000000) + k - F.when(closed, F.lit(1000)).otherwise(F.lit(0))).alias("valid_from"),
        F.when(closed, F.lit("2019-01-01"))
        .when(k % 7 == 0, F.lit(" "))
        .otherwise(F.lit(None).cast("string"))
        .alias("valid_to"),
    )


def orders_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales orders with line items as JSON text, one row per order.

    The list of an order holds its own lines only, as the source table does.
    """
    o = table(spark, sf_dir, "orders")
    # A partial collect_list reduces nothing (the list keeps every line), so
    # the lines are hash-partitioned by order first: the gathering runs after
    # that one exchange, which the join to the orders shares.
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("number_of_line_items"),
        F.to_json(
            F.collect_list(
                F.struct(
                    F.col("l_extendedprice").cast("string").alias("price"),
                    F.struct(F.col("l_discount").alias("promo_disc")).alias("promotion_info"),
                    F.col("l_quantity").cast("int").cast("string").alias("qty"),
                )
            )
        ).alias("ordered_products"),
    )
    return o.join(lines, o.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_number"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderkey") % 89 == 0, F.lit(None).cast("long"))
        .otherwise(F.unix_timestamp("o_orderdate"))
        .alias("order_datetime"),
        "number_of_line_items",
        "ordered_products",
    )


def demo_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day frame in the demo model's vocabulary, aggregated from events."""
    e = table(spark, sf_dir, "events")

    def mean_of(kind: str):
        return F.avg(F.when(F.col("event_type") == kind, F.col("value")))

    d = e.groupBy(F.to_date("ts").alias("date")).agg(
        mean_of("view").alias("temperature_c"),
        mean_of("purchase").alias("precipitation_mm"),
        mean_of("error").alias("wind_speed_kmh"),
        mean_of("click").alias("humidity_pct"),
        F.count(F.when(F.col("event_type") == "signup", 1)).alias("n_signup"),
        F.count(F.lit(1)).alias("customer_count"),
    )
    days = d.select(
        "date",
        F.when(F.month("date").isin(12, 1, 2), "winter")
        .when(F.month("date").isin(3, 4, 5), "spring")
        .when(F.month("date").isin(6, 7, 8), "summer")
        .otherwise("autumn")
        .alias("season"),
        F.round(F.col("temperature_c") - 25.0, 1).alias("temperature_c"),
        F.round(F.col("precipitation_mm") / 10.0, 1).alias("precipitation_mm"),
        F.round(F.col("wind_speed_kmh") / 2.0, 1).alias("wind_speed_kmh"),
        F.round(F.col("humidity_pct") + 40.0, 1).alias("humidity_pct"),
        ((F.col("n_signup") % 6) * 5).cast("int").alias("discount_pct"),
        F.when(F.dayofweek("date").isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.when(F.dayofmonth("date") == 1, 1).otherwise(0).alias("is_holiday"),
        F.col("customer_count").cast("int").alias("customer_count"),
    )
    wet = weather_features(days, max_col=None, min_col=None, rain_col=None, precip_col="precipitation_mm", rainy_above=1.0)
    return wet.select(*[c for c in days.columns if c != "customer_count"], "is_rainy", "customer_count")


__all__ = [
    "HORIZON_ANCHOR",
    "LINE_ITEM_TYPE",
    "customer_versions",
    "customers_raw",
    "demo_day",
    "orders_json",
    "places",
    "station_day",
    "table",
    "target_places",
]
