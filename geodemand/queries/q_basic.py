"""Registered queries: sources, sinks, projections, filters, scalar functions,
joins and aggregations (survey sections 2.1-2.7)."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import SEASON_MONTHS, epoch_to_day, horizon, is_weekend, remap_month, season, weekday
from ..functions.geo import haversine_km
from ..functions.text import clean_postcode, norm_key, norm_text, strip_decimal_suffix, title_place
from ..operators.features import DEMO_EFFECTS, EffectsSpec, effects_score, place_keys, weather_features
from ..operators.keyed import enforce_grain, latest_version
from ..operators.ml import score_scenarios
from ..operators.lines import explode_lines, order_amounts
from ..operators.measures import Measure, bounds, dow_profile, per_key_max, project_measures, round_doubles, stamp
from ..operators.quality import (
    column_profile,
    coverage_full,
    coverage_left,
    duplicate_keys,
    duplicate_surplus,
    null_profile,
    row_counts,
)
from ..operators.report import join_suffixed
from ..operators.sizing import bounded_broadcast
from ..operators.spatial import nearest_place, stations
from ..plans.forecast import scaffold
from ..plans.resolve import repair_funnel, zip_reference
from ..plans.training import place_day_training
from ..plans.weather import place_day_weather
from ..sources import roles
from ..sources.io import coerce, inline_table, read_csv, read_table, scratch_path, write_csv, write_guarded, write_table
from .oracle_roles import POSTCODE_5, POSTCODE_CLEAN, haversine, initcap, spark_round, with_roles
from .registry import (
    WEATHER_DEC,
    register,
    resolved_customers,
    rounded_sql,
    sales_2024_01,
    weather_history,
)

# --------------------------------------------------------------------------
# 2.1 Scans, sources, sinks
# --------------------------------------------------------------------------


@register("scan_table", "SELECT * FROM customer")
def q_scan_table(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, f"{d}/customer.parquet")


# An inline place list (display name, state code, representative
# postal code), the shape of the reference's inline city tables.
INLINE_PLACES = [
    ("AFRICA", "AF", "00000"),
    ("AMERICA", "AM", "00001"),
    ("ASIA", "AS", "00002"),
    ("EUROPE", "EU", "00003"),
    ("MIDDLE EAST", "MI", "00004"),
]


@register(
    "inline_places",
    with_roles(
        """SELECT p.city, p.state, p.postal_code, count(*) AS station_days, max(s.day) AS last_day
           FROM station_day s JOIN (VALUES """
        + ", ".join(f"('{c}', '{s}', '{z}')" for c, s, z in INLINE_PLACES)
        + """) p(city, state, postal_code) ON s.postal_code = p.postal_code
           GROUP BY 1, 2, 3""",
        "station_day",
    ),
)
def q_inline_places(spark: SparkSession, d: str) -> DataFrame:
    dim = inline_table(spark, INLINE_PLACES, "city string, state string, postal_code string")
    return (
        roles.station_day(spark, d)
        .join(dim, "postal_code")
        .groupBy("city", "state", "postal_code")
        .agg(F.count(F.lit(1)).alias("station_days"), F.max("day").alias("last_day"))
    )


@register("csv_round_trip", with_roles("SELECT * FROM place_day_weather", "place_day_weather"))
def q_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    df = weather_history(spark, d)
    path = scratch_path(spark, "csv_round_trip")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


def _checks_schema(spark: SparkSession) -> tuple[str, str]:
    base = scratch_path(spark, "tables")
    return "geodemand_checks", f"{base}/geodemand_checks.db"


@register("table_round_trip", with_roles("SELECT * FROM place_day_weather", "place_day_weather"))
def q_table_round_trip(spark: SparkSession, d: str) -> DataFrame:
    schema, loc = _checks_schema(spark)
    name = f"{schema}.place_day_weather"
    write_table(weather_history(spark, d), name, path=f"{loc}/place_day_weather", schema_location=loc)
    return spark.table(name)


GUARDED_SCHEMA = {
    "city": "string",
    "state": "string",
    "date": "date",
    "postal_code_count": "bigint",
    "temp_avg": "double",
}


@register(
    "guarded_sink",
    with_roles("SELECT city, state, date, postal_code_count, temp_avg FROM place_day_weather", "place_day_weather"),
)
def q_guarded_sink(spark: SparkSession, d: str) -> DataFrame:
    schema, loc = _checks_schema(spark)
    name = f"{schema}.guarded_weather"
    write_guarded(weather_history(spark, d), name, GUARDED_SCHEMA, path=f"{loc}/guarded_weather", schema_location=loc)
    return spark.table(name)


COERCE_SCHEMA = {"order_key": "bigint", "total": "double", "total_dec": "decimal(18,2)", "day": "date", "is_final": "boolean"}


@register(
    "coerce_types",
    """SELECT TRY_CAST(order_key AS BIGINT) AS order_key, TRY_CAST(total AS DOUBLE) AS total,
              CAST(TRY_CAST(total_dec AS DECIMAL(18,2)) AS DOUBLE) AS total_dec,
              TRY_CAST(day AS DATE) AS day, TRY_CAST(is_final AS BOOLEAN) AS is_final
       FROM (SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'k' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS order_key,
                    CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS total,
                    CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS total_dec,
                    CASE WHEN o_orderkey % 11 = 0 THEN 'not a day' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day,
                    CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE 'maybe' END AS is_final
             FROM orders) t""",
)
def q_coerce_types(spark: SparkSession, d: str) -> DataFrame:
    o = roles.table(spark, d, "orders")
    k = F.col("o_orderkey")
    text = o.select(
        F.when(k % 97 == 0, F.concat(F.lit("k"), k.cast("string"))).otherwise(k.cast("string")).alias("order_key"),
        F.when(k % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("total"),
        F.when(k % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("total_dec"),
        F.when(k % 11 == 0, F.lit("not a day")).otherwise(F.to_date("o_orderdate").cast("string")).alias("day"),
        F.when(F.col("o_orderstatus") == "F", "true")
        .when(F.col("o_orderstatus") == "O", "false")
        .otherwise("maybe")
        .alias("is_final"),
    )
    typed = coerce(text, COERCE_SCHEMA)
    return typed.withColumn("total_dec", F.col("total_dec").cast("double"))


# --------------------------------------------------------------------------
# 2.2 Projections, filters, predicates
# --------------------------------------------------------------------------

TYPED_MEASURES = {
    "t_avg": Measure("temp_avg"),
    "t_hi": Measure("temp_max"),
    "humid": Measure("humidity", valid_min=20.0),
    "wind": Measure("wind_speed", type="float"),
}


@register(
    "typed_projection",
    with_roles(
        rounded_sql(
            """SELECT postal_code, day, CAST(temp_avg AS DOUBLE) AS t_avg, CAST(temp_max AS DOUBLE) AS t_hi,
                      CASE WHEN CAST(humidity AS DOUBLE) >= 20.0 THEN CAST(humidity AS DOUBLE) END AS humid,
                      CAST(CAST(wind_speed AS FLOAT) AS DOUBLE) AS wind
               FROM station_day""",
            ["t_avg", "t_hi", "humid", "wind"],
            4,
        ),
        "station_day",
    ),
)
def q_typed_projection(spark: SparkSession, d: str) -> DataFrame:
    p = project_measures(roles.station_day(spark, d), TYPED_MEASURES, keep=["postal_code", "day"])
    return round_doubles(p.withColumn("wind", F.col("wind").cast("double")), 4)


@register("filter_eq", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def q_filter_eq(spark: SparkSession, d: str) -> DataFrame:
    e = roles.table(spark, d, "events")
    return e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@register(
    "filter_not_null",
    """SELECT o_orderkey AS order_number, o_custkey AS customer_id, CAST(epoch(o_orderdate) AS BIGINT) AS order_datetime
       FROM orders WHERE o_orderkey % 89 <> 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)
def q_filter_not_null(spark: SparkSession, d: str) -> DataFrame:
    o = roles.orders_json(spark, d)
    return o.dropna(subset=["order_datetime", "ordered_products"]).select("order_number", "customer_id", "order_datetime")


@register(
    "filter_date_range",
    with_roles(
        """SELECT order_number, customer_id, order_date, CAST(order_sales_amount AS DOUBLE) AS order_sales_amount
           FROM order_amounts WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'""",
        "order_amounts",
    ),
)
def q_filter_date_range(spark: SparkSession, d: str) -> DataFrame:
    # The orders role is first written as a table, as the reference's source
    # table is stored: the day range, turned into a half-open range on the
    # stored epoch seconds, is then pushed into the parquet scan.
    path = scratch_path(spark, "orders_json")
    roles.orders_json(spark, d).write.parquet(path)
    a = order_amounts(spark.read.parquet(path), "1996-01-01", "1996-03-31")
    return a.withColumn("order_sales_amount", F.col("order_sales_amount").cast("double"))


@register(
    "provenance_stamp",
    with_roles(
        """SELECT *, 'station_day' AS proxy_source_table,
                  'weekday_mean_of_own_history' AS proxy_method,
                  'imperial' AS unit_system
           FROM place_day_weather""",
        "place_day_weather",
    ),
)
def q_provenance_stamp(spark: SparkSession, d: str) -> DataFrame:
    return stamp(
        weather_history(spark, d),
        proxy_source_table="station_day",
        proxy_method="weekday_mean_of_own_history",
        unit_system="imperial",
    )


@register(
    "season_flags",
    """SELECT o_orderkey AS order_number, CAST(o_orderdate AS DATE) AS order_date,
              CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
                   WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
              dayofweek(o_orderdate) + 1 AS dow,
              CASE WHEN dayofweek(o_orderdate) + 1 IN (1, 7) THEN 1 ELSE 0 END AS is_weekend
       FROM orders""",
)
def q_season_flags(spark: SparkSession, d: str) -> DataFrame:
    o = roles.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_number"), F.to_date("o_orderdate").alias("order_date")
    )
    return o.select(
        "order_number",
        "order_date",
        season("order_date").alias("season"),
        weekday("order_date").cast("long").alias("dow"),
        is_weekend("order_date").alias("is_weekend"),
    )


@register(
    "distinct_keys",
    with_roles("SELECT * FROM stations", "stations"),
)
def q_distinct_keys(spark: SparkSession, d: str) -> DataFrame:
    return stations(roles.station_day(spark, d), "postal_code", "lat", "lon")


def effects_sql(spec: EffectsSpec = DEMO_EFFECTS) -> str:
    """The score written out from the spec's values."""

    def cases(tests: list[tuple[str, float]], other: float) -> str:
        return "CASE " + " ".join(f"WHEN {t} THEN {v}::DOUBLE" for t, v in tests) + f" ELSE {other}::DOUBLE END"

    lift = cases([(f"{spec.category_col} = '{k}'", v) for k, v in spec.category_lift.items()], 0.0)
    step = cases([(f"{spec.step_col} > {at}", v) for at, v in spec.steps], spec.step_else)
    comfort = f"({spec.comfort_max} - abs({spec.comfort_col} - {spec.comfort_at}) * {spec.comfort_slope}::DOUBLE)"
    return " + ".join([f"{spec.base}::DOUBLE", lift, step, comfort, *[f"{c} * {v}::DOUBLE" for c, v in spec.weights.items()]])


EFFECTS_SQL = effects_sql()
SEASON_SQL = "CASE " + " ".join(f"WHEN month(date) IN {m} THEN '{name}'" for name, m in SEASON_MONTHS.items()) + " END"

DEMO_DAY_SQL = """SELECT date,
       {season} AS season,
       {r1t} AS temperature_c, {r1p} AS precipitation_mm, {r1w} AS wind_speed_kmh, {r1h} AS humidity_pct,
       CAST((n_signup % 6) * 5 AS INTEGER) AS discount_pct,
       CAST(isodow(date) > 5 AS INTEGER) AS is_weekend, CAST(day(date) = 1 AS INTEGER) AS is_holiday,
       CAST({r1p} > 1.0 AS INTEGER) AS is_rainy,
       CAST(customer_count AS INTEGER) AS customer_count
FROM (SELECT CAST(ts AS DATE) AS date,
             avg(value) FILTER (event_type = 'view') AS t, avg(value) FILTER (event_type = 'purchase') AS p,
             avg(value) FILTER (event_type = 'error') AS w, avg(value) FILTER (event_type = 'click') AS h,
             count(*) FILTER (event_type = 'signup') AS n_signup, count(*) AS customer_count
      FROM events GROUP BY 1) e""".format(
    r1t=spark_round("t - 25.0", 1),
    r1p=spark_round("p / 10.0", 1),
    r1w=spark_round("w / 2.0", 1),
    r1h=spark_round("h + 40.0", 1),
    season=SEASON_SQL,
)


@register(
    "effects_score",
    rounded_sql(f"SELECT date, season, greatest({EFFECTS_SQL}, 35.0) AS score FROM ({DEMO_DAY_SQL}) dd", ["score"]),
)
def q_effects_score(spark: SparkSession, d: str) -> DataFrame:
    return round_doubles(effects_score(roles.demo_day(spark, d)).select("date", "season", "score"))


@register(
    "scenario_delta",
    rounded_sql(
        f"""WITH dd AS ({DEMO_DAY_SQL}),
            hist AS (SELECT avg(greatest({EFFECTS_SQL}, 35.0)) AS base FROM dd),
            scen AS (SELECT date, season, temperature_c + 5.0 AS temperature_c, precipitation_mm, wind_speed_kmh,
                            humidity_pct, discount_pct, is_weekend, is_holiday FROM dd)
            SELECT date, greatest({EFFECTS_SQL}, 35.0) AS prediction,
                   greatest({EFFECTS_SQL}, 35.0) - (SELECT base FROM hist) AS delta_vs_mean
            FROM scen""",
        ["prediction", "delta_vs_mean"],
        4,
    ),
)
def q_scenario_delta(spark: SparkSession, d: str) -> DataFrame:
    days = roles.demo_day(spark, d)
    scen = days.withColumn("temperature_c", F.col("temperature_c") + 5.0)
    # the score formula stands in for a fitted model
    formula = PipelineModel([_EffectsModel()])
    out = score_scenarios(formula, scen, effects_score(days, name="prediction"), y="prediction")
    return round_doubles(out.select("date", "prediction", "delta_vs_mean"), 4)


class _EffectsModel(Transformer):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return effects_score(dataset, name="prediction")


# --------------------------------------------------------------------------
# 2.3 Joins
# --------------------------------------------------------------------------


@register(
    "join_dim_filter",
    with_roles(
        rounded_sql(
            """SELECT p.city, p.state, s.postal_code, s.day, s.temp_avg
               FROM station_day s JOIN places p ON s.postal_code = p.postal_code""",
            ["temp_avg"],
        ),
        "station_day",
        "places",
    ),
)
def q_join_dim_filter(spark: SparkSession, d: str) -> DataFrame:
    p = roles.places(spark, d).select("city", "state", "postal_code")
    s = roles.station_day(spark, d).join(bounded_broadcast(p), "postal_code")
    return round_doubles(s.select("city", "state", "postal_code", "day", "temp_avg"))


@register(
    "join_suffixed",
    with_roles(
        """SELECT n.*, w.temp_avg AS temp_avg_wide, w.humidity AS humidity_wide, w.postal_code_count AS postal_code_count_wide
           FROM (SELECT city, state, date, postal_code_count, temp_avg, humidity FROM place_day_weather) n
           LEFT JOIN (SELECT city, state, date, postal_code_count, temp_avg, humidity FROM place_day_weather_wide) w
             ON n.city = w.city AND n.state = w.state AND n.date = w.date""",
        "place_day_weather",
        "place_day_weather_wide",
    ),
)
def q_join_suffixed(spark: SparkSession, d: str) -> DataFrame:
    near = weather_history(spark, d).select("city", "state", "date", "postal_code_count", "temp_avg", "humidity")
    wide = place_day_weather(roles.station_day(spark, d), roles.places(spark, d), 120.0, WEATHER_DEC).select(
        "city", "state", "date", "postal_code_count", "temp_avg", "humidity"
    )
    return join_suffixed(near, wide, ["city", "state", "date"], "_wide")


@register(
    "haversine_km",
    with_roles(
        rounded_sql(
            f"""SELECT s.postal_code, p.city,
                       {haversine('s.lat', 's.lon', 'p.center_lat', 'p.center_lon')} AS distance_km
                FROM stations s JOIN places p ON CAST(s.postal_code AS INTEGER) % 5 = CAST(p.postal_code AS INTEGER)""",
            ["distance_km"],
        ),
        "stations",
        "places",
    ),
)
def q_haversine_km(spark: SparkSession, d: str) -> DataFrame:
    s = stations(roles.station_day(spark, d), "postal_code", "lat", "lon").withColumn(
        "_rk", F.pmod(F.col("postal_code").cast("int"), F.lit(5))
    )
    p = roles.places(spark, d).select("city", "center_lat", "center_lon", F.col("postal_code").cast("int").alias("_rk"))
    j = s.join(bounded_broadcast(p), "_rk")
    return round_doubles(
        j.select("postal_code", "city", haversine_km("lat", "lon", "center_lat", "center_lon").alias("distance_km"))
    )


@register(
    "coverage_left",
    with_roles(
        """SELECT count(*) AS fact_rows,
                  CAST(sum(CASE WHEN c.customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS fact_rows_without_match
           FROM order_amounts o LEFT JOIN (SELECT DISTINCT customer_id FROM resolved_customers) c
             ON o.customer_id = c.customer_id""",
        "order_amounts",
        "resolved_customers",
    ),
)
def q_coverage_left(spark: SparkSession, d: str) -> DataFrame:
    facts = order_amounts(roles.orders_json(spark, d))
    return coverage_left(facts, resolved_customers(spark, d), ["customer_id"])


@register(
    "coverage_full",
    with_roles(
        """SELECT count(*) FILTER (sides = 1) AS left_keys_missing_right, count(*) FILTER (sides = 2) AS right_keys_missing_left,
                  count(*) AS total_distinct_keys_union
           FROM (SELECT bit_or(side) AS sides
                 FROM (SELECT lower(city) AS place, state, date, 1 AS side FROM place_day_sales
                       UNION ALL SELECT lower(city), state, date, 2 FROM place_day_weather)
                 GROUP BY place, state, date)""",
        "place_day_sales",
        "place_day_weather",
    ),
)
def q_coverage_full(spark: SparkSession, d: str) -> DataFrame:
    keys = ["city_key", "state_key", "date"]
    s = place_keys(sales_2024_01(spark, d)).select(*keys)
    w = place_keys(weather_history(spark, d)).select(*keys)
    return coverage_full(s, w, keys)


# --------------------------------------------------------------------------
# 2.4 Aggregations
# --------------------------------------------------------------------------


@register(
    "group_count",
    with_roles("SELECT city, state, count(*) AS customers FROM resolved_customers GROUP BY 1, 2", "resolved_customers"),
)
def q_group_count(spark: SparkSession, d: str) -> DataFrame:
    return resolved_customers(spark, d).groupBy("city", "state").agg(F.count(F.lit(1)).alias("customers"))


@register(
    "count_distinct_grouped",
    with_roles(
        "SELECT day, count(DISTINCT postal_code) AS stations, count(*) AS station_rows FROM station_day GROUP BY 1",
        "station_day",
    ),
)
def q_count_distinct_grouped(spark: SparkSession, d: str) -> DataFrame:
    return (
        roles.station_day(spark, d)
        .groupBy("day")
        .agg(F.count_distinct("postal_code").alias("stations"), F.count(F.lit(1)).alias("station_rows"))
    )


@register(
    "history_bounds",
    with_roles(
        """SELECT postal_code, min(day) AS min_date, max(day) AS max_date, count(*) AS rows, count(DISTINCT day) AS days
           FROM station_day GROUP BY 1""",
        "station_day",
    ),
)
def q_history_bounds(spark: SparkSession, d: str) -> DataFrame:
    return bounds(roles.station_day(spark, d), ["postal_code"], "day")


@register(
    "station_profile",
    with_roles("SELECT postal_code, max(lat) AS latitude, max(lon) AS longitude FROM station_day GROUP BY 1", "station_day"),
)
def q_station_profile(spark: SparkSession, d: str) -> DataFrame:
    return per_key_max(roles.station_day(spark, d), ["postal_code"], {"latitude": "lat", "longitude": "lon"})


DOW_MEASURES = {
    n: Measure(type="decimal(12,4)", digits=4) for n in ("temp_avg", "humidity", "precip_total", "wind_speed", "uv")
}


@register(
    "dow_profile",
    with_roles(
        "SELECT postal_code, dayofweek(day) + 1 AS dow, count(*) AS hist_rows_for_dow, "
        + ", ".join(
            f"CAST(round(CAST(avg(CAST({n} AS DECIMAL(12,4))) AS DECIMAL(38,8)), 4) AS DOUBLE) AS {n}" for n in DOW_MEASURES
        )
        + " FROM station_day GROUP BY 1, 2",
        "station_day",
    ),
)
def q_dow_profile(spark: SparkSession, d: str) -> DataFrame:
    out = dow_profile(roles.station_day(spark, d), ["postal_code"], "day", DOW_MEASURES)
    return out.withColumn("dow", F.col("dow").cast("long"))


@register(
    "order_amounts",
    with_roles(
        """SELECT order_number, customer_id, order_date, CAST(order_sales_amount AS DOUBLE) AS order_sales_amount
           FROM order_amounts""",
        "order_amounts",
    ),
)
def q_order_amounts(spark: SparkSession, d: str) -> DataFrame:
    a = order_amounts(roles.orders_json(spark, d))
    return a.withColumn("order_sales_amount", F.col("order_sales_amount").cast("double"))


@register(
    "enforce_grain",
    with_roles(
        rounded_sql(
            """SELECT upper(trim(city)) AS city_key, upper(trim(state)) AS state_key, CAST(date AS DATE) AS date,
                      sum(CAST(sales_amount AS DOUBLE)) AS sales_amount
               FROM place_day_sales GROUP BY 1, 2, 3""",
            ["sales_amount"],
            4,
        ),
        "place_day_sales",
    ),
)
def q_enforce_grain(spark: SparkSession, d: str) -> DataFrame:
    s = sales_2024_01(spark, d)
    out = enforce_grain(
        s,
        [norm_key("city").alias("city_key"), norm_key("state").alias("state_key"), F.col("date").cast("date").alias("date")],
        {"sales_amount": F.sum(F.col("sales_amount").cast("double"))},
    )
    return round_doubles(out, 4)


@register(
    "null_profile",
    with_roles(
        "SELECT "
        + ", ".join(
            f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_{c}"
            for c in ("temp_avg", "humidity", "precip_total", "wind_speed", "uv")
        )
        + " FROM station_day",
        "station_day",
    ),
)
def q_null_profile(spark: SparkSession, d: str) -> DataFrame:
    return null_profile(roles.station_day(spark, d), ["temp_avg", "humidity", "precip_total", "wind_speed", "uv"])


@register(
    "duplicate_keys",
    with_roles("SELECT customer_id, count(*) AS cnt FROM customer_versions GROUP BY 1 HAVING count(*) > 1", "customer_versions"),
)
def q_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_keys(roles.customer_versions(spark, d), ["customer_id"])


@register(
    "duplicate_surplus",
    with_roles(
        "SELECT count(*) - count(DISTINCT customer_id) AS duplicate_rows FROM customer_versions", "customer_versions"
    ),
)
def q_duplicate_surplus(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_surplus(roles.customer_versions(spark, d), "customer_id")


@register(
    "row_counts",
    with_roles(
        """SELECT 'sales' AS "table", count(*) AS rows FROM place_day_sales
           UNION ALL SELECT 'weather', count(*) FROM place_day_weather
           UNION ALL SELECT 'training', count(*) FROM training""",
        "training",
    ),
)
def q_row_counts(spark: SparkSession, d: str) -> DataFrame:
    s, w = sales_2024_01(spark, d), weather_history(spark, d)
    return row_counts({"sales": s, "weather": w, "training": place_day_training(s, w)})


PROFILE_PATTERNS = {
    "postcode_decimal_suffix": ("postcode", r"\.[0-9]+$"),
    "postcode_zip_plus4": ("postcode", r"^[0-9]{5}-[0-9]{4}$"),
    "postcode_four_digits": ("postcode", r"^[0-9]{4}(\.0)?$"),
}


@register(
    "column_profile",
    with_roles(
        "SELECT count(*) AS rows, "
        + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS {c}_null_or_blank, min({c}) AS {c}_min, max({c}) AS {c}_max"
            for c in ("city", "state", "postcode")
        )
        + ", "
        + ", ".join(f"count(*) FILTER (WHERE regexp_matches({c}, '{rx}')) AS {n}" for n, (c, rx) in PROFILE_PATTERNS.items())
        + ", count(DISTINCT customer_id) AS customer_id_distinct FROM customers_raw",
        "customers_raw",
    ),
)
def q_column_profile(spark: SparkSession, d: str) -> DataFrame:
    return column_profile(roles.customers_raw(spark, d), ["city", "state", "postcode"], PROFILE_PATTERNS, ["customer_id"])


# --------------------------------------------------------------------------
# 2.5 / 2.7 Windows and scalar functions
# --------------------------------------------------------------------------


@register(
    "latest_per_key",
    with_roles("SELECT * FROM latest_customers", "latest_customers"),
)
def q_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return latest_version(roles.customer_versions(spark, d))


@register(
    "norm_place",
    with_roles(
        f"""SELECT customer_id, lower(nullif(trim(city), '')) AS city_norm, upper(nullif(trim(state), '')) AS state_norm,
                   upper(trim(city)) AS city_key, {initcap("lower(nullif(trim(city), ''))")} AS city_title
            FROM customers_raw""",
        "customers_raw",
    ),
)
def q_norm_place(spark: SparkSession, d: str) -> DataFrame:
    c = roles.customers_raw(spark, d)
    return c.select(
        "customer_id",
        norm_text("city", "lower").alias("city_norm"),
        norm_text("state", "upper").alias("state_norm"),
        norm_key("city").alias("city_key"),
        title_place(norm_text("city", "lower")).alias("city_title"),
    )


@register(
    "clean_postcode",
    with_roles(
        f"""SELECT customer_id, postcode, {POSTCODE_CLEAN} AS postcode_clean,
                   {POSTCODE_5} AS postcode_5
            FROM customers_raw""",
        "customers_raw",
    ),
)
def q_clean_postcode(spark: SparkSession, d: str) -> DataFrame:
    c = roles.customers_raw(spark, d)
    return c.select(
        "customer_id",
        "postcode",
        strip_decimal_suffix("postcode").alias("postcode_clean"),
        clean_postcode("postcode").alias("postcode_5"),
    )


@register(
    "epoch_to_day",
    """SELECT o_orderkey AS order_number,
              CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST(epoch(o_orderdate) AS BIGINT) END AS order_datetime,
              CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date
       FROM orders""",
)
def q_epoch_to_day(spark: SparkSession, d: str) -> DataFrame:
    o = roles.orders_json(spark, d)
    return o.select("order_number", "order_datetime", epoch_to_day("order_datetime").alias("order_date"))


@register(
    "remap_month",
    """SELECT o_orderkey AS order_number, CAST(o_orderdate AS DATE) AS order_date,
              make_date(2024, 1, day(o_orderdate)) AS jan_date,
              make_date(2024, 2, least(day(o_orderdate), day(last_day(DATE '2024-02-01')))) AS feb_date
       FROM orders""",
)
def q_remap_month(spark: SparkSession, d: str) -> DataFrame:
    o = roles.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_number"), F.to_date("o_orderdate").alias("order_date")
    )
    return o.select(
        "order_number",
        "order_date",
        remap_month("order_date", 2024, 1).alias("jan_date"),
        remap_month("order_date", 2024, 2, overflow="clamp").alias("feb_date"),
    )


@register(
    "horizon_days",
    with_roles(
        """SELECT postal_code, CAST(unnest(generate_series(anchor, anchor + INTERVAL 9 DAY, INTERVAL 1 DAY)) AS DATE) AS date
           FROM (SELECT postal_code, max(day) + 1 AS anchor FROM station_day GROUP BY 1) a""",
        "station_day",
    ),
)
def q_horizon_days(spark: SparkSession, d: str) -> DataFrame:
    a = roles.station_day(spark, d).groupBy("postal_code").agg(F.date_add(F.max("day"), 1).alias("anchor"))
    return a.select("postal_code", F.explode(horizon("anchor", 10)).alias("date"))


@register(
    "place_day_scaffold",
    with_roles(
        """SELECT postal_code, CAST(unnest(generate_series(DATE '2024-01-31', DATE '2024-02-09', INTERVAL 1 DAY)) AS DATE) AS date
           FROM (SELECT DISTINCT postal_code FROM station_day) s""",
        "station_day",
    ),
)
def q_place_day_scaffold(spark: SparkSession, d: str) -> DataFrame:
    """Every station of the weather table once per horizon day."""
    keys = roles.station_day(spark, d).select("postal_code").distinct()
    return scaffold(keys, roles.HORIZON_ANCHOR, 10)


@register(
    "explode_lines",
    """SELECT l_orderkey AS order_number, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
              CAST(l_quantity AS INTEGER) AS qty, l_discount AS promo_disc
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def q_explode_lines(spark: SparkSession, d: str) -> DataFrame:
    items = explode_lines(roles.orders_json(spark, d), keep=["order_number"])
    return items.select(
        "order_number",
        F.col("item.price").try_cast("decimal(18,2)").cast("double").alias("price"),
        F.col("item.qty").try_cast("int").alias("qty"),
        F.col("item.promotion_info.promo_disc").alias("promo_disc"),
    )


@register(
    "weather_features",
    with_roles(
        rounded_sql(
            """SELECT city, state, date, temp_max, temp_min, precip_total, temp_max - temp_min AS temp_range,
                      CASE WHEN coalesce(precip_total, 0.0) > 0.0 THEN 1 ELSE 0 END AS is_rainy
               FROM place_day_weather""",
            ["temp_range"],
        ),
        "place_day_weather",
    ),
)
def q_weather_features(spark: SparkSession, d: str) -> DataFrame:
    w = weather_features(weather_history(spark, d))
    return round_doubles(w.select("city", "state", "date", "temp_max", "temp_min", "precip_total", "temp_range", "is_rainy"))


# --------------------------------------------------------------------------
# Keyed composites (2.8): spatial, customer repair
# --------------------------------------------------------------------------


@register("nearest_place", with_roles(rounded_sql("SELECT * FROM station_map", ["distance_km"]), "station_map"))
def q_nearest_place(spark: SparkSession, d: str) -> DataFrame:
    pts = stations(roles.station_day(spark, d), "postal_code", "lat", "lon")
    return round_doubles(nearest_place(pts, roles.places(spark, d), 80.0))


@register("place_day_weather", with_roles("SELECT * FROM place_day_weather", "place_day_weather"))
def q_place_day_weather(spark: SparkSession, d: str) -> DataFrame:
    return weather_history(spark, d)


@register("mode_reference", with_roles("SELECT * FROM zip_ref", "zip_ref"))
def q_mode_reference(spark: SparkSession, d: str) -> DataFrame:
    return zip_reference(roles.customer_versions(spark, d))


@register("resolve_places", with_roles("SELECT * FROM resolved_customers", "resolved_customers"))
def q_resolve_places(spark: SparkSession, d: str) -> DataFrame:
    return resolved_customers(spark, d)


@register(
    "repair_funnel",
    with_roles(
        """SELECT count(*) AS customers_scanned,
                  count(*) FILTER (missing) AS customers_missing_city_or_state,
                  count(*) FILTER (missing AND postcode_5 IS NULL) AS missing_city_or_state_without_zip5,
                  count(*) FILTER (repaired) AS customers_repaired_by_postcode,
                  count(*) FILTER (lost) AS customers_still_missing_after_repair,
                  count(*) FILTER (kept) AS customers_retained_target_cities,
                  count(*) FILTER (kept AND repaired) AS retained_customers_repaired
           FROM (SELECT postcode_5, city_norm || state_norm IS NULL AS missing,
                        city_repaired_by_postcode OR state_repaired_by_postcode AS repaired,
                        resolved_city_norm || resolved_state_norm IS NULL AS lost,
                        ifnull((resolved_city_norm, resolved_state_norm) IN (SELECT (target_city_norm, target_state) FROM target_places), false) AS kept
                 FROM resolved_all)""",
        "resolved_all",
        "target_places",
    ),
)
def q_repair_funnel(spark: SparkSession, d: str) -> DataFrame:
    return repair_funnel(roles.customer_versions(spark, d), roles.target_places(spark, d))


@register(
    "place_day_sales",
    with_roles(
        "SELECT city, state, date, CAST(sales_amount AS DOUBLE) AS sales_amount FROM place_day_sales", "place_day_sales"
    ),
)
def q_place_day_sales(spark: SparkSession, d: str) -> DataFrame:
    return sales_2024_01(spark, d).withColumn("sales_amount", F.col("sales_amount").cast("double"))
