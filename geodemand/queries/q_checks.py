"""Registered QA checks on the composite outputs: the checks the reference
runs after each of its steps (spans, grain, per-place counts, null counts,
repair summary), expressed with the library's quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import between_dates
from ..functions.logic import flag_sum
from ..functions.text import place_label, split_label
from ..operators.measures import Measure, bounds, mean_measures, round_doubles
from ..operators.quality import duplicate_keys, null_profile
from ..plans.forecast import dow_profile_forecast
from ..sources import roles
from ..sources.io import read_source, scratch_path, write_csv, write_table
from .oracle_roles import with_roles
from .q_model import FORECAST_MEASURES, PROVENANCE
from .registry import register, resolved_customers, rounded_sql, sales_2024_01, weather_history


@register(
    "qa_sales_span",
    with_roles(
        """SELECT min(date) AS min_date, max(date) AS max_date, count(*) AS rows, count(DISTINCT date) AS days
           FROM place_day_sales""",
        "place_day_sales",
    ),
)
def q_qa_sales_span(spark: SparkSession, d: str) -> DataFrame:
    """Re-dated sales span one month: first and last day, distinct days."""
    return bounds(sales_2024_01(spark, d), [], "date")


@register(
    "qa_sales_grain",
    with_roles(
        "SELECT city, state, date, count(*) AS cnt FROM place_day_sales GROUP BY 1, 2, 3 HAVING count(*) > 1",
        "place_day_sales",
    ),
)
def q_qa_sales_grain(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the place-day sales that occur more than once (expected: none)."""
    return duplicate_keys(sales_2024_01(spark, d), ["city", "state", "date"])


@register(
    "qa_weather_per_place",
    with_roles(
        """SELECT city, state, count(*) AS day_rows, min(date) AS min_date, max(date) AS max_date
           FROM place_day_weather GROUP BY 1, 2""",
        "place_day_weather",
    ),
)
def q_qa_weather_per_place(spark: SparkSession, d: str) -> DataFrame:
    """Days of weather per place and their span."""
    return bounds(weather_history(spark, d), ["city", "state"], "date", rows_name="day_rows", days_name=None)


@register(
    "qa_weather_nulls",
    with_roles(
        "SELECT "
        + ", ".join(
            f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_{c}"
            for c in ("temp_avg", "precip_total", "wind_speed", "humidity")
        )
        + " FROM place_day_weather",
        "place_day_weather",
    ),
)
def q_qa_weather_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Null counts of the core place-day weather measures."""
    return null_profile(weather_history(spark, d), ["temp_avg", "precip_total", "wind_speed", "humidity"])


@register(
    "qa_resolved_repair",
    with_roles(
        """SELECT count(*) AS retained_customers,
                  CAST(sum(CASE WHEN city_repaired_by_postcode OR state_repaired_by_postcode THEN 1 ELSE 0 END) AS BIGINT)
                      AS retained_customers_repaired,
                  CAST(sum(CASE WHEN city_repaired_by_postcode THEN 1 ELSE 0 END) AS BIGINT) AS retained_city_repaired,
                  CAST(sum(CASE WHEN state_repaired_by_postcode THEN 1 ELSE 0 END) AS BIGINT) AS retained_state_repaired
           FROM resolved_customers""",
        "resolved_customers",
    ),
)
def q_qa_resolved_repair(spark: SparkSession, d: str) -> DataFrame:
    """Repairs among the customers kept in the target places."""
    city, state = F.col("city_repaired_by_postcode"), F.col("state_repaired_by_postcode")
    return resolved_customers(spark, d).agg(
        F.count(F.lit(1)).alias("retained_customers"),
        flag_sum(city | state).alias("retained_customers_repaired"),
        flag_sum(city).alias("retained_city_repaired"),
        flag_sum(state).alias("retained_state_repaired"),
    )


@register(
    "qa_forecast_span",
    with_roles(
        """SELECT p.city, p.state, count(*) AS rows, min(f.d) AS min_date, max(f.d) AS max_date, count(DISTINCT f.d) AS days
           FROM places p JOIN (SELECT DISTINCT postal_code FROM station_day) s ON s.postal_code = p.postal_code
           CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '2024-01-31', DATE '2024-02-09', INTERVAL 1 DAY)) AS DATE) AS d) f
           GROUP BY 1, 2""",
        "places",
        "station_day",
    ),
)
def q_qa_forecast_span(spark: SparkSession, d: str) -> DataFrame:
    """Horizon rows per place of the weekday forecast, and their span."""
    f = dow_profile_forecast(
        roles.station_day(spark, d),
        roles.places(spark, d).select("postal_code", "city", "state"),
        ["postal_code"],
        FORECAST_MEASURES,
        roles.HORIZON_ANCHOR,
        10,
        place_cols=["city", "state"],
        provenance=PROVENANCE,
    )
    return bounds(f, ["city", "state"], "date")


@register(
    "pick_source",
    """SELECT 'table' AS source, r_name AS name FROM region WHERE r_regionkey < 3
       UNION ALL SELECT 'files', r_name FROM region
       UNION ALL SELECT 'missing', unnest(['absent_one', 'absent_two'])""",
)
def q_pick_source(spark: SparkSession, d: str) -> DataFrame:
    """The table where there is one, else the files; without either, every missing path by name."""
    region = roles.table(spark, d, "region").select("r_regionkey", "r_name")
    base = scratch_path(spark, "pick")
    write_csv(region, f"{base}/files")
    write_table(region.where("r_regionkey < 3"), "geodemand_checks.picked", path=f"{base}/table", schema_location=f"{base}/db")
    pick = lambda table: read_source(spark, f"geodemand_checks.{table}", f"{base}/files", region.schema)
    try:
        read_source(spark, path=[f"{base}/files", f"{base}/absent_one", f"{base}/absent_two"], schema=region.schema)
        missing = []
    except FileNotFoundError as e:
        missing = [(line.rsplit("/", 1)[-1],) for line in str(e).splitlines() if line.startswith("- ")]
    of = lambda df, source: df.select(F.lit(source).alias("source"), F.col("r_name").alias("name"))
    named = spark.createDataFrame(missing, "r_name string")
    return of(pick("picked"), "table").unionByName(of(pick("no_such_table"), "files")).unionByName(of(named, "missing"))


@register(
    "station_means",
    with_roles(
        rounded_sql(
            """SELECT postal_code, count(DISTINCT day) AS days, count(*) AS day_rows, avg(CAST(temp_avg AS DECIMAL(12,4))) AS temp_avg,
                      avg(CAST(humidity AS DECIMAL(12,4))) AS humidity
               FROM station_day WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-24' GROUP BY postal_code""",
            ["temp_avg", "humidity"],
        ),
        "station_day",
    ),
)
def q_station_means(spark: SparkSession, d: str) -> DataFrame:
    """Per-station means over an inclusive range of days."""
    days = roles.station_day(spark, d).where(between_dates("day", "2024-01-05", "2024-01-24"))
    spec = {n: Measure(type="decimal(12,4)") for n in ("temp_avg", "humidity")}
    return round_doubles(mean_measures(days, ["postal_code"], spec, distinct_counts={"days": "day"}, row_count="day_rows"))


@register(
    "label_parts",
    with_roles(
        "SELECT DISTINCT city || ', ' || state AS label, city, state FROM resolved_customers WHERE city IS NOT NULL AND state IS NOT NULL", "resolved_customers"
    ),
)
def q_label_parts(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the resolved places, taken apart again."""
    labels = resolved_customers(spark, d).select(place_label("city", "state").alias("label")).distinct()
    city, state = split_label("label")
    return labels.select("label", city.alias("city"), state.alias("state"))
