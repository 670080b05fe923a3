"""Registered queries: windows, the weekday forecast, report views and model
training/scoring (survey sections 2.5, 2.6, 2.8 and 2.11)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import is_weekend
from ..operators import ml
from ..operators.features import effects_score, lag_feature, place_labels, rolling_prev_mean
from ..operators.measures import Measure, round_doubles
from ..operators.report import place_options
from ..plans.forecast import dow_profile_forecast
from ..plans.job import JobConfig, build_tables, run
from ..plans.report import forecast_report
from ..plans.sales import place_day_sales
from ..plans.training import place_day_training
from ..sources import roles
from ..sources.io import scratch_path, write_metrics, write_table
from .oracle_roles import initcap, spark_round, with_roles
from .registry import register, resolved_customers, rounded_sql, sales_2024_01, weather_history

MEASURES = ("temp_max", "temp_min", "temp_avg", "humidity", "precip_total", "wind_speed", "uv")


def training(spark: SparkSession, d: str) -> DataFrame:
    return place_day_training(sales_2024_01(spark, d), weather_history(spark, d))


def _cut_training(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The training rows and the place-day weather, each computed once and stored: what fits a model reads them many times."""
    weather = ml.reliable_checkpoint(weather_history(spark, d))
    return ml.reliable_checkpoint(place_day_training(sales_2024_01(spark, d), weather)), weather


# --------------------------------------------------------------------------
# 2.5 Windows
# --------------------------------------------------------------------------


@register(
    "lag_feature",
    with_roles(
        """SELECT city, state, date, CAST(sales_amount AS DOUBLE) AS sales_amount,
                  CAST(lag(sales_amount, 1) OVER (PARTITION BY city, state ORDER BY date) AS DOUBLE) AS sales_amount_lag_1
           FROM place_day_sales""",
        "place_day_sales",
    ),
)
def q_lag_feature(spark: SparkSession, d: str) -> DataFrame:
    s = sales_2024_01(spark, d).withColumn("sales_amount", F.col("sales_amount").cast("double"))
    return lag_feature(s, ["city", "state"], "date", "sales_amount", 1)


@register(
    "rolling_prev_mean",
    with_roles(
        rounded_sql(
            """SELECT city, state, date, CAST(sales_amount AS DOUBLE) AS sales_amount,
                      avg(sales_amount) OVER (PARTITION BY city, state ORDER BY date
                                              ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sales_amount_roll7_mean_prev
               FROM place_day_sales""",
            ["sales_amount_roll7_mean_prev"],
            4,
        ),
        "place_day_sales",
    ),
)
def q_rolling_prev_mean(spark: SparkSession, d: str) -> DataFrame:
    # The decimal amounts are averaged exactly, then shown as doubles.
    s = rolling_prev_mean(sales_2024_01(spark, d), ["city", "state"], "date", "sales_amount", 7)
    return round_doubles(
        s.select(
            "city",
            "state",
            "date",
            F.col("sales_amount").cast("double").alias("sales_amount"),
            F.col("sales_amount_roll7_mean_prev").cast("double").alias("sales_amount_roll7_mean_prev"),
        ),
        4,
    )


@register(
    "sales_windows_by_day",
    with_roles(
        rounded_sql(
            """SELECT city, state, date, CAST(sales_amount AS DOUBLE) AS sales_amount,
                      CAST(first(sales_amount) OVER (place ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS DOUBLE) AS sales_amount_lag_1,
                      avg(sales_amount) OVER (place ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sales_amount_roll7_mean_prev
               FROM place_day_sales_by_day WINDOW place AS (PARTITION BY city, state ORDER BY date)""",
            ["sales_amount_roll7_mean_prev"],
            4,
        ),
        "place_day_sales_by_day",
    ),
)
def q_sales_windows_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Lag and rolling mean over every real day of every place: rows grow with the orders' days, not with one month."""
    s = place_day_sales(roles.orders_json(spark, d), resolved_customers(spark, d))
    s = rolling_prev_mean(lag_feature(s, ["city", "state"], "date", "sales_amount", 1), ["city", "state"], "date", "sales_amount", 7)
    double = ["sales_amount", "sales_amount_lag_1", "sales_amount_roll7_mean_prev"]
    return s.select("city", "state", "date", *[(F.round(c, 4) if "roll" in c else F.col(c)).cast("double").alias(c) for c in double])


@register(
    "impute_median_by_station",
    with_roles(
        rounded_sql(
            """SELECT postal_code, day, ifnull(humidity, (SELECT median(humidity) FROM station_day)) AS humidity,
                      ifnull(uv, (SELECT median(uv) FROM station_day)) AS uv FROM station_day""",
            ["humidity", "uv"],
        ),
        "station_day",
    ),
)
def q_impute_median_by_station(spark: SparkSession, d: str) -> DataFrame:
    days = roles.station_day(spark, d).select("postal_code", "day", "humidity", "uv")
    return round_doubles(ml.impute_median(days, ["humidity", "uv"]))


SPLIT_SQL = """SELECT city, state, date,
       CASE WHEN count(*) OVER (PARTITION BY city, state) <= 5
            THEN row_number() OVER (PARTITION BY city, state ORDER BY date DESC) = 1
            ELSE row_number() OVER (PARTITION BY city, state ORDER BY date DESC) <= 5 END AS is_valid
FROM training"""


@register("split_last_days", with_roles(SPLIT_SQL, "training"))
def q_split_last_days(spark: SparkSession, d: str) -> DataFrame:
    return ml.split_last_days(training(spark, d)).select("city", "state", "date", "is_valid")


# --------------------------------------------------------------------------
# 2.8 Weekday-profile forecast
# --------------------------------------------------------------------------

FORECAST_MEASURES = {n: Measure(type="decimal(12,4)") for n in MEASURES}
PROVENANCE = {
    "proxy_source_table": "station_day",
    "proxy_method": "weekday_mean_of_own_history",
    "unit_system": "imperial",
}


def _forecast_sql() -> str:
    """One grouped set per place: its weekdays, and all days together (weekday null)."""
    means = ", ".join(f"avg(CAST({n} AS DECIMAL(12,4))) AS {n}" for n in MEASURES)
    picks = ", ".join(f"{spark_round(f'CAST(ifnull(own.{n}, every.{n}) AS DOUBLE)', 6)} AS {n}" for n in MEASURES)
    consts = ", ".join(f"'{v}' AS {k}" for k, v in PROVENANCE.items())
    return with_roles(
        f"""WITH profile AS (
              SELECT postal_code, isodow(day) AS weekday, count(*) AS days, min(day) AS first_day, max(day) AS last_day,
                     max(lat) AS latitude, max(lon) AS longitude, {means}
              FROM station_day SEMI JOIN places USING (postal_code)
              GROUP BY GROUPING SETS ((postal_code, weekday), (postal_code))),
            ahead AS (SELECT p.*, every.* EXCLUDE (postal_code), unnest(range(DATE '2024-01-31', DATE '2024-02-10', INTERVAL 1 DAY))::DATE AS date
                      FROM places p JOIN profile every ON every.postal_code = p.postal_code AND every.weekday IS NULL)
            SELECT every.postal_code, every.city, every.state, every.date, every.latitude, every.longitude, {picks},
                   ifnull(own.days, 0) AS proxy_hist_rows_for_dow, every.days AS proxy_source_rows_total,
                   every.first_day AS source_data_min_date, every.last_day AS source_data_max_date, {consts}
            FROM ahead every LEFT JOIN profile own ON own.postal_code = every.postal_code AND own.weekday = isodow(every.date)""",
        "places",
        "station_day",
    )


@register("dow_profile_forecast", _forecast_sql())
def q_dow_profile_forecast(spark: SparkSession, d: str) -> DataFrame:
    out = dow_profile_forecast(
        roles.station_day(spark, d),
        roles.places(spark, d).select("postal_code", "city", "state"),
        ["postal_code"],
        FORECAST_MEASURES,
        roles.HORIZON_ANCHOR,
        10,
        date_col="day",
        place_cols=["city", "state"],
        per_key_max={"latitude": "lat", "longitude": "lon"},
        provenance=PROVENANCE,
    )
    return round_doubles(out)


# --------------------------------------------------------------------------
# 2.6 / 2.8 Report views
# --------------------------------------------------------------------------


@register(
    "place_options",
    with_roles("SELECT DISTINCT city, state, city || ', ' || state AS label FROM training", "training"),
)
def q_place_options(spark: SparkSession, d: str) -> DataFrame:
    return place_options(training(spark, d))


REPORT_COLS = ["sales_amount", "temp_avg", "precip_total", "humidity"]


@register(
    "place_report",
    with_roles(
        rounded_sql(
            "SELECT date, sales_amount, temp_avg, precip_total, humidity, uv FROM training "
            "WHERE city = 'Asia' AND state = 'AS'",
            ["sales_amount", "temp_avg", "precip_total", "humidity", "uv"],
            4,
        ),
        "training",
    ),
)
def q_place_report(spark: SparkSession, d: str) -> DataFrame:
    """The report composition (P3): values keyed by place and day joined to
    their weather context, one place, chosen columns plus a context measure
    picked by its label."""
    t = training(spark, d)
    values = t.select("city", "state", "date", "sales_amount")
    context = t.select("city", "state", "date", "temp_avg", "precip_total", "humidity", "uv")
    _, view = forecast_report(values, context, "Asia", "AS", REPORT_COLS, context="UV")
    return round_doubles(view, 4)


# --------------------------------------------------------------------------
# 2.11 Model training and scoring
# --------------------------------------------------------------------------

MEDIAN_COLS = ["sales_amount_lag_1d", "sales_amount_roll7_mean_prev"]


@register(
    "impute_median",
    with_roles(
        rounded_sql(
            """SELECT city, state, date,
                      coalesce(sales_amount_lag_1d, (SELECT median(sales_amount_lag_1d) FROM training)) AS sales_amount_lag_1d,
                      coalesce(sales_amount_roll7_mean_prev, (SELECT median(sales_amount_roll7_mean_prev) FROM training))
                          AS sales_amount_roll7_mean_prev
               FROM training""",
            MEDIAN_COLS,
            4,
        ),
        "training",
    ),
)
def q_impute_median(spark: SparkSession, d: str) -> DataFrame:
    t = _cut_training(spark, d)[0].select("city", "state", "date", *MEDIAN_COLS)
    return round_doubles(ml.impute_median(t, MEDIAN_COLS), 4)


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM customers_raw WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@register(
    "impute_mode",
    with_roles(
        f"""SELECT customer_id, coalesce(city, {_mode_sql('city')}) AS city, coalesce(state, {_mode_sql('state')}) AS state
            FROM customers_raw""",
        "customers_raw",
    ),
)
def q_impute_mode(spark: SparkSession, d: str) -> DataFrame:
    c = roles.customers_raw(spark, d).select("customer_id", "city", "state")
    return ml.impute_mode(c, ["city", "state"])


SCALE_COLS = ["temp_avg", "humidity", "precip_total", "uv", "wind_speed"]


def _filled(cols: list[str], table: str) -> str:
    """The table with nulls of the columns replaced by their medians."""
    return f"SELECT * REPLACE ({', '.join(f'ifnull({c}, (SELECT median({c}) FROM {table})) AS {c}' for c in cols)}) FROM {table}"


@register(
    "scale_features",
    with_roles(
        rounded_sql(
            f"WITH t AS ({_filled(SCALE_COLS, 'training')}) SELECT city, state, date, "
            + ", ".join(f"{c} / stddev_samp({c}) OVER () AS {c}_scaled" for c in SCALE_COLS)
            + " FROM t",
            [f"{c}_scaled" for c in SCALE_COLS],
        ),
        "training",
    ),
)
def q_scale_features(spark: SparkSession, d: str) -> DataFrame:
    """The model's own numeric stages: median imputation, then scaling, over every row."""
    t = _cut_training(spark, d)[0]
    out = Pipeline(stages=ml.feature_stages(SCALE_COLS, [])).fit(t).transform(t).withColumn("_a", vector_to_array("features"))
    return round_doubles(
        out.select("city", "state", "date", *[F.col("_a")[i].alias(f"{c}_scaled") for i, c in enumerate(SCALE_COLS)])
    )


@register(
    "fit_linear",
    with_roles(
        rounded_sql(
            f"""WITH t AS ({_filled(["temp_avg", "uv", "humidity"], "station_day")}),
                    s AS (SELECT avg(temp_avg) AS m1, avg(uv) AS m2, avg(humidity) AS my,
                                 covar_pop(temp_avg, temp_avg) AS s11, covar_pop(uv, uv) AS s22, covar_pop(temp_avg, uv) AS s12,
                                 covar_pop(humidity, temp_avg) AS s1y, covar_pop(humidity, uv) AS s2y FROM t),
                    c AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s)
               SELECT postal_code, day, c.my + c.b1 * (t.temp_avg - c.m1) + c.b2 * (t.uv - c.m2) AS prediction FROM t, c""",
            ["prediction"],
            4,
        ),
        "station_day",
    ),
)
def q_fit_linear(spark: SparkSession, d: str) -> DataFrame:
    """The candidate's least squares on two imputed and scaled features, every row in; the oracle solves the normal equations."""
    t = ml.impute_median(roles.station_day(spark, d).select("postal_code", "day", "temp_avg", "uv", "humidity"), ["humidity"])
    est = dict(ml.candidates("humidity"))["linear_regression"]
    model = ml.build_model(est, ml.feature_stages(["temp_avg", "uv"], [])).fit(t)
    return round_doubles(model.transform(t).select("postal_code", "day", "prediction"), 4)


def _naive_metrics_sql(keys: str = "city, state") -> str:
    return with_roles(
        f"""SELECT {keys}, count(*) AS rows,
                   {spark_round('avg(abs(sales_amount - sales_amount_roll7_mean_prev))', 2)} AS mae,
                   {spark_round('1.0 - sum((sales_amount - sales_amount_roll7_mean_prev) * (sales_amount - sales_amount_roll7_mean_prev)) / nullif(var_pop(sales_amount) * count(sales_amount), 0.0)', 6)} AS r2
            FROM training WHERE sales_amount_roll7_mean_prev IS NOT NULL GROUP BY {keys}""",
        "training",
    )


def _naive_metrics(spark: SparkSession, d: str) -> DataFrame:
    t = training(spark, d).where(F.col("sales_amount_roll7_mean_prev").isNotNull())
    m = ml.regression_metrics(t, "sales_amount", "sales_amount_roll7_mean_prev", keys=["city", "state"])
    return m.select("city", "state", "rows", F.round("mae", 2).alias("mae"), F.round("r2", 6).alias("r2"))


@register("regression_metrics", _naive_metrics_sql())
def q_regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _naive_metrics(spark, d)


METRICS_SCHEMA = "city string, state string, rows long, mae double, r2 double"


@register("metrics_round_trip", _naive_metrics_sql())
def q_metrics_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    write_metrics(_naive_metrics(spark, d), path)
    return spark.read.schema(METRICS_SCHEMA).json(path)


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = ml.split_last_days(_cut_training(spark, d)[0])
    train = t.where(~F.col("is_valid")).drop("is_valid")
    valid = t.where(F.col("is_valid")).drop("is_valid")
    return ml.reliable_checkpoint(train), ml.reliable_checkpoint(valid)


def _stages(t: DataFrame) -> list:
    return ml.feature_stages([c for c in ml.FEATURE_COLUMNS if c in t.columns])


# The leading 32 bits of the md5, from its hex digits.
_MD5_32 = " + ".join(f"(instr('0123456789abcdef', substr(h, {i + 1}, 1)) - 1) * {16 ** (7 - i)}" for i in range(8))


@register(
    "split_hash",
    with_roles(
        f"""SELECT city, state, date, ({_MD5_32}) % 10000 < 8000 AS is_train
            FROM (SELECT *, md5(concat_ws('|', city, state, CAST(date AS VARCHAR), '42')) AS h FROM training)""",
        "training",
    ),
)
def q_split_hash(spark: SparkSession, d: str) -> DataFrame:
    return ml.split_hash(training(spark, d), ["city", "state", "date"]).select("city", "state", "date", "is_train")


@register(
    "one_hot",
    with_roles(
        """WITH t AS (SELECT DISTINCT city, state FROM training),
                w AS (SELECT DISTINCT city, state FROM place_day_weather),
                both_ AS (SELECT city, state FROM t UNION ALL SELECT city, state FROM w)
           SELECT city, state,
                  CAST((CASE WHEN city IN (SELECT city FROM t) THEN 1 ELSE 0 END)
                     + (CASE WHEN state IN (SELECT state FROM t) THEN 1 ELSE 0 END) AS DOUBLE) AS ones
           FROM both_""",
        "training",
    ),
)
def q_one_hot(spark: SparkSession, d: str) -> DataFrame:
    """Indexers fitted on the training places; the upper-case weather place
    names are unseen and encode to all zeros."""

    t, weather = _cut_training(spark, d)
    stages = ml.feature_stages([], ["city", "state"], features_col="onehot")
    model = Pipeline(stages=stages).fit(t)
    w = weather.select("city", "state").distinct()
    both = t.select("city", "state").distinct().unionByName(w)
    out = model.transform(both).withColumn("_a", vector_to_array("onehot"))
    return out.select("city", "state", F.aggregate("_a", F.lit(0.0), lambda acc, x: acc + x).alias("ones"))


# Tree models are checked by facts that SQL can state: whole output, no null
# predictions, forest means inside the training targets' range.
_VALID_SQL = SPLIT_SQL.replace("SELECT city, state, date,", "SELECT *,")


def _fit_facts(spark: SparkSession, d: str, name: str) -> DataFrame:
    train, valid = _split(spark, d)
    est = dict(ml.candidates())[name]
    p = ml.build_model(est, _stages(train)).fit(train).transform(valid).select("sales_amount", "prediction")
    span = train.agg(F.min("sales_amount").alias("lo"), F.max("sales_amount").alias("hi")).first()
    outside = (F.col("prediction") < span["lo"]) | (F.col("prediction") > span["hi"])
    return p.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("prediction").isNull()).alias("null_predictions"),
        F.count_if(outside if name == "random_forest" else F.isnan("prediction")).alias("bad_predictions"),
    )


_FIT_FACTS_SQL = with_roles(
    f"SELECT count(*) AS rows, CAST(0 AS BIGINT) AS null_predictions, CAST(0 AS BIGINT) AS bad_predictions FROM ({_VALID_SQL}) WHERE is_valid", "training"
)


@register("fit_forest", _FIT_FACTS_SQL)
def q_fit_forest(spark: SparkSession, d: str) -> DataFrame:
    return _fit_facts(spark, d, "random_forest")


@register("fit_boosted", _FIT_FACTS_SQL)
def q_fit_boosted(spark: SparkSession, d: str) -> DataFrame:
    return _fit_facts(spark, d, "gradient_boosting")


# Days of the fact have few values here, so SQL can name every split a tree may choose.
_DAY_FLAGS = """SELECT postal_code, day, humidity, CAST(isodow(day) >= 6 AS DOUBLE) AS weekend, CAST(day(day) > 15 AS DOUBLE) AS late,
                       CAST(postal_code < '00300' AS DOUBLE) AS low_code
                FROM station_day WHERE humidity IS NOT NULL"""
DAY_FLAGS = ["weekend", "late", "low_code"]


def _day_flags(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("day")
    t = roles.station_day(spark, d).where("humidity IS NOT NULL").select(
        "postal_code",
        "day",
        "humidity",
        is_weekend(day).cast("double").alias("weekend"),
        (F.dayofmonth(day) > 15).cast("double").alias("late"),
        (F.col("postal_code") < "00300").cast("double").alias("low_code"),
    )
    return ml.reliable_checkpoint(t)


@register(
    "forest_group_means",
    with_roles(
        rounded_sql(
            f"SELECT postal_code, day, avg(humidity) OVER (PARTITION BY weekend, late, low_code) AS prediction, CAST(0.0 AS DOUBLE) AS apart FROM ({_DAY_FLAGS})",
            ["prediction"],
            4,
        ),
        "station_day",
    ),
)
def q_forest_group_means(spark: SparkSession, d: str) -> DataFrame:
    """The forest candidate with one tree on all rows and three flags: fully grown, it predicts the mean of each
    combination. ``apart``: distance of the scorer over the saved node table from the model's own predictions."""
    t = _day_flags(spark, d)
    est = dict(ml.candidates("humidity", forest_trees=1))["random_forest"].setBootstrap(False)
    pre = VectorAssembler(inputCols=DAY_FLAGS, outputCol="features")
    model = est.fit(pre.transform(t))
    path = scratch_path(spark, "forest")
    model.write().save(path)
    scored = model.transform(pre.transform(t)).withColumn("from_nodes", ml.score_nodes(ml.node_table(spark, path), DAY_FLAGS))
    return round_doubles(scored.select("postal_code", "day", "prediction", F.abs(F.col("prediction") - F.col("from_nodes")).alias("apart")), 4)


@register(
    "boosted_stump",
    with_roles(
        rounded_sql(
            f"""WITH t AS ({_DAY_FLAGS}),
                    every AS (SELECT 1 AS i, 'weekend' AS flag, weekend AS side, humidity FROM t UNION ALL
                              SELECT 2, 'late', late, humidity FROM t UNION ALL SELECT 3, 'low_code', low_code, humidity FROM t),
                    sides AS (SELECT i, flag, side, avg(humidity) AS mean, sum(humidity) * sum(humidity) / count(*) AS gain FROM every GROUP BY ALL),
                    best AS (SELECT i, flag FROM sides GROUP BY i, flag ORDER BY round(sum(gain), 6) DESC, i LIMIT 1)
               SELECT t.postal_code, t.day, s.mean AS prediction FROM t, best b JOIN sides s ON s.flag = b.flag
               WHERE s.side = CASE b.flag WHEN 'weekend' THEN t.weekend WHEN 'late' THEN t.late ELSE t.low_code END""",
            ["prediction"],
            4,
        ),
        "station_day",
    ),
)
def q_boosted_stump(spark: SparkSession, d: str) -> DataFrame:
    """The boosting candidate cut to one round and one split: it takes the flag that explains most and predicts its sides' means."""
    t = _day_flags(spark, d)
    est = dict(ml.candidates("humidity", boost_iters=1))["gradient_boosting"].setMaxDepth(1)
    v = VectorAssembler(inputCols=DAY_FLAGS, outputCol="features").transform(t)
    return round_doubles(est.fit(v).transform(v).select("postal_code", "day", "prediction"), 4)


@register(
    "select_best",
    with_roles(
        f"""SELECT CAST(3 AS BIGINT) AS models, CAST(1 AS BIGINT) AS selected, CAST(0 AS BIGINT) AS better_than_selected,
                   count(*) FILTER (NOT is_valid) AS train_rows, count(*) FILTER (is_valid) AS valid_rows FROM ({_VALID_SQL})""",
        "training",
    ),
)
def q_select_best(spark: SparkSession, d: str) -> DataFrame:
    train, valid = _split(spark, d)
    m = ml.select_best(train, valid, ml.candidates(), _stages(train)).metrics
    best = m.where("selected").select(F.col("mae").alias("best_mae"))
    return m.join(F.broadcast(best)).agg(
        F.count(F.lit(1)).alias("models"),
        F.count_if("selected").alias("selected"),
        F.count_if(F.col("mae") < F.col("best_mae")).alias("better_than_selected"),
        F.max("train_rows").alias("train_rows"),
        F.max("valid_rows").alias("valid_rows"),
    )


@register(
    "model_round_trip",
    with_roles(f"SELECT count(*) AS rows, CAST(0 AS BIGINT) AS rows_that_differ FROM ({_VALID_SQL}) WHERE is_valid", "training"),
)
def q_model_round_trip(spark: SparkSession, d: str) -> DataFrame:
    train, valid = _split(spark, d)
    model = ml.build_model(dict(ml.candidates())["linear_regression"], _stages(train)).fit(train)
    path = scratch_path(spark, "model")
    ml.save_model(model, path)
    keys = ["city", "state", "date"]
    again = ml.load_model(path).transform(valid).select(*keys, F.col("prediction").alias("again"))
    both = model.transform(valid).select(*keys, "prediction").join(again, keys)
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("prediction").eqNullSafe(F.col("again"))).alias("rows_that_differ"))


def _horizon(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = build_tables(spark, JobConfig(sf_dir=d))
    return ml.reliable_checkpoint(t["training"]), ml.reliable_checkpoint(t["horizon"])


@register(
    "horizon_known_places",
    with_roles(
        """SELECT count(*) * 10 AS horizon_rows, count(*) FILTER (NOT EXISTS (
                      SELECT 1 FROM training t WHERE lower(t.city) = lower(w.city) AND t.state = w.state)) * 10 AS rows_of_unknown_places
           FROM (SELECT DISTINCT city, state FROM place_day_weather) w""",
        "training",
    ),
)
def q_horizon_known_places(spark: SparkSession, d: str) -> DataFrame:
    """The place features that the model gets for the horizon: one city and one state each."""
    t, horizon = _horizon(spark, d)
    model = Pipeline(stages=ml.feature_stages([], ["city", "state"], features_col="onehot")).fit(t)
    ones = F.aggregate(vector_to_array("onehot"), F.lit(0.0), lambda acc, x: acc + x)
    return model.transform(horizon).agg(F.count(F.lit(1)).alias("horizon_rows"), F.count_if(ones != 2.0).alias("rows_of_unknown_places"))


@register(
    "score_forecast",
    with_roles(
        rounded_sql(
            f"""WITH line AS (SELECT regr_slope(sales_amount, temp_avg) AS slope, regr_intercept(sales_amount, temp_avg) AS base FROM training),
                     means AS (SELECT city, state, isodow(date) AS weekday, CAST(avg(CAST(temp_avg AS DECIMAL(12,4))) AS DOUBLE) AS temp_avg FROM place_day_weather
                               GROUP BY GROUPING SETS ((city, state, weekday), (city, state))),
                     ahead AS (SELECT city, state, temp_avg AS overall, unnest(range(DATE '2024-01-31', DATE '2024-02-10', INTERVAL 1 DAY))::DATE AS date
                               FROM means WHERE weekday IS NULL)
                SELECT {initcap('a.city')} AS city, a.state, a.date, ifnull(m.temp_avg, a.overall) AS temp_avg,
                       line.base + line.slope * ifnull(m.temp_avg, a.overall) AS sales_amount_pred
                FROM ahead a CROSS JOIN line LEFT JOIN means m ON m.city = a.city AND m.state = a.state AND m.weekday = isodow(a.date)""",
            ["temp_avg", "sales_amount_pred"],
            2,
        ),
        "training",
    ),
)
def q_score_forecast(spark: SparkSession, d: str) -> DataFrame:
    t, weather = _cut_training(spark, d)
    places = weather.select("city", "state").distinct()
    ahead = place_labels(dow_profile_forecast(weather, places, ["city", "state"], {"temp_avg": Measure(type="decimal(12,4)")}, roles.HORIZON_ANCHOR, 10, date_col="date"))
    ahead = ahead.withColumn("temp_avg", F.col("temp_avg").cast("double"))
    fit_on = t.where("temp_avg IS NOT NULL")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["temp_avg"], outputCol="features"), LinearRegression(labelCol="sales_amount", regParam=0.0, solver="normal")])
    return round_doubles(ml.score_forecast(pipe.fit(fit_on), ahead, features=["temp_avg"]), 2)


@register(
    "end_to_end_forecast",
    with_roles(
        """SELECT count(*) * 10 AS rows, CAST(0 AS BIGINT) AS null_predictions, CAST(1 AS BIGINT) AS models, count(*) AS places
           FROM (SELECT DISTINCT city, state FROM place_day_weather)""",
        "place_day_weather",
    ),
)
def q_end_to_end_forecast(spark: SparkSession, d: str) -> DataFrame:
    out = run(spark, JobConfig(sf_dir=d))["forecast"]
    return out.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("sales_amount_pred").isNull()).alias("null_predictions"),
        F.count_distinct("model_name").alias("models"),
        F.count_distinct("city", "state").alias("places"),
    )


# The model on its training days: one slope over all places and a level for each, which is what least squares on the
# temperature and the places' indicators comes to.
_JOB_SQL = with_roles(
    f"""WITH split AS ({SPLIT_SQL.replace("SELECT city, state, date,", "SELECT city, state, date, sales_amount, temp_avg,")}),
            filled AS (SELECT * REPLACE (ifnull(temp_avg, (SELECT median(temp_avg) FROM split WHERE NOT is_valid)) AS temp_avg) FROM split WHERE NOT is_valid),
            fit AS (SELECT *, avg(sales_amount) OVER place AS level, avg(temp_avg) OVER place AS usual
                    FROM filled WINDOW place AS (PARTITION BY city, state)),
            slope AS (SELECT sum((temp_avg - usual) * (sales_amount - level)) / sum((temp_avg - usual) * (temp_avg - usual)) AS b FROM fit),
            known AS (SELECT city, state, min(level) AS level, min(usual) AS usual FROM fit GROUP BY city, state),
            ahead AS (SELECT city, state, unnest(range(DATE '2024-01-31', DATE '2024-02-10', INTERVAL 1 DAY))::DATE AS date FROM known)
       SELECT a.city, a.state, a.date, {spark_round("(k.level + s.b * (10.0 * (isodow(a.date) % 7 + 1) - k.usual)) / 10000", 0)} AS pred_10k,
              'linear_regression' AS model_name
       FROM ahead a JOIN known k ON k.city = a.city AND k.state = a.state CROSS JOIN slope s""",
    "training",
)


@register("job_forecast", _JOB_SQL)
def q_job_forecast(spark: SparkSession, d: str) -> DataFrame:
    """The job on ready frames, read back from the table that it wrote: every forecast number is checked, in
    ten-thousands (city and state say the same, so the solver iterates and the last digits are its own)."""
    base, db = scratch_path(spark, "job"), "geodemand_checks"
    t = _cut_training(spark, d)[0].select("city", "state", "date", "temp_avg", "sales_amount")
    days = F.explode(F.sequence(F.lit(roles.HORIZON_ANCHOR), F.date_add(F.lit(roles.HORIZON_ANCHOR), 9))).alias("date")
    ahead = t.select("city", "state").distinct().select("city", "state", days).withColumn("temp_avg", 10.0 * F.dayofweek("date"))
    for name, df in (("job_training", t), ("job_horizon", ahead)):
        write_table(df, f"{db}.{name}", path=f"{base}/{name}", schema_location=f"{base}/db")
    cfg = JobConfig(inputs={"training": f"{db}.job_training", "horizon": f"{db}.job_horizon"}, models=["linear_regression"], forecast_table=f"{db}.job_forecast")
    run(spark, cfg)
    out = spark.table(cfg.forecast_table)
    return out.select("city", "state", "date", F.round(F.col("sales_amount_pred") / 10000, 0).alias("pred_10k"), "model_name")


@register(
    "train_demo",
    f"""SELECT count(*) FILTER (({_MD5_32}) % 10000 < 8000) AS train_rows, count(*) FILTER (({_MD5_32}) % 10000 >= 8000) AS test_rows,
               true AS scored
        FROM (SELECT DISTINCT md5(concat_ws('|', CAST(CAST(ts AS DATE) AS VARCHAR), '42')) AS h FROM events)""",
)
def q_train_demo(spark: SparkSession, d: str) -> DataFrame:
    days = effects_score(roles.demo_day(spark, d), name=ml.DEMO_TARGET)
    _, metrics = ml.train_demo(days)
    return metrics.select("train_rows", "test_rows", (F.col("mae") >= 0).alias("scored"))
