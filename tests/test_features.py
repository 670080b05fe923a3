import datetime as dt

from geodemand.operators.features import effects_score, lag_feature, rolling_prev_mean, weather_features


def test_lag_and_rolling_count_rows_not_days(spark):
    rows = [("A", dt.date(2024, 1, 1), 1.0), ("A", dt.date(2024, 1, 5), 3.0), ("A", dt.date(2024, 1, 6), 5.0)]
    df = spark.createDataFrame(rows, "p string, d date, v double")
    out = rolling_prev_mean(lag_feature(df, ["p"], "d", "v", 1, "lag"), ["p"], "d", "v", 7, "roll").orderBy("d").collect()
    assert [r.lag for r in out] == [None, 1.0, 3.0]
    assert [r.roll for r in out] == [None, 1.0, 2.0]


def test_rolling_window_is_seven_previous_rows(spark):
    rows = [("A", dt.date(2024, 1, i), float(i)) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "p string, d date, v double")
    last = rolling_prev_mean(df, ["p"], "d", "v", 7, "roll").orderBy("d").collect()[-1]
    assert last.roll == sum(range(3, 10)) / 7  # the 7 rows before day 10 are days 3..9


def test_weather_features_rain_first(spark):
    rows = [(10.0, 4.0, 0.0, 0.5), (9.0, 1.0, None, 0.2), (8.0, 2.0, None, None)]
    df = spark.createDataFrame(rows, "temp_max double, temp_min double, rain double, precip_total double")
    out = weather_features(df).collect()
    assert [r.temp_range for r in out] == [6.0, 8.0, 6.0]
    assert [r.is_rainy for r in out] == [0, 1, 0]


def test_effects_score_floor(spark):
    row = ("summer", 0.0, 21.0, 0, 0, 0, 50.0, 10.0)
    df = spark.createDataFrame([row], "season string, precipitation_mm double, temperature_c double, is_weekend int, is_holiday int, discount_pct int, humidity_pct double, wind_speed_kmh double")
    s = effects_score(df).first().score
    assert abs(s - (185 + 26 + 6 + 38 - 50 * 0.22 - 10 * 0.35)) < 1e-9


def test_calendar_variants(spark):
    rows = [("A", dt.date(2024, 1, 1), 1.0), ("A", dt.date(2024, 1, 5), 3.0), ("A", dt.date(2024, 1, 6), 5.0)]
    df = spark.createDataFrame(rows, "p string, d date, v double")
    out = rolling_prev_mean(lag_feature(df, ["p"], "d", "v", 1, "lag", calendar=True), ["p"], "d", "v", 4, "roll", calendar=True)
    got = [(r.lag, r.roll) for r in out.orderBy("d").collect()]
    # 01-05: the day before (01-04) is missing; the 4 previous days 01-01..01-04 hold 1.0
    assert got == [(None, None), (None, 1.0), (3.0, 3.0)]


# One place's rows of a saved training table (date, sales,
# expected previous-row lag, expected mean of up to 7 previous rows, weekend).
GOLDEN_PLACE_ROWS = [
    ("2022-01-01", 6224.0, None, None, 1),
    ("2022-01-18", 3601.0, 6224.0, 6224.0, 0),
    ("2022-01-19", 5032.0, 3601.0, 4912.5, 0),
    ("2022-01-22", 3321.0, 5032.0, 4952.333333333333, 1),
    ("2022-01-28", 171.69, 3321.0, 4544.5, 0),
]


def test_training_features_golden(spark):
    from geodemand.plans.training import place_day_training

    sales = spark.createDataFrame(
        [("portland", "or", dt.date.fromisoformat(d), s) for d, s, *_ in GOLDEN_PLACE_ROWS],
        "city string, state string, date date, sales_amount double",
    )
    weather = spark.createDataFrame(
        [("PORTLAND", "OR", dt.date.fromisoformat(d), 50.0, 40.0) for d, *_ in GOLDEN_PLACE_ROWS],
        "city string, state string, date date, temp_max double, temp_min double",
    )
    out = {str(r.date): r for r in place_day_training(sales, weather).collect()}
    for d, s, lag, roll, weekend in GOLDEN_PLACE_ROWS:
        r = out[d]
        assert (r.city, r.state, r.sales_amount, r.sales_amount_lag_1d, r.is_weekend) == ("Portland", "OR", s, lag, weekend)
        assert (r.sales_amount_roll7_mean_prev is None and roll is None) or abs(r.sales_amount_roll7_mean_prev - roll) < 1e-9
