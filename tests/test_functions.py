import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geodemand.functions import (
    clean_postcode,
    epoch_day_range,
    epoch_to_day,
    haversine_km,
    horizon,
    is_weekend,
    norm_text,
    place_label,
    remap_month,
    season,
    split_label,
    strip_decimal_suffix,
    title_place,
)


def test_clean_postcode_cases(spark):
    raw = ["90012.0", " 2139.0", "12345-6789", "123456", "abc", "123", None, "", "60601.00"]
    want = ["90012", "02139", "12345", "12345", None, None, None, None, "60601"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, p string")
    got = [r[0] for r in df.orderBy("i").select(clean_postcode("p")).collect()]
    assert got == want


def test_strip_suffix_only_one_dot_zero(spark):
    df = spark.createDataFrame([("60601.00",), ("90012.0",)], "p string")
    assert [r[0] for r in df.select(strip_decimal_suffix("p")).collect()] == ["60601.00", "90012"]


def test_norm_and_title(spark):
    df = spark.createDataFrame([("  los angeles ",), ("   ",), (None,), ("MIDDLE EAST",)], "c string")
    rows = df.select(norm_text("c", "lower").alias("l"), norm_text("c", "upper").alias("u"), title_place("c").alias("t")).collect()
    assert [r.l for r in rows] == ["los angeles", None, None, "middle east"]
    assert [r.u for r in rows] == ["LOS ANGELES", None, None, "MIDDLE EAST"]
    assert rows[3].t == "Middle East"


def test_label_round_trip(spark):
    df = spark.createDataFrame([("Los Angeles", "CA")], "city string, state string")
    lab = df.select(place_label("city", "state").alias("l"))
    c, s = split_label("l")
    r = lab.select(c.alias("c"), s.alias("s"), "l").first()
    assert (r.l, r.c, r.s) == ("Los Angeles, CA", "Los Angeles", "CA")


def test_remap_month_error_and_clamp(spark):
    df = spark.createDataFrame([(dt.date(2019, 10, 31),)], "d date")
    assert df.select(remap_month("d", 2022, 1)).first()[0] == dt.date(2022, 1, 31)
    assert df.select(remap_month("d", 2024, 2, "clamp")).first()[0] == dt.date(2024, 2, 29)
    with pytest.raises(PySparkException):
        df.select(remap_month("d", 2023, 2)).collect()


def test_epoch_day_range_matches_derived_day(spark):
    secs = [1569888000 - 1, 1569888000, 1572566399, 1572566400]  # around 2019-10-01 .. 2019-10-31 UTC
    df = spark.createDataFrame([(s,) for s in secs], "s long")
    a = df.where(epoch_day_range("s", "2019-10-01", "2019-10-31")).collect()
    b = df.where(epoch_to_day("s").between(F.lit(dt.date(2019, 10, 1)), F.lit(dt.date(2019, 10, 31)))).collect()
    assert sorted(a) == sorted(b) and len(a) == 2


def test_weekend_and_season(spark):
    days = [dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 7, 1), dt.date(2024, 10, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(is_weekend("d"), season("d")).collect()
    assert [r[0] for r in rows] == [1, 1, 0, 0, 0]
    assert [r[1] for r in rows] == ["winter", "winter", "winter", "summer", "autumn"]


def test_horizon(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 27),)], "a date")
    got = [r[0] for r in df.select(F.explode(horizon("a", 4))).collect()]
    assert got == [dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]


def test_haversine_known_distance_and_clamp(spark):
    df = spark.createDataFrame([(34.0522, -118.2437, 41.8781, -87.6298), (0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    r = df.select(haversine_km("a", "b", "c", "d")).collect()
    assert abs(r[0][0] - 2805.0) < 5.0
    assert r[1][0] == pytest.approx(3.141592653589793 * 6371.0)


def test_inline_places_and_horizon_days(spark):
    from geodemand.plans.forecast import horizon_days
    from geodemand.sources.io import places

    p = places(spark, [("Chicago", "IL", 41.8781, -87.6298), ("Portland", "OR", 45.5152, -122.6784)])
    assert p.count() == 2 and p.columns == ["city", "state", "center_lat", "center_lon"]
    days = [r.date for r in horizon_days(spark, "2024-04-24", 10).collect()]
    assert len(days) == 10 and days[0] == dt.date(2024, 4, 24) and days[-1] == dt.date(2024, 5, 3)


def test_imputer_stages(spark):
    from geodemand.operators import ml

    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (None, "b"), (10.0, None), (3.0, "a"), (4.0, "a")], "x double, c string")
    filled = ml.MedianModeImputer(numericCols=["x"], modeCols=["c"]).fit(df).transform(df)
    got = sorted((r.x, r.c) for r in filled.collect())
    assert (3.0, "b") in got and (10.0, "a") in got
