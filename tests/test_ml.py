import datetime as dt
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from geodemand.operators import ml


def test_split_last_days_sizes(spark):
    rows = [(p, dt.date(2024, 1, d), 1.0) for p, n in (("A", 7), ("B", 5), ("C", 1)) for d in range(1, n + 1)]
    df = spark.createDataFrame(rows, "city string, date date, y double").withColumn("state", F.lit("S"))
    out = ml.split_last_days(df)
    got = {r.city: r.n for r in out.where("is_valid").groupBy("city").agg(F.count("*").alias("n")).collect()}
    assert got == {"A": 5, "B": 1, "C": 1}
    last_b = out.where("city = 'B' AND is_valid").first().date
    assert last_b == dt.date(2024, 1, 5)


def test_median_exact_small_and_forced_narrowing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert ml.exact_median(df, "x") == 2.5
    rnd = random.Random(3)
    vals = [rnd.choice([rnd.gauss(0, 1e6), 7.0, 7.0]) for _ in range(4001)]
    big = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    assert ml.exact_median(big, "x", step_bits=3) == s[2000]
    even = spark.createDataFrame([(v,) for v in vals[:4000]], "x double")
    s = sorted(vals[:4000])
    assert ml.exact_median(even, "x", step_bits=5) == (s[1999] + s[2000]) / 2


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    out = action()
    spark.sparkContext.setJobGroup("", "")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_median_jobs_do_not_grow_with_columns(spark):
    rnd = random.Random(4)
    rows = [tuple(rnd.choice([rnd.gauss(0, 10.0**k), float(k), None]) for k in range(-4, 4)) for _ in range(1501)]
    df = spark.createDataFrame(rows, ", ".join(f"c{k} double" for k in range(8))).repartition(3)
    medians, many = jobs_of(spark, "eight", lambda: ml.exact_medians(df, df.columns))
    for k, c in enumerate(df.columns):
        s = sorted(r[k] for r in rows if r[k] is not None)
        assert medians[c] == (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2
    deepest = max(jobs_of(spark, f"one {c}", lambda c=c: ml.exact_medians(df, [c]))[1] for c in df.columns)
    assert many == deepest  # as many passes as the column that needs the most, for all together
    assert ml.exact_medians(df.limit(0), df.columns) == {} and ml.exact_medians(df, []) == {}


def test_ordered_bits_keep_the_order_and_come_back(spark):
    import struct

    rnd = random.Random(5)
    values = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 2.2250738585072009e-308, 1.7976931348623157e308, 1.0, 2.0, 0.1, float("inf")]
    values += [2.0**k for k in range(-1074, 1024, 7)] + [float(x) for k in range(-1000, 1000, 9) for x in (2.0**k * (2 - 2**-52), 2.0**k * (1 + 2**-52))]
    values += [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(63)))[0] for _ in range(2000)]
    values = [v for v in values if v == v]
    values += [-v for v in values]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", ml.ordered_bits(F.col("v")).alias("k")).collect()
    for r in got:
        assert ml.from_ordered_bits(r["k"]) == r["v"]
    by_key = [r["v"] for r in sorted(got, key=lambda r: r["k"])]
    assert by_key == sorted(values)
    none = spark.createDataFrame([(float("nan"),), (None,)], "v double").select(ml.ordered_bits(F.col("v"))).collect()
    assert [r[0] for r in none] == [None, None]


def test_mode_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert ml.exact_mode(df, "c") == "a"
    filled = ml.impute_mode(df, ["c"]).groupBy("c").count().collect()
    assert {r.c: r["count"] for r in filled} == {"a": 5, "b": 2}


def test_one_hot_unseen_and_null_are_zero(spark):
    train = spark.createDataFrame([("x",), ("y",), ("y",)], "city string")
    model = Pipeline(stages=ml.feature_stages([], ["city"], features_col="f")).fit(train)
    test = spark.createDataFrame([(1, "x"), (2, "y"), (3, "zzz"), (4, None)], "i int, city string")
    out = model.transform(test).withColumn("a", vector_to_array("f")).select("i", "a").collect()
    got = {r.i: list(r.a) for r in out}
    assert got[1] == [1.0, 0.0] and got[2] == [0.0, 1.0]
    assert got[3] == [0.0, 0.0]  # unseen category: all zeros
    # null is filled with the mode ("y") by the imputer before encoding
    assert got[4] == [0.0, 1.0]
    # without the imputer the encoder itself maps null to all zeros
    enc = Pipeline(stages=ml.feature_stages([], ["city"], features_col="f")[1:]).fit(train)
    raw = enc.transform(test).withColumn("a", vector_to_array("f")).where("i = 4").first()
    assert list(raw.a) == [0.0, 0.0]


def test_regression_metrics_constant_target(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 7.0)], "y double, p double")
    m = ml.regression_metrics(df, "y", "p").first()
    assert m.mae == 1.5 and m.r2 is None
    df2 = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0)], "y double, p double")
    assert ml.regression_metrics(df2, "y", "p").first().r2 == 1.0


def test_select_best_refuses_empty(spark):
    empty = spark.createDataFrame([], "city string, state string, temp_avg double, sales_amount double")
    with pytest.raises(ValueError, match="no rows to train"):
        ml.select_best(empty, empty, ml.candidates()[:1], ml.feature_stages(["temp_avg"]))


def test_select_best_and_round_trip(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(c, "S", dt.date(2024, 1, d), t, 100.0 + 3.0 * t + rnd.uniform(-1, 1)) for c in ("a", "b") for d, t in ((d, rnd.uniform(0, 30)) for d in range(1, 21))]
    df = spark.createDataFrame(rows, "city string, state string, date date, temp_avg double, sales_amount double")
    t = ml.split_last_days(df)
    train, valid = t.where(~F.col("is_valid")), t.where("is_valid")
    sel = ml.select_best(train, valid, ml.candidates(forest_trees=5, boost_iters=5), ml.feature_stages(["temp_avg"]))
    assert sel.model_name == "linear_regression"
    assert sel.train_rows == 30 and sel.valid_rows == 10
    assert sel.metrics.where("selected").count() == 1
    assert [r["model_name"] for r in sel.metrics.collect()] == ["linear_regression", "random_forest", "gradient_boosting"]
    path = str(tmp_path / "m")
    ml.save_model(sel.model, path)
    a = sel.model.transform(valid).select("prediction").collect()
    b = ml.load_model(path).transform(valid).select("prediction").collect()
    assert a == b
    fc = ml.score_forecast(sel.model, valid.drop("sales_amount", "is_valid"))
    assert fc.count() == 10 and "sales_amount_pred" in fc.columns
    with pytest.raises(ValueError, match="no horizon rows"):
        ml.score_forecast(sel.model, valid.limit(0))


def test_split_hash_stable_under_repartition(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = ml.split_hash(df, ["k"]).where("is_train").select("k").collect()
    b = ml.split_hash(df.repartition(7), ["k"]).where("is_train").select("k").collect()
    assert sorted(a) == sorted(b) and 700 < len(a) < 900


def test_train_demo_on_demo_days(spark):
    from geodemand.operators.features import effects_score
    from geodemand.sources import roles

    days = effects_score(roles.demo_day(spark, "/root/testdata/sf0.001"), name="sales_amount")
    model, metrics = ml.train_demo(days, trees=5)
    m = metrics.first()
    assert m.train_rows + m.test_rows == 30 and m.mae >= 0
    with pytest.raises(ValueError, match="discount_pct"):
        ml.train_demo(days.drop("discount_pct"))


def test_approximate_median_option(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 1002)], "x double")
    assert ml.median_values(df, ["x"], approx_error=0.001)["x"] == 501.0
    assert ml.median_values(df, ["x"])["x"] == 501.0


def test_score_scenarios_delta_to_history_mean(spark):
    from pyspark.ml.regression import LinearRegression

    hist = spark.createDataFrame(
        [("a", "S", float(t), 10.0 + 2.0 * t) for t in range(20)], "city string, state string, temp_avg double, sales_amount double"
    )
    model = ml.build_model(LinearRegression(labelCol="sales_amount", regParam=0.0), ml.feature_stages(["temp_avg"], [])).fit(hist)
    scen = spark.createDataFrame([("a", "S", 30.0)], "city string, state string, temp_avg double")
    r = ml.score_scenarios(model, scen, hist).first()
    mean = sum(10.0 + 2.0 * t for t in range(20)) / 20
    assert abs(r.prediction - 70.0) < 1e-6 and abs(r.delta_vs_mean - (r.prediction - mean)) < 1e-9


def test_median_with_infinities_matches_numpy(spark):
    import numpy as np

    inf = float("inf")
    for vals in ([1.0, inf, 2.0, -inf, 3.0], [inf, inf, 1.0], [-inf, 5.0, 6.0, 7.0], [2.0, 2.0, inf, 4.0, None, float("nan")]):
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        clean = [v for v in vals if v is not None and v == v]
        assert ml.exact_median(df, "x", step_bits=7) == float(np.median(clean))


def test_candidates_share_one_preprocessing(spark, monkeypatch):
    rows = [(c, "S", float(i % 7), None if i % 5 == 0 else float(i), 3.0 * i) for i, c in enumerate("ab" * 20)]
    df = spark.createDataFrame(rows, "city string, state string, temp_avg double, uv double, sales_amount double")
    fits, real = [], ml.MedianModeImputer._fit
    monkeypatch.setattr(ml.MedianModeImputer, "_fit", lambda self, data: fits.append(1) or real(self, data))
    stored, checkpoint = [], ml.reliable_checkpoint
    monkeypatch.setattr(ml, "reliable_checkpoint", lambda df: stored.append(df.columns) or checkpoint(df))
    sel = ml.select_best(df, df, ml.candidates(forest_trees=3, boost_iters=2), ml.feature_stages(["temp_avg", "uv"]))
    assert len(fits) == 1 and stored.count(["features", "sales_amount"]) == 2 and len(stored) == 3  # and the imputer's own columns
    alone = ml.build_model(dict(ml.candidates(forest_trees=3, boost_iters=2))[sel.model_name], ml.feature_stages(["temp_avg", "uv"])).fit(df)
    keys = ["city", "temp_avg", "sales_amount", "prediction"]
    assert sorted(sel.model.transform(df).select(keys).collect()) == sorted(alone.transform(df).select(keys).collect())
