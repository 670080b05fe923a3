import datetime as dt
import os

import pytest

from geodemand.operators.measures import Measure
from geodemand.operators.quality import coverage_full, coverage_left, duplicate_keys, duplicate_surplus, null_profile, row_counts
from geodemand.plans.forecast import dow_profile_forecast, scaffold
from geodemand.sources.io import coerce, read_source, require_columns, write_guarded

MON = dt.date(2024, 1, 1)  # a Monday


def test_forecast_fallbacks(spark):
    hist = [
        # place P: Mondays only for t; Tuesday has t null but u set
        ("P", MON, 10.0, 1.0),
        ("P", MON + dt.timedelta(7), 20.0, 3.0),
        ("P", MON + dt.timedelta(1), None, 5.0),
    ]
    h = spark.createDataFrame(hist, "k string, day date, t double, u double")
    places = spark.createDataFrame([("P",), ("Q",)], "k string")  # Q has no history
    out = dow_profile_forecast(h, places, ["k"], {"t": Measure(), "u": Measure()}, MON + dt.timedelta(14), 3, date_col="day")
    rows = {r.date: r for r in out.collect()}
    assert set(r.k for r in rows.values()) == {"P"}  # Q vanishes
    mon, tue, wed = (MON + dt.timedelta(14 + i) for i in range(3))
    assert (rows[mon].t, rows[mon].u, rows[mon].proxy_hist_rows_for_dow) == (15.0, 2.0, 2)
    assert (rows[tue].t, rows[tue].u, rows[tue].proxy_hist_rows_for_dow) == (15.0, 5.0, 1)  # t alone falls back
    assert (rows[wed].t, rows[wed].u, rows[wed].proxy_hist_rows_for_dow) == (15.0, 3.0, 0)  # weekday absent
    assert rows[wed].proxy_source_rows_total == 3
    assert (rows[wed].source_data_min_date, rows[wed].source_data_max_date) == (MON, MON + dt.timedelta(7))


def test_scaffold_size(spark):
    p = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert scaffold(p, "2024-01-31", 10).count() == 30


def test_quality_checks(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(2,), (2,), (4,)], "k int")
    assert [(r.k, r.cnt) for r in duplicate_keys(a, ["k"]).collect()] == [(1, 2)]
    assert duplicate_surplus(a, "k").first()[0] == 1
    cl = coverage_left(a, b, ["k"]).first()
    assert (cl.fact_rows, cl.fact_rows_without_match) == (4, 3)
    cf = coverage_full(a, b, ["k"]).first()
    assert tuple(cf) == (2, 1, 4)
    n = null_profile(spark.createDataFrame([(None, 1), (2, None), (None, None)], "x int, y int"), ["x", "y"]).first()
    assert (n.null_x, n.null_y) == (2, 2)
    rc = {r.table: r.rows for r in row_counts({"a": a, "b": b}).collect()}
    assert rc == {"a": 4, "b": 3}


def test_guards(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    with pytest.raises(ValueError, match="a, c, z"):
        require_columns(df.drop("a"), ["z", "a", "c"])
    with pytest.raises(ValueError, match="lacks: .*zz"):
        write_guarded(df, "t_guard", {"a": "int", "zz": "string"})
    with pytest.raises(ValueError, match="no rows to write to t_guard"):
        write_guarded(df.limit(0), "t_guard", {"a": "int"})
    with pytest.raises(FileNotFoundError) as e:
        read_source(spark, path=[str(tmp_path / "nope1.csv"), str(tmp_path / "nope2.csv")], schema=df.schema)
    assert "nope1" in str(e.value) and "nope2" in str(e.value)


def test_coerce_bad_values_become_null(spark):
    df = spark.createDataFrame([("1", "2.5", "2024-01-02", "true", "x"), ("a", "b", "c", "maybe", "y")], "i string, d string, day string, f string, keep string")
    out = coerce(df, {"i": "bigint", "d": "double", "day": "date", "f": "boolean"}).collect()
    assert tuple(out[0]) == (1, 2.5, dt.date(2024, 1, 2), True, "x")
    assert tuple(out[1]) == (None, None, None, None, "y")


def test_approx_distinct_option(spark):
    from geodemand.operators.measures import mean_measures

    df = spark.createDataFrame([("a", i % 50, 1.0) for i in range(500)], "k string, s int, v double")
    exact = mean_measures(df, ["k"], {"v": Measure()}, distinct_counts={"n": "s"}).first().n
    approx = mean_measures(df, ["k"], {"v": Measure()}, distinct_counts={"n": "s"}, approx_distinct=0.01).first().n
    assert exact == 50 and abs(approx - 50) <= 2


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from geodemand.sources.io import write_table

    a = spark.range(2000).selectExpr("id AS customer_id", "id % 7 AS v")
    b = spark.range(2000).selectExpr("id AS customer_id", "id % 5 AS w")
    loc = str(tmp_path / "db")
    write_table(a, "geodemand_bucket_test.a", path=f"{loc}/a", schema_location=loc, bucket_by=(8, "customer_id"))
    write_table(b, "geodemand_bucket_test.b", path=f"{loc}/b", schema_location=loc, bucket_by=(8, ["customer_id"]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("geodemand_bucket_test.a").join(spark.table("geodemand_bucket_test.b"), "customer_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_read_source_prefers_table_then_files(spark, tmp_path):
    from geodemand.sources.io import read_csv, write_csv, write_table

    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    path = str(tmp_path / "csv")
    write_csv(df, path)
    assert sorted(read_source(spark, table="geodemand_src_test.none", path=path, schema=df.schema).collect()) == sorted(df.collect())
    loc = str(tmp_path / "db")
    write_table(df.where("v = 1"), "geodemand_src_test.t", path=f"{loc}/t", schema_location=loc)
    got = read_source(spark, table="geodemand_src_test.t", path=path, schema=df.schema).collect()
    assert [tuple(r) for r in got] == [("a", 1)]
    assert sorted(read_csv(spark, path, df.schema).collect()) == sorted(df.collect())


def test_forecast_report_default_place_and_context(spark):
    from geodemand.plans.report import forecast_report

    fc = spark.createDataFrame(
        [("Zed", "AA", dt.date(2024, 2, 2), 5.0), ("Zed", "AA", dt.date(2024, 2, 1), 4.0), ("Abe", "ZZ", dt.date(2024, 2, 1), 1.0)],
        "city string, state string, date date, sales_amount_pred double",
    )
    wx = spark.createDataFrame(
        [("Zed", "AA", dt.date(2024, 2, 1), 10.0, 0.5), ("Zed", "AA", dt.date(2024, 2, 2), 11.0, 0.0)],
        "city string, state string, date date, temp_avg double, uv double",
    )
    options, view = forecast_report(fc, wx, context="UV")
    assert [r.label for r in options.collect()] == ["Zed, AA", "Abe, ZZ"]  # ordered by state, then city
    rows = view.collect()
    assert [r.date for r in rows] == [dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    assert [(r.sales_amount_pred, r.temp_avg, r.uv) for r in rows] == [(4.0, 10.0, 0.5), (5.0, 11.0, 0.0)]


def test_between_dates(spark):
    from geodemand.functions.dates import between_dates

    df = spark.createDataFrame([(dt.date(2019, 9, 30),), (dt.date(2019, 10, 1),), (dt.date(2019, 10, 31),), (dt.date(2019, 11, 1),)], "d date")
    assert df.where(between_dates("d", "2019-10-01", "2019-10-31")).count() == 2


def test_partitioned_table_and_read_by_name(spark, tmp_path):
    from pyspark.sql import types as T

    from geodemand.sources.io import read_table, write_table

    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, 5), "1"), ("b", dt.date(2024, 2, 5), "x")], "k string, d date, v string"
    ).selectExpr("k", "d", "v", "date_format(d, 'yyyy-MM') AS month")
    loc = str(tmp_path / "db")
    write_table(df, "geodemand_part_test.t", partition_by="month", path=f"{loc}/t", schema_location=loc)
    back = read_table(spark, "geodemand_part_test.t")
    assert back.where("month = '2024-02'").count() == 1
    (version,) = os.listdir(f"{loc}/t")
    assert {"month=2024-01", "month=2024-02"} <= set(os.listdir(f"{loc}/t/{version}"))
    typed = coerce(back, T.StructType([T.StructField("v", T.IntegerType())]))
    assert sorted((r.k, r.v) for r in typed.collect()) == [("a", 1), ("b", None)]
    write_table(df.where("k = 'b'"), "geodemand_part_test.t", partition_by="month", path=f"{loc}/t", schema_location=loc)
    assert [r["month"] for r in read_table(spark, "geodemand_part_test.t").collect()] == ["2024-02"]


@pytest.fixture
def sink(spark, tmp_path):
    """A table with two rows, and how to write it."""
    from geodemand.sources.io import write_table

    name, layout = f"geodemand_sink_{tmp_path.name.replace('-', '_')}.t", {"path": str(tmp_path / "t"), "schema_location": str(tmp_path)}
    write_table(spark.range(2), name, **layout)
    yield name, layout
    assert [t.name for t in spark.catalog.listTables(name.split(".")[0])] == ["t"]  # no staged table is left
    # a task that was still writing when its job failed may leave a folder: the next write clears it
    write_table(spark.range(1), name, **layout)
    assert len(os.listdir(tmp_path / "t")) <= 2 and spark.table(name).count() == 1


def test_a_failing_write_leaves_the_old_table(spark, sink):
    from geodemand.sources.io import write_table

    name, layout = sink
    # one task's rows are written before another one fails
    half = spark.range(0, 100, 1, 4).selectExpr("id + if(id > 80, int(raise_error('broken row')), 0) AS id")
    for write in (write_table, lambda df, n, **k: write_guarded(df, n, {"id": "bigint"}, **k)):
        with pytest.raises(Exception, match="broken row"):
            write(half, name, **layout)
        assert sorted(r["id"] for r in spark.table(name).collect()) == [0, 1]


def test_an_empty_frame_leaves_the_old_table_and_nothing_is_cached(spark, sink):
    name, layout = sink
    with pytest.raises(ValueError, match="no rows"):
        write_guarded(spark.range(0), name, {"id": "bigint"}, **layout)
    assert spark.table(name).count() == 2
    df = spark.range(7)
    out = write_guarded(df, name, {"id": "int"}, **layout)
    assert out.dtypes == [("id", "int")] and spark.table(name).count() == 7
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_readers_of_the_old_version_can_finish(spark, sink):
    from geodemand.sources.io import write_table

    name, layout = sink
    before = spark.table(name)
    write_table(spark.range(5), name, **layout)
    assert (before.count(), spark.table(name).count()) == (2, 5)
    write_table(spark.table(name).where("id > 1"), name, **layout)  # from itself
    assert spark.table(name).count() == 3
    write_table(spark.range(4).selectExpr("id", "id * 2 AS twice"), name, **layout)  # other columns
    assert spark.table(name).columns == ["id", "twice"]


def test_reduction_keeps_every_wanted_row(spark):
    from geodemand.operators.reduce import keep_possible, key_bits

    fact = spark.range(20_000).selectExpr("if(id % 11 = 0, null, id % 5000) AS k", "id AS _x", "id AS `a b`")
    for keys, kind in ((spark.range(0, 300, 7), "id"), (spark.range(5000), "id"), (spark.range(0), "id")):
        wanted = keys.select(keys[kind].alias("k"))
        got = keep_possible(fact, wanted, "k", bits=1 << 14)
        assert got.columns == fact.columns
        exact = fact.join(wanted, "k", "left_semi")
        assert exact.exceptAll(got).count() == 0 and got.where("k is null").count() == 0
        assert got.count() <= exact.count() + 0.1 * fact.count()
    assert key_bits(spark.range(100_000), "id", bits=1 << 10).count() <= 16  # bounded whatever the keys
    with pytest.raises(ValueError, match="power of two"):
        keep_possible(fact, fact, "k", bits=100)
    texts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert [r["v"] for r in keep_possible(texts, texts.where("k = 'a'"), "k").collect()] == [1]
