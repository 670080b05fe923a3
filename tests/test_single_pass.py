"""What costs a pass over the big tables is done once, however often its result is read."""

import datetime as dt
import os
import uuid

import pytest

from geodemand.operators.lines import priced_orders
from geodemand.plans import job
from geodemand.queries.registry import q_model

PLACES = [("Asia", "AS"), ("Europe", "EU"), ("Africa", "AF")]
DAYS = [dt.date(2024, 1, 1 + i) for i in range(9)]


@pytest.fixture
def counted(spark, tmp_path):
    """Makes a frame of one partition that leaves a file in its folder each time it is computed, and counts these."""

    def make(name, rows, schema):
        folder = str(tmp_path / name)
        os.makedirs(folder)

        def note(batches):
            open(f"{folder}/{uuid.uuid4().hex}", "w").close()
            yield from batches

        return spark.createDataFrame(rows, schema).coalesce(1).mapInPandas(note, schema).repartition(2, "city")

    yield make, lambda name: len(os.listdir(tmp_path / name))


@pytest.fixture
def inputs(counted):
    make, times = counted
    sales = make("sales", [(c, s, d, 10.0 * i + 3 * j) for i, (c, s) in enumerate(PLACES) for j, d in enumerate(DAYS)], "city string, state string, date date, sales_amount double")
    weather = make(
        "weather",
        [(c.upper(), s, d, 5.0 + i + j % 4, 60.0 + j) for i, (c, s) in enumerate(PLACES) for j, d in enumerate(DAYS)],
        "city string, state string, date date, temp_avg double, humidity double",
    )
    return sales, weather, times


def test_a_fit_computes_its_training_rows_once(spark, inputs, monkeypatch):
    sales, weather, times = inputs
    monkeypatch.setattr(q_model, "sales_2024_01", lambda *_: sales)
    monkeypatch.setattr(q_model, "weather_history", lambda *_: weather)
    train, valid = q_model._split(spark, "unread")
    assert (train.count(), valid.count()) == (12, 15)
    assert (times("sales"), times("weather")) == (1, 1)


def test_one_hot_computes_its_training_rows_once(spark, inputs, monkeypatch):
    sales, weather, times = inputs
    monkeypatch.setattr(q_model, "sales_2024_01", lambda *_: sales)
    monkeypatch.setattr(q_model, "weather_history", lambda *_: weather)
    got = sorted((r["city"], r["ones"]) for r in q_model.q_one_hot(spark, "unread").collect())
    # the states are the same in both, the upper-case cities are not known
    assert got == sorted([(c, 2.0) for c, _ in PLACES] + [(c.upper(), 1.0) for c, _ in PLACES])
    assert (times("sales"), times("weather")) == (1, 1)


def test_the_job_computes_its_weather_once(spark, inputs, monkeypatch):
    sales, weather, times = inputs
    for name, df in (("place_day_sales", sales), ("place_day_weather", weather), ("resolve_places", None), ("job_input", None)):
        monkeypatch.setattr(job, name, lambda *_, df=df, **__: df)
    t = job.build_tables(spark, job.JobConfig(sf_dir="unread"))
    assert (t["training"].count(), t["horizon"].count()) == (27, 30)
    assert (times("sales"), times("weather")) == (1, 1)


def test_orders_are_parsed_once(spark):
    price = '[{"price": "2.50", "qty": "2"}, {"price": "x", "qty": "1"}]'
    rows = [(1, 7, 0, price), (2, 7, 0, "[]"), (3, 7, 0, "{broken"), (4, 8, 0, None), (5, 8, None, price), (1, 7, 0, price)]
    o = spark.createDataFrame(rows, "order_number long, customer_id long, order_datetime long, ordered_products string")
    df = priced_orders(o)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert sorted((r[0], str(r[3])) for r in df.collect()) == [(1, "5.00"), (1, "5.00")]
