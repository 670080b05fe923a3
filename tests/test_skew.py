"""Hot keys: one station / customer / ZIP holding a third of all rows.

Broadcasts are switched off and AQE's skew thresholds lowered, so joins run as
shuffle joins with skewed partitions split; results must equal a brute-force
computation."""

import datetime as dt
import random
from collections import defaultdict
from contextlib import contextmanager
from decimal import Decimal

from geodemand.operators.keyed import latest_version, mode_reference
from geodemand.operators.measures import Measure
from geodemand.operators.spatial import place_day_measures
from geodemand.plans.sales import place_day_sales

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_station_join_and_rollup(spark):
    rnd = random.Random(2)
    start = dt.date(2024, 1, 1)
    rows = []
    for i in range(9000):
        st = "hot" if i % 3 == 0 else f"s{rnd.randint(0, 299)}"
        rows.append((st, start + dt.timedelta(rnd.randint(0, 4)), round(rnd.uniform(0, 50), 2)))
    fact = spark.createDataFrame(rows, "postal_code string, day date, v double")
    mapping = spark.createDataFrame(
        [("hot", "P", "X")] + [(f"s{i}", f"C{i % 7}", "Y") for i in range(300)], "postal_code string, city string, state string"
    )
    with conf(spark, SKEW_CONF):
        out = place_day_measures(fact, mapping, "postal_code", "day", {"v": Measure(type="decimal(12,2)", digits=4)})
        got = {(r.city, r.date): (r.postal_code_count, r.v) for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" not in final
    # the hot station is collapsed per (station, day) before the join
    assert "partial_sum" in final and "partial_count" in final
    place = {"hot": ("P", "X"), **{f"s{i}": (f"C{i % 7}", "Y") for i in range(300)}}
    acc = defaultdict(lambda: [set(), Decimal(0), 0])
    for st, d, v in rows:
        a = acc[(place[st][0], d)]
        a[0].add(st)
        a[1] += Decimal(str(v))
        a[2] += 1
    want = {k: (len(a[0]), float(round(a[1] / a[2], 4))) for k, a in acc.items()}
    assert got == want


def test_hot_customer_sales(spark):
    rnd = random.Random(3)
    orders = []
    for i in range(6000):
        cust = 0 if i % 3 == 0 else rnd.randint(1, 500)
        price = f"{rnd.randint(1, 9999) / 100:.2f}"
        orders.append((i, cust, 1570000000 + 86400 * rnd.randint(0, 9), f'[{{"price":"{price}","qty":"1"}}]'))
    o = spark.createDataFrame(orders, "order_number long, customer_id long, order_datetime long, ordered_products string")
    customers = spark.createDataFrame(
        [(c, "Hot" if c == 0 else f"C{c % 9}", "S") for c in range(501)], "customer_id long, city string, state string"
    )
    with conf(spark, SKEW_CONF):
        got = {(r.city, r.date): r.sales_amount for r in place_day_sales(o, customers).collect()}
    want = defaultdict(Decimal)
    for _, cust, secs, js in orders:
        city = "Hot" if cust == 0 else f"C{cust % 9}"
        day = dt.datetime.fromtimestamp(secs, dt.timezone.utc).date()
        want[(city, day)] += Decimal(js.split('"price":"')[1].split('"')[0])
    assert got == dict(want)


def test_hot_key_picks(spark):
    rows = [(0 if i % 3 == 0 else i, i, "z" if i % 3 == 0 else f"{i % 40}") for i in range(6000)]
    df = spark.createDataFrame(rows, "customer_id long, valid_from long, zip string").selectExpr(
        "customer_id", "valid_from", "CAST(NULL AS STRING) AS valid_to", "zip", "'c' AS city", "'S' AS state"
    )
    with conf(spark, SKEW_CONF):
        latest = {r.customer_id: r.valid_from for r in latest_version(df).collect()}
        ref = {r.zip: r.n for r in mode_reference(df, "zip", ["city", "state"]).collect()}
    assert latest[0] == max(v for c, v, _ in rows if c == 0)
    assert ref["z"] == 2000 and len(latest) == 1 + 4000
