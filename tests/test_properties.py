"""Operators against brute-force Python versions of the same rules, on
seeded random data (including ties, nulls and gaps)."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict

from geodemand.functions.text import clean_postcode
from geodemand.operators.keyed import latest_version, mode_reference
from geodemand.operators.measures import Measure
from geodemand.plans.forecast import dow_profile_forecast
from geodemand.plans.training import place_day_training

RND = random.Random(11)


def py_postcode(p):
    if p is None:
        return None
    s = re.sub(r"\.0$", "", p.strip(" "))
    m4 = re.fullmatch(r"(\d{4})", s)
    if m4:
        return m4.group(1).rjust(5, "0")
    m5 = re.search(r"(\d{5})", s)
    return m5.group(1) if m5 else None


def test_clean_postcode_matches_python(spark):
    alphabet = "0123456789.- a"
    raw = ["".join(RND.choice(alphabet) for _ in range(RND.randint(0, 9))) for _ in range(2000)]
    raw += [f"{RND.randint(0, 99999)}.0" for _ in range(200)] + [None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, p string")
    got = {r.i: r.z for r in df.select("i", clean_postcode("p").alias("z")).collect()}
    assert got == {i: py_postcode(r) for i, r in enumerate(raw)}


def test_latest_version_matches_python(spark):
    rows = []
    for cid in range(300):
        for _ in range(RND.randint(1, 4)):
            vt = RND.choice([None, "", " ", "2019-01-01", "2020-05-05"])
            rows.append((cid, RND.randint(1, 5), vt, RND.choice("abc")))
    df = spark.createDataFrame(rows, "customer_id int, valid_from int, valid_to string, tag string")
    got = {r.customer_id: tuple(r) for r in latest_version(df).collect()}

    def rank(r):
        open_ = 1 if r[2] is None or r[2].strip(" ") == "" else 0
        return (open_, r[1], r[2] is not None, r[2] or "", r[3])  # nulls lowest on ties

    want = {}
    for r in rows:
        if r[0] not in want or rank(r) > rank(want[r[0]]):
            want[r[0]] = r
    assert got == want


def test_mode_reference_matches_python(spark):
    rows = [(str(RND.randint(0, 40)), RND.choice(["a", "b", "c", None]), RND.choice(["X", "Y"])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "zip string, city string, state string")
    got = {r.zip: (r.city, r.state, r.n) for r in mode_reference(df, "zip", ["city", "state"]).collect()}
    counts = defaultdict(Counter)
    for z, c, s in rows:
        if z is not None and c is not None and s is not None:
            counts[z][(c, s)] += 1
    want = {}
    for z, cnt in counts.items():
        (c, s), n = min(cnt.items(), key=lambda kv: (-kv[1], kv[0]))
        want[z] = (c, s, n)
    assert got == want


def test_dow_forecast_matches_three_aggregate_form(spark):
    start = dt.date(2024, 1, 1)
    hist = []
    for k in ("p1", "p2", "p3"):
        for i in range(40):
            if RND.random() < 0.3:
                continue  # gaps: some weekdays go missing
            v = None if RND.random() < 0.2 else round(RND.uniform(0, 100), 2)
            hist.append((k, start + dt.timedelta(i), v))
    h = spark.createDataFrame(hist, "k string, day date, v double")
    places = spark.createDataFrame([("p1",), ("p2",), ("p3",), ("none",)], "k string")
    anchor = start + dt.timedelta(40)
    got = {
        (r.k, r.date): (round(r.v, 9) if r.v is not None else None, r.proxy_hist_rows_for_dow, r.proxy_source_rows_total)
        for r in dow_profile_forecast(h, places, ["k"], {"v": Measure()}, anchor, 10).collect()
    }
    want = {}
    for k in ("p1", "p2", "p3", "none"):
        rows = [r for r in hist if r[0] == k]
        if not rows:
            continue
        allv = [r[2] for r in rows if r[2] is not None]
        overall = sum(allv) / len(allv) if allv else None
        for i in range(10):
            d = anchor + dt.timedelta(i)
            same = [r for r in rows if r[1].weekday() == d.weekday()]
            sv = [r[2] for r in same if r[2] is not None]
            m = sum(sv) / len(sv) if sv else overall
            want[(k, d)] = (round(m, 9) if m is not None else None, len(same), len(rows))
    assert got == want


def test_training_features_match_python(spark):
    start = dt.date(2022, 1, 1)
    sales, weather = [], []
    for city, state in (("chicago", "il"), ("Portland ", "OR")):
        for i in range(31):
            if RND.random() < 0.25:
                continue
            d = start + dt.timedelta(i)
            sales.append((city, state, d, float(RND.randint(100, 1000))))
            if RND.random() < 0.8:
                weather.append((city.upper().strip(), state.upper(), d, RND.uniform(50, 60), RND.uniform(30, 40), RND.choice([0.0, 0.3, None])))
    s = spark.createDataFrame(sales, "city string, state string, date date, sales_amount double")
    w = spark.createDataFrame(weather, "city string, state string, date date, temp_max double, temp_min double, precip_total double")
    got = {(r.city, r.date): r for r in place_day_training(s, w).collect()}
    wmap = {(c, st, d): (a, b, p) for c, st, d, a, b, p in weather}
    n = 0
    for city, state in (("chicago", "il"), ("Portland ", "OR")):
        rows = sorted((r for r in sales if r[0] == city), key=lambda r: r[2])
        ck, sk = city.strip().upper(), state.strip().upper()
        for i, r in enumerate(rows):
            key = (ck, sk, r[2])
            if key not in wmap:
                continue
            n += 1
            g = got[(ck.title(), r[2])]
            prev = [x[3] for x in rows[max(0, i - 7):i]]
            assert g.sales_amount_lag_1d == (rows[i - 1][3] if i else None)
            assert (g.sales_amount_roll7_mean_prev is None and not prev) or abs(g.sales_amount_roll7_mean_prev - sum(prev) / len(prev)) < 1e-9
            a, b, p = wmap[key]
            assert abs(g.temp_range - (a - b)) < 1e-9
            assert g.is_rainy == (1 if (p or 0.0) > 0 else 0)
            assert g.is_weekend == (1 if r[2].weekday() >= 5 else 0)
    assert n == len(got)


def test_preaggregated_rollup_equals_direct_mean(spark):
    from pyspark.sql import functions as F

    from geodemand.operators.measures import mean_measures
    from geodemand.operators.spatial import place_day_measures

    start = dt.date(2024, 1, 1)
    rows = [
        (f"s{RND.randint(0, 60)}", start + dt.timedelta(RND.randint(0, 6)),
         None if RND.random() < 0.1 else round(RND.uniform(-20, 40), 2), round(RND.uniform(0, 1), 2))
        for _ in range(4000)
    ]
    fact = spark.createDataFrame(rows, "postal_code string, day date, t double, c double")
    mapping = spark.createDataFrame([(f"s{i}", f"P{i % 9}", "S") for i in range(55)], "postal_code string, city string, state string")
    spec = {"t": Measure(type="decimal(12,2)", digits=2), "c": Measure(type="decimal(12,2)", scale=100.0, digits=1)}
    pre = place_day_measures(fact, mapping, "postal_code", "day", spec)
    direct = mean_measures(
        fact.join(mapping, "postal_code"), ["city", "state", F.col("day").alias("date")], spec,
        distinct_counts={"postal_code_count": "postal_code"},
    )
    cols = ["city", "state", "date", "postal_code_count", "t", "c"]
    assert sorted(pre.select(cols).collect()) == sorted(direct.select(cols).collect())
