"""Property tests of the column functions against Python implementations.

Each hypothesis example is a whole batch of cases evaluated in one Spark job.
"""

import calendar
import datetime as dt
import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from geodemand.functions import epoch_to_day, haversine_km, line_amount, remap_month

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))


@SETTINGS
@given(st.lists(dates, min_size=1, max_size=300), st.integers(1990, 2030), st.integers(1, 12))
def test_remap_month_clamp(spark, days, year, month):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d date")
    got = [r[0] for r in df.orderBy("i").select(remap_month("d", year, month, "clamp")).collect()]
    last = calendar.monthrange(year, month)[1]
    assert got == [dt.date(year, month, min(d.day, last)) for d in days]


@SETTINGS
@given(st.lists(st.integers(-2_000_000_000, 4_000_000_000), min_size=1, max_size=300))
def test_epoch_to_day(spark, secs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(secs)], "i int, s long")
    got = [r[0] for r in df.orderBy("i").select(epoch_to_day("s")).collect()]
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    assert got == [(epoch + dt.timedelta(seconds=s)).date() for s in secs]


coords = st.tuples(
    st.floats(-90, 90, allow_nan=False), st.floats(-180, 180, allow_nan=False),
    st.floats(-90, 90, allow_nan=False), st.floats(-180, 180, allow_nan=False),
)


def py_haversine(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(
        math.radians(d - b) / 2
    ) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(h, 1.0)))


@SETTINGS
@given(st.lists(coords, min_size=1, max_size=300))
def test_haversine(spark, pts):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "i int, a double, b double, c double, d double")
    got = [r[0] for r in df.orderBy("i").select(haversine_km("a", "b", "c", "d")).collect()]
    for g, p in zip(got, pts):
        assert math.isclose(g, py_haversine(*p), rel_tol=1e-9, abs_tol=1e-6)


cents = st.integers(0, 10_000_000).map(lambda c: Decimal(c) / 100)
qtys = st.integers(0, 500)
discs = st.integers(0, 100).map(lambda c: float(Decimal(c) / 100))


@SETTINGS
@given(st.lists(st.tuples(cents, qtys, discs), min_size=1, max_size=300))
def test_line_amount_exact_half_up(spark, lines):
    df = spark.createDataFrame([(i, str(p), str(q), d) for i, (p, q, d) in enumerate(lines)], "i int, p string, q string, d double")
    got = [r[0] for r in df.orderBy("i").select(line_amount("p", "q", "d")).collect()]
    want = [
        (p * Decimal(q) * (Decimal(1) - Decimal(str(d)))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        for p, q, d in lines
    ]
    assert got == want
