import math
import random

import numpy as np
from pyspark.sql import functions as F

from geodemand.functions.geo import haversine_km
from geodemand.operators.keyed import fill_from_reference, latest_version, mode_reference
from geodemand.operators import spatial
from geodemand.operators.spatial import dense_candidates, nearest_place


def test_mode_reference_tie_is_alphabetical(spark):
    rows = [("12345", "b", "X"), ("12345", "a", "X"), ("12345", "b", "X"), ("12345", "a", "X"), ("99999", "z", "Y")]
    df = spark.createDataFrame(rows, "zip string, city string, state string")
    got = {r.zip: (r.city, r.n) for r in mode_reference(df, "zip", ["city", "state"]).collect()}
    assert got == {"12345": ("a", 2), "99999": ("z", 1)}


def test_mode_reference_skips_null_voters(spark):
    rows = [("1", None, "X"), ("1", None, "X"), ("1", "c", "X"), (None, "d", "X")]
    df = spark.createDataFrame(rows, "zip string, city string, state string")
    assert [(r.zip, r.city) for r in mode_reference(df, "zip", ["city", "state"]).collect()] == [("1", "c")]


def test_latest_version_open_first_and_blank_is_open(spark):
    rows = [
        (1, 100, None, "open"),
        (1, 200, "2020-01-01", "newer but closed"),
        (2, 100, " ", "blank counts as open"),
        (2, 300, "2021-01-01", "closed"),
        (3, 100, "2019-01-01", "old closed"),
        (3, 200, "2020-01-01", "new closed"),
    ]
    df = spark.createDataFrame(rows, "customer_id int, valid_from int, valid_to string, tag string")
    got = {r.customer_id: r.tag for r in latest_version(df).collect()}
    assert got == {1: "open", 2: "blank counts as open", 3: "new closed"}


def test_fill_only_missing_each_independently(spark):
    d = spark.createDataFrame([(1, None, "OH"), (2, "x", None), (3, None, None)], "zip int, city string, state string")
    r = spark.createDataFrame([(1, "c1", "S1"), (2, "c2", "S2")], "zip int, rc string, rs string")
    out = {x.zip: x for x in fill_from_reference(d, r, "zip", {"city": "rc", "state": "rs"}).collect()}
    assert (out[1].resolved_city, out[1].resolved_state, out[1].city_repaired, out[1].state_repaired) == ("c1", "OH", True, False)
    assert (out[2].resolved_city, out[2].resolved_state) == ("x", "S2")
    assert (out[3].resolved_city, out[3].city_repaired) == (None, False)


CENTRES = [("B", "S", 0.0, 1.0), ("A", "S", 0.0, -1.0), ("C", "T", 10.0, 0.0)]


def test_nearest_place_ties_nulls_radius(spark):
    c = spark.createDataFrame(CENTRES, "city string, state string, center_lat double, center_lon double")
    km1 = 6371.0 * math.radians(1.0)
    pts = spark.createDataFrame(
        [("tie", 0.0, 0.0), ("null", None, 0.0), ("in", 10.0, 0.0), ("edge_out", 0.0, 2.0 + 0.01)],
        "postal_code string, lat double, lon double",
    )
    got = {r.postal_code: (r.city, r.distance_km) for r in nearest_place(pts, c, km1 + 1e-6).collect()}
    assert got["tie"][0] == "A"  # equidistant: alphabetical
    assert "null" not in got
    assert got["in"] == ("C", 0.0)
    assert "edge_out" not in got  # 1.01 degrees from B: outside the radius


def test_nearest_place_grid_equals_brute_force(spark):
    rnd = random.Random(7)
    centres = [(f"c{i}", "S", rnd.uniform(-89.9, 89.9), rnd.uniform(-180, 180)) for i in range(40)]
    centres += [("pole", "N", 89.95, 10.0), ("date", "E", 5.0, 179.9)]
    pts = [(f"p{i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(3000)]
    pts += [("np", 89.99, -170.0), ("dl", 5.0, -179.95), ("dl2", 5.3, -179.5)]
    for i, (_, _, la, lo) in enumerate(centres[:20]):  # points close to centres
        pts.append((f"q{i}", la + rnd.uniform(-1, 1), ((lo + rnd.uniform(-2, 2) + 180) % 360) - 180))
    c = spark.createDataFrame(centres, "city string, state string, center_lat double, center_lon double")
    p = spark.createDataFrame(pts, "postal_code string, lat double, lon double")
    for max_km in (80.0, 500.0, 3000.0, 15000.0, 25000.0):
        grid = {r.postal_code: (r.city, round(r.distance_km, 9)) for r in nearest_place(p, c, max_km).collect()}
        pairs = p.crossJoin(c).withColumn("km", haversine_km("lat", "lon", "center_lat", "center_lon"))
        best = pairs.groupBy("postal_code").agg(F.min(F.struct("km", "city", "state")).alias("b"))
        brute = {
            r.postal_code: (r.b.city, round(r.b.km, 9))
            for r in best.collect()
            if r.b.km <= max_km
        }
        assert grid == brute, max_km


def test_nearest_place_shuffle_path_equals_broadcast_path(spark):
    rnd = random.Random(5)
    centres = [(f"c{i}", "S", rnd.uniform(-60, 60), rnd.uniform(-180, 180)) for i in range(30)]
    pts = [(f"p{i}", rnd.uniform(-61, 61), rnd.uniform(-180, 180)) for i in range(2000)]
    c = spark.createDataFrame(centres, "city string, state string, center_lat double, center_lon double")
    p = spark.createDataFrame(pts, "postal_code string, lat double, lon double")
    a = sorted(nearest_place(p, c, 900.0).collect())
    b = sorted(nearest_place(p, c, 900.0, max_broadcast_rows=0).collect())  # centre cells not broadcast
    assert a == b and len(a) > 100


def test_nearest_place_tree_equals_brute_force(spark):
    """The walk down the tree of cells, forced by a low ``max_per_cell``: poles, date line, ties, copies, all radii."""
    rnd = random.Random(11)
    centres = [(f"c{i}", "S", rnd.uniform(-89.9, 89.9), rnd.uniform(-180, 180)) for i in range(60)]
    centres += [(f"d{i}", "S", rnd.uniform(4, 6), (rnd.uniform(178, 182) + 180) % 360 - 180) for i in range(60)]
    centres += [("pole", "N", 89.95, 10.0), ("date", "E", 5.0, 180.0), ("date", "W", 5.0, -180.0), ("copy", "B", 5.0, 179.0), ("copy", "A", 5.0, 179.0)]
    pts = [(f"p{i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(600)]
    pts += [(f"q{i}", rnd.uniform(3, 7), (rnd.uniform(177, 183) + 180) % 360 - 180) for i in range(600)]
    pts += [("np", 89.99, -170.0), ("dl", 5.0, -180.0), ("dl", 5.0, -180.0), ("at", 5.0, 179.0), ("two", 5.0, 179.0), ("two", 10.0, 10.0), ("null", None, 1.0)]
    c = spark.createDataFrame(centres, "city string, state string, center_lat double, center_lon double")
    p = spark.createDataFrame(pts, "postal_code string, lat double, lon double")
    for max_km, broadcast in ((80.0, 100_000), (500.0, 0), (25000.0, 100_000)):
        found = nearest_place(p, c, max_km, max_per_cell=8, max_broadcast_rows=broadcast)
        tree = {r.postal_code: (r.city, r.state, round(r.distance_km, 6)) for r in found.collect()}
        plain = {r.postal_code: (r.city, r.state, round(r.distance_km, 6)) for r in nearest_place(p, c, max_km, max_per_cell=10**9).collect()}
        assert tree == plain and tree["at"][:2] == ("copy", "A"), max_km


def test_nearest_place_dense_centres_bounds_candidates(spark):
    """10,000 centres inside one radius, half of them within 20 m: no point meets more than a few leaves of them."""
    rnd = random.Random(3)
    centres = [(f"c{i:05}", "S", 40 + rnd.uniform(-0.3, 0.3), -100 + rnd.uniform(-0.3, 0.3)) for i in range(5000)]
    centres += [(f"t{i:05}", "S", 40.5 + rnd.uniform(-1e-4, 1e-4), -100 + rnd.uniform(-1e-4, 1e-4)) for i in range(5000)]
    pts = [(f"p{i}", 40 + rnd.uniform(-1.2, 1.2), -100 + rnd.uniform(-1.5, 1.5)) for i in range(400)]
    pts += [(f"q{i}", 40.5 + rnd.uniform(-2e-4, 2e-4), -100 + rnd.uniform(-2e-4, 2e-4)) for i in range(100)]
    c = spark.createDataFrame(centres, "city string, state string, center_lat double, center_lon double")
    p = spark.createDataFrame(pts, "postal_code string, lat double, lon double")
    lat_deg, n_lon, lon_deg = spatial._grid(80.0)
    tagged = p.select("postal_code", F.col("lat").alias("_p_lat"), F.col("lon").alias("_p_lon")).withColumns(
        {"_lat_cell": spatial._lat_cell(F.col("_p_lat"), lat_deg), "_lon_cell": spatial._lon_cell(F.col("_p_lon"), n_lon, lon_deg)}
    )
    met = dense_candidates(tagged, c.selectExpr("city", "state", "center_lat _c_lat", "center_lon _c_lon"), "postal_code", 80.0, leaf=16)
    per_point = [r["count"] for r in met.groupBy("postal_code").count().collect()]
    assert max(per_point) <= 320 and sum(per_point) / len(per_point) <= 80

    got = {r.postal_code: (r.city, round(r.distance_km, 6)) for r in nearest_place(p, c, 80.0, max_per_cell=16).collect()}
    la, lo = (np.radians([x[i] for x in centres]) for i in (2, 3))
    want = {}
    for key, plat, plon in pts:
        a, o = math.radians(plat), math.radians(plon)
        km = 2 * 6371.0 * np.arcsin(np.sqrt(np.sin((la - a) / 2) ** 2 + math.cos(a) * np.cos(la) * np.sin((lo - o) / 2) ** 2))
        if km.min() <= 80.0:
            want[key] = (centres[int(km.argmin())][0], round(float(km.min()), 6))
    assert got == want and len(got) > 300


def test_nearest_place_without_rows(spark):
    c = spark.createDataFrame([], "city string, state string, center_lat double, center_lon double")
    p = spark.createDataFrame([("a", 1.0, 1.0)], "postal_code string, lat double, lon double")
    assert nearest_place(p, c, 80.0).collect() == []
    some = spark.createDataFrame([("x", "S", 1.0, 1.0), ("y", "S", 1.1, 1.0)], c.schema)
    assert nearest_place(p.limit(0), some, 80.0, max_per_cell=1).collect() == []
