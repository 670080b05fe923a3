"""Every registered query against its DuckDB oracle on the smallest driver
tables, plus grain and repartition properties of the composite outputs."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from geodemand.queries import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

# Spark simple type names -> DuckDB type names.
TYPE_NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = df.columns
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    want = [tuple(_norm(v) for v in r) for r in cur.fetchall()]
    assert sorted(cols) == sorted(dcols)
    dtypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    stypes = {f.name: TYPE_NAMES[f.dataType.simpleString()] for f in df.schema.fields}
    assert stypes == dtypes
    order = sorted(cols)
    got = _sorted([tuple(r[cols.index(c)] for c in order) for r in got])
    want = _sorted([tuple(r[dcols.index(c)] for c in order) for r in want])
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "sales_amount_roll7_mean_prev" in df.columns


@pytest.mark.parametrize("name,keys", [
    ("place_day_training", ["city", "state", "date"]),
    ("place_day_weather", ["city", "state", "date"]),
    ("place_day_sales", ["city", "state", "date"]),
    ("resolve_places", ["customer_id"]),
    ("nearest_place", ["postal_code"]),
])
def test_composite_grain(spark, name, keys):
    df = entry.queries()[name](spark, SF)
    assert df.groupBy(*keys).count().where("count > 1").count() == 0


def test_unchanged_by_shuffle_partitions(spark):
    q = entry.queries()["place_day_training"]
    a = sorted(q(spark, SF).collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = sorted(q(spark, SF).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b
