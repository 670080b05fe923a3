"""The driver contract of __spark_entry__."""

import os

import pytest

import __spark_entry__ as entry
from geodemand.queries import registry

SF = "/root/testdata/sf0.001"
MODEL_QUERIES = {"fit_forest", "fit_boosted", "select_best", "model_round_trip", "score_forecast", "end_to_end_forecast", "train_demo", "job_forecast", "forest_group_means", "boosted_stump"}


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    q, o = registry.QUERIES, registry.ORACLE
    assert len(q) == 84 and set(o) == set(q)
    assert set(q) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_columns_are_unique_and_named(spark):
    for name, q in registry.QUERIES.items():
        if name in MODEL_QUERIES:
            continue
        cols = q(spark, SF).columns
        assert len(cols) == len(set(cols)), name
        assert all(c and "(" not in c for c in cols), (name, cols)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert sorted(df.columns) == sorted(entry.queries()[entry.FLAGSHIP](spark, SF).columns)
