import math
import random

import numpy as np
import pytest
from helpers import SF

from geodemand.llm.queries import QUERIES
from geodemand.llm.vector_search import TreeSpec, build_tree, fit_tree, nearest_vectors, search_rows
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, is_query, top=10):
    """{(query id, vector): [(distance, id), ...]} by brute force over distinct usable rows of the commonest length."""
    good = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    lengths = [len(v) for _, v in good]
    dim = min(set(lengths), key=lambda k: (-lengths.count(k), k), default=0)
    good = sorted(x for x in good if len(x[1]) == dim)
    ids, m = np.array([i for i, _ in good]), np.array([v for _, v in good], np.float32).astype(np.float64)
    out = {}
    for i, v in good:
        if is_query(i):
            d = np.sqrt(((m - np.array(v, np.float32).astype(np.float64)) ** 2).sum(1))
            out[i, v] = sorted(zip(d[ids != i].tolist(), ids[ids != i].tolist()))[:top]
    return out


def recall(got, want):
    near = {}
    for r in got:
        near.setdefault(r["query_id"], set()).add(r["vec_id"])
    return sum(len(near.get(q, set()) & {i for _, i in w}) for (q, _), w in want.items()) / max(1, sum(map(len, want.values())))


def check_rows(got, want):
    """Ranks from 1, nearest first, ties by id, exact distances, as many rows as there are candidates."""
    by_query = {}
    for r in got:
        by_query.setdefault(r["query_id"], []).append(r)
    for (q, _), near in want.items():
        rows = sorted(by_query.get(q, []), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(near) + 1))
        assert [(r["score"], r["vec_id"]) for r in rows] == sorted((r["score"], r["vec_id"]) for r in rows)
        assert all(r["score"] >= d - 1e-12 for r, (d, _) in zip(rows, near)) and all(r["vec_id"] != q for r in rows)


def clustered(rng, n, dim=16, groups=12):
    centres = rng.normal(size=(groups, dim))
    return (centres[rng.integers(0, groups, n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32)


def test_query_reaches_its_recall(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
        want = exact(rows, lambda i: i % 100 == 0)
        got = QUERIES["op11_tree_neighbours"](spark, sf).collect()
        check_rows(got, want)
        assert recall(got, want) >= 0.9


def test_trunk_and_branches_with_blocks_and_chunks(spark):
    rng = np.random.default_rng(5)
    points = clustered(rng, 6000)
    rows = [(i, p.tolist(), 0) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    spec = TreeSpec(leaf_rows=20, sample_rows=600, branch_rows=300, fit_rows=10, block_rows=16, chunk_queries=7, branching=4)
    tree = build_tree(search_rows(df, spec).where("candidate"), spec)
    assert (tree.kids == 0).sum() > 120  # more leaves than the trunk's sample allows
    got, want = nearest_vectors(df, F.col("vec_id") % 20 == 0, spec).collect(), exact(rows, lambda i: i % 20 == 0)
    check_rows(got, want)
    assert recall(got, want) >= 0.9
    # far fewer leaves than all are enough on clustered vectors, and one visit alone is not
    assert recall(nearest_vectors(df, F.col("vec_id") % 20 == 0, TreeSpec(leaf_rows=20, recall=0.1)).collect(), want) < 0.9


def test_best_bin_first_visits_every_leaf_once():
    tree = fit_tree(clustered(np.random.default_rng(1), 500), 40, TreeSpec(branching=3))
    order = list(tree.leaves_by_nearness(np.ones(16, np.float32)))
    assert sorted(order) == np.flatnonzero(tree.kids == 0).tolist()
    assert (tree.assign(tree.centres[order]) == order).mean() > 0.9


def test_copies_are_exact_whatever_their_number(spark):
    rng = np.random.default_rng(2)
    hot, others = [0.5] * 8, clustered(rng, 300, 8)
    rows = [(i, hot, 0) for i in range(1500)] + [(5000 + i, p.tolist(), 0) for i, p in enumerate(others)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = nearest_vectors(df, F.col("vec_id") % 20 == 0, TreeSpec(leaf_rows=30, block_rows=50, chunk_queries=10)).collect()
    want = exact(rows, lambda i: i % 20 == 0)
    check_rows(got, want)
    for r in got:
        if r["query_id"] < 1500:
            assert (r["score"], r["vec_id"]) == want[r["query_id"], tuple(hot)][r["rank"] - 1]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (200, [1.0, 2.0], None), (0, [0.0, 0.0], 0), (300, None, 0), (400, [], 0), (500, [1.0, None], 0)]
    rows += [(600, [nan, 1.0], 0), (700, [inf, 1.0], 0), (800, [1.0, 2.0, 3.0], 0), (None, [4.0, 4.0], 0), (1, [-0.0, 1.0], 0), (2, [0.0, 1.0], 0), (900, [5.0, 5.0], 0), (900, [6.0, 6.0], 0), (3, [1e30, 1.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("vec", F.lit("x")).withColumn("h1", F.lit(1)).withColumn("rank", F.lit(2))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest_vectors(df, F.col("vec_id") % 100 == 0).collect())
    want = exact(rows, lambda i: i % 100 == 0)
    assert got == sorted((q, n + 1, i, d) for (q, _), near in want.items() for n, (d, i) in enumerate(near))
    assert nearest_vectors(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    one = nearest_vectors(spark.createDataFrame([(100, [1.0], 0)], SCHEMA), F.col("vec_id") % 100 == 0)
    assert one.count() == 0 and one.columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("element", ["float", "double"])
def test_scores_are_exact_distances(spark, element):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, rng.normal(size=3).tolist(), 0) for i in range(60)], SCHEMA.replace("float", element))
    held = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in df.collect()}
    for r in nearest_vectors(df, F.col("vec_id") == 7).collect():
        assert r["score"] == np.sqrt(((held[r["vec_id"]] - held[7]) ** 2).sum())
