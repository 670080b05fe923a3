"""Approximate nearest neighbours by a hierarchical k-means tree (operator 11).

The tree is fitted on bounded samples: its trunk on one sample of all vectors,
and where that has too few leaves for the table, a branch below each trunk
leaf on a sample of the vectors there. Every vector is then put into a leaf. A
query walks the tree best bin first: a priority queue holds the nodes passed
by, nearest centre first. How many leaves a query visits is calibrated: for
some probes the true neighbours are found by brute force over all rows, and
the visits are widened until they would have reached the wanted share of them.

Visits meet the rows of their leaf in bounded groups: a large leaf is dealt
into blocks, many queries of one leaf into chunks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table, small_side, unit_hash


@dataclass(frozen=True)
class TreeSpec:
    """The ``top`` nearest are searched; ``recall`` is the share of true neighbours the visits are widened to, measured on
    ``probes`` vectors. Leaves aim at ``leaf_rows`` rows, nodes have up to ``branching`` children. About ``sample_rows``
    vectors fit the trunk and ``branch_rows`` each branch, ``fit_rows`` of them a leaf; the centres take at most ``tree_bytes``.
    Blocks have about ``block_rows`` rows, chunks ``chunk_queries`` queries."""

    top: int = 10
    recall: float = 0.94
    probes: int = 256
    leaf_rows: int = 256
    branching: int = 16
    sample_rows: int = 16_384
    branch_rows: int = 4_096
    fit_rows: int = 32
    tree_bytes: int = 32 << 20
    block_rows: int = 4_096
    chunk_queries: int = 2_048
    broadcast_rows: int = 200_000
    seed: int = 11


class Tree:
    """Centres, and each node's first child and number of children (none: a leaf). Children lie together."""

    def __init__(self, centres: np.ndarray, first: np.ndarray, kids: np.ndarray):
        self.centres, self.first, self.kids = centres.astype(np.float32), first, kids
        self.lengths = (self.centres.astype(np.float64) ** 2).sum(1)

    def assign(self, points: np.ndarray) -> np.ndarray:
        """Leaf (node number) of each point: at each node, on to the nearest centre."""
        out, todo = np.zeros(len(points), np.int32), [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if not self.kids[node]:
                out[rows] = node
                continue
            a, b = self.first[node], self.first[node] + self.kids[node]
            nearest = (self.lengths[a:b] - 2 * points[rows] @ self.centres[a:b].T).argmin(1)
            todo += [(int(a + j), rows[nearest == j]) for j in np.unique(nearest)]
        return out

    def leaves_by_nearness(self, query: np.ndarray) -> Iterator[int]:
        """Best bin first: down to the nearest leaf, then from the nearest node that was passed by."""
        passed = [(0.0, 0)]
        while passed:
            node = heapq.heappop(passed)[1]
            while self.kids[node]:
                a, b = int(self.first[node]), int(self.first[node] + self.kids[node])
                apart = ((self.centres[a:b] - query) ** 2).sum(1)
                nearest = int(apart.argmin())
                for j, d in enumerate(apart.tolist()):
                    if j != nearest:
                        heapq.heappush(passed, (d, a + j))
                node = a + nearest
            yield node

    def grafted(self, branches: dict[int, Tree]) -> Tree:
        """With a tree in place of some leaves."""
        parts, first, kids = [self.centres], self.first.copy(), self.kids.copy()
        for leaf, branch in sorted(branches.items()):
            if branch.kids[0]:
                shift = len(kids) - 1  # a branch's root is the leaf itself
                first[leaf], kids[leaf] = branch.first[0] + shift, branch.kids[0]
                parts.append(branch.centres[1:])
                first = np.append(first, np.where(branch.kids[1:] > 0, branch.first[1:] + shift, 0))
                kids = np.append(kids, branch.kids[1:])
        return Tree(np.concatenate(parts), first, kids)


def _clusters(points: np.ndarray, k: int, draw: np.random.Generator, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    centres = points[np.sort(draw.choice(len(points), k, replace=False))].copy()
    for _ in range(rounds):
        of = ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)
        for j in np.unique(of):
            centres[j] = points[of == j].mean(0)
    return ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1), centres


def fit_tree(points: np.ndarray, leaves: int, spec: TreeSpec) -> Tree:
    """Hierarchical k-means: nodes split until a leaf holds about its share of the sample."""
    draw = np.random.default_rng(spec.seed)
    most = max(1, -(-len(points) // max(1, leaves)))
    centres, first, kids = [points.mean(0)], [0], [0]
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        k = min(spec.branching, -(-len(rows) // most))
        if k < 2:
            continue
        of, found = _clusters(points[rows], k, draw)
        held = np.unique(of)
        if len(held) < 2:
            continue  # equal vectors
        first[node], kids[node] = len(centres), len(held)
        for j in held:
            todo.append((len(centres), rows[of == j]))
            centres.append(found[j])
            first.append(0)
            kids.append(0)
    return Tree(np.array(centres), np.array(first, np.int64), np.array(kids, np.int64))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & whole & F.exists(vector, lambda x: x != 0)


def search_rows(vectors: DataFrame, spec: TreeSpec = TreeSpec()) -> DataFrame:
    """(vec_id, vec, h1, h2) of the rows that take part: named, usable, of the most common length, once each.

    Of equal vectors only the ``top + 1`` smallest ids stay as candidates
    (no other can be among the nearest of any row): column ``candidate``.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("vec")).where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    common = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.col("count").desc(), "dim").first()
    rows = rows.where(F.size("vec") == (common["dim"] if common else 0))
    rows = rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(spec.seed), "vec")})
    named = rows.groupBy("h1", "h2", "vec_id").agg(F.count(F.lit(1)).alias("times"))
    if not named.where("times > 1").isEmpty():
        rows = rows.dropDuplicates(["h1", "h2", "vec_id"])
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    leading = named.withColumn("place", F.row_number().over(order)).where(F.col("place") <= spec.top + 2)
    last = F.max(F.when(F.col("place") == spec.top + 1, F.col("vec_id")))
    crowded = leading.groupBy("h1", "h2").agg(last.alias("last"), F.max("place").alias("places")).where(F.col("places") > spec.top + 1)
    crowded = shared_table(vectors.sparkSession, crowded.select("h1", "h2", "last"))
    marked = rows.join(small_side(crowded, spec.broadcast_rows), ["h1", "h2"], "left")
    return marked.select("vec_id", "vec", "h1", "h2", (F.col("last").isNull() | (F.col("vec_id") <= F.col("last"))).alias("candidate"))


def _sampled(rows: DataFrame, share: float | Column, seed: int) -> DataFrame:
    return rows.where(unit_hash(F.col("h1"), F.lit(seed)) < share)


def build_tree(rows: DataFrame, spec: TreeSpec = TreeSpec()) -> Tree:
    """The tree over the vectors of ``rows`` (vec, h1). Samples and centres are bounded, whatever the table's size."""
    spark = rows.sparkSession
    total = rows.count()
    sample = _matrix(_sampled(rows, min(1.0, spec.sample_rows / max(1, total)), spec.seed).select("vec", "h1", "h2").orderBy("h1", "h2").toArrow().column("vec"))
    if not len(sample):
        sample = _matrix(rows.select("vec").limit(1).toArrow().column("vec"))
    dim = sample.shape[1]
    leaves = min(-(-total // spec.leaf_rows), int(spec.tree_bytes / (4 * dim * (1 + 2 / spec.branching))))
    trunk = fit_tree(sample, min(leaves, max(1, spec.sample_rows // spec.fit_rows)), spec)
    if leaves <= spec.sample_rows // spec.fit_rows:
        return trunk
    shared = spark.sparkContext.broadcast(trunk)
    leaf_of = F.arrow_udf(lambda v: pa.array(shared.value.assign(_matrix(v))), "int")
    placed = rows.select("vec", "h1", leaf_of("vec").alias("leaf"))
    held = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # a row per trunk leaf
    share = spark.createDataFrame([(k, min(1.0, spec.branch_rows / v)) for k, v in held.items()], "leaf int, share double")
    drawn = _sampled(placed.join(F.broadcast(share), "leaf"), F.col("share"), spec.seed + 1).select("leaf", "vec")
    per_row = leaves / total

    def fit(group: pa.Table) -> pa.Table:
        points, leaf = _matrix(group.column("vec")), group.column("leaf")[0].as_py()
        points = points[np.lexsort(points.T)]
        tree = fit_tree(points, min(round(held[leaf] * per_row), max(1, len(points) // spec.fit_rows)), spec)
        return pa.table({"leaf": pa.array([leaf], pa.int32()), "centres": [tree.centres.tobytes()], "first": [tree.first.tobytes()], "kids": [tree.kids.tobytes()]})

    fitted = drawn.groupBy("leaf").applyInArrow(fit, "leaf int, centres binary, first binary, kids binary").collect()  # at most tree_bytes of centres
    read = lambda r: Tree(np.frombuffer(r["centres"], np.float32).reshape(-1, dim), np.frombuffer(r["first"], np.int64), np.frombuffer(r["kids"], np.int64))
    return trunk.grafted({r["leaf"]: read(r) for r in fitted})


def _nearest(points: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int | None, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the ``top`` points nearest to the query without its own, ties by id."""
    apart = np.sqrt(((points - query) ** 2).sum(1))
    at = np.flatnonzero(ids != own) if own is not None else np.arange(len(ids))
    if len(at) > top:
        at = at[apart[at] <= np.partition(apart[at], top - 1)[top - 1]]
    at = at[np.lexsort((ids[at], apart[at]))][:top]
    return at, apart[at]


def calibrated_visits(placed: DataFrame, tree: Tree, spec: TreeSpec = TreeSpec()) -> int:
    """Leaves that a query must visit for the wanted share of its true neighbours, measured on probes against all rows (vec_id, vec, h1, leaf)."""
    spark = placed.sparkSession
    order = [F.xxhash64("h1", F.lit(spec.seed + 2)), F.col("vec_id")]
    probes = placed.select("vec_id", "vec", "h1").orderBy(*order).limit(spec.probes).toArrow()
    shared = spark.sparkContext.broadcast((_matrix(probes.column("vec")).astype(np.float64), probes.column("vec_id").to_pylist()))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, own = shared.value
        for batch in batches:
            points, ids = _matrix(batch.column("vec")).astype(np.float64), batch.column("vec_id").to_numpy()
            for i, query in enumerate(asked):
                at, apart = _nearest(points, ids, query, own[i], spec.top)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(ids[at]), batch.column("leaf").take(pa.array(at)), pa.array(apart)], names=["probe", "vec_id", "leaf", "score"])

    kind = placed.schema["vec_id"].dataType.simpleString()
    found = placed.select("vec_id", "vec", "leaf").mapInArrow(nearest, f"probe int, vec_id {kind}, leaf int, score double")
    place = Window.partitionBy("probe").orderBy("score", "vec_id")
    true = found.withColumn("place", F.row_number().over(place)).where(F.col("place") <= spec.top).select("probe", "leaf").collect()  # probes times top rows
    needed = []
    for i, query in enumerate(shared.value[0]):
        visits = {leaf: n + 1 for n, leaf in enumerate(tree.leaves_by_nearness(query.astype(np.float32)))}
        needed += [visits[r["leaf"]] for r in true if r["probe"] == i]
    visits = 1
    while needed and sum(n <= visits for n in needed) < spec.recall * len(needed):
        visits += 1
    return visits


def nearest_vectors(vectors: DataFrame, is_query: Column, spec: TreeSpec = TreeSpec()) -> DataFrame:
    """(query_id, rank, vec_id, score): the rows nearest to each query row of ``vectors`` (vec_id, embedding) among all others.

    ``is_query`` is a condition on ``vec_id``. Score: Euclidean distance in
    double precision; ties go to the smaller vec_id. A vector that is null,
    empty, zero or holds a null or non-finite component takes no part, nor does
    one without an id or of another length than most (the shorter length on a
    tie). Rows equal in id and vector count once. A query's own id is never
    among its results; an id with several vectors is searched once for each.
    Fewer than ``top`` rows come back only if there are no more candidates.
    Other columns are ignored. Vectors are told apart by 128 hash bits.
    """
    spark = vectors.sparkSession
    rows = search_rows(vectors, spec)
    queries = rows.where(is_query).withColumn("own", F.count(F.lit(1)).over(Window.partitionBy("vec_id"))).select("vec_id", "vec", "h1", "own")
    kind = rows.schema["vec_id"].dataType.simpleString()
    candidates = rows.where("candidate").select("vec_id", "vec", "h1", "h2")
    if candidates.isEmpty():
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    tree = build_tree(candidates, spec)
    shared = spark.sparkContext.broadcast(tree)  # at most tree_bytes of centres
    leaf_of = F.arrow_udf(lambda v: pa.array(shared.value.assign(_matrix(v))), "int")
    placed = shared_table(spark, candidates.select("vec_id", "vec", "h1", leaf_of("vec").alias("leaf")))
    held = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # a row per leaf
    least = calibrated_visits(placed, tree, spec)
    counts = spark.sparkContext.broadcast(held)

    @F.arrow_udf("array<int>")
    def visited(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        walk, rows_in = shared.value, counts.value
        for asked, own in batches:
            out = []
            for query, own_rows in zip(_matrix(asked).astype(np.float32), own.to_pylist()):
                leaves, seen = [], 0
                for n, leaf in enumerate(walk.leaves_by_nearness(query)):
                    if n >= least and seen >= spec.top + own_rows:
                        break
                    if rows_in.get(leaf):
                        leaves.append(leaf)
                        seen += rows_in[leaf]
                out.append(leaves)
            yield pa.array(out, pa.list_(pa.int32()))

    visits = shared_table(spark, queries.select("vec_id", "h1", visited("vec", "own").alias("leaves")))
    per_leaf = {r["leaf"]: r["count"] for r in visits.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()}  # a row per leaf
    parts = [(leaf, -(-n // spec.block_rows), -(-per_leaf[leaf] // spec.chunk_queries)) for leaf, n in held.items() if leaf in per_leaf]
    dealt = F.broadcast(spark.createDataFrame(parts, "leaf int, blocks int, chunks int"))
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", "h1", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = visits.join(queries.select("vec_id", "h1", "vec"), ["vec_id", "h1"]).select("vec_id", "h1", "vec", F.explode("leaves").alias("leaf")).join(dealt, "leaf")
    asked = asked.select("leaf", deal("chunks", 1).alias("chunk"), every("blocks").alias("block"), F.col("vec_id").alias("query_id"), "h1", "vec")
    points = placed.join(dealt, "leaf").select("leaf", deal("blocks", 2).alias("block"), every("chunks").alias("chunk"), "vec_id", "vec")

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        points, ids = _matrix(right.column("vec")).astype(np.float64), right.column("vec_id").to_numpy()
        out = []
        if len(ids):
            for i, query in enumerate(_matrix(left.column("vec")).astype(np.float64)):
                at, apart = _nearest(points, ids, query, left.column("query_id")[i].as_py(), spec.top)
                out.append((np.full(len(at), i), ids[at], apart))
        i, found, apart = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), ids[:0], np.zeros(0))
        of = left.select(["query_id", "h1"]).take(pa.array(i))
        return pa.table({"query_id": of.column(0), "h1": of.column(1), "vec_id": pa.array(found), "score": pa.array(apart)})

    keys = ["leaf", "block", "chunk"]
    pairs = asked.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInArrow(match, f"query_id {kind}, h1 long, vec_id {kind}, score double")
    place = Window.partitionBy("query_id", "h1").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= spec.top).select("query_id", "rank", "vec_id", "score")
