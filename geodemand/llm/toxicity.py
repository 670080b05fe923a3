"""Toxicity by a factorization machine over hashed terms (operator 10).

A text is the set of its lower-cased words and their leading letters, hashed
into a fixed number of features. The score is a logistic factorization machine:
a bias, a weight per term and an inner product of term vectors per pair, so
that two terms can mean together what neither means alone.

Only terms whose share of label 1 is far from all texts' take part, in both
halves: among the hundreds of other terms of a text the pairs would learn the
sample by heart.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unit_hash

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class FMSpec:
    """Fitted on a bounded sample of about ``sample_rows`` distinct labelled texts. ``dims`` hashed features
    (a power of two), ``rank`` numbers per term vector, at first about ``spread`` large; terms seen in under
    ``min_docs`` sample texts, or whose labels lie under ``min_z`` standard deviations from chance, are not learned."""

    sample_rows: int = 16_000
    dims: int = 1 << 18
    rank: int = 4
    prefixes: tuple[int, ...] = (4, 5)
    min_docs: int = 3
    min_z: float = 4.0
    epochs: int = 30
    batch: int = 64
    rate: float = 0.1
    pair_rate: float = 0.1
    spread: float = 0.1
    decay: float = 1e-5
    pair_decay: float = 1e-4
    seed: int = 10
    threshold: float = 0.3


class _Terms(dict):
    """Word -> its feature ids; cleared when large, so memory stays bounded."""

    def __init__(self, spec: FMSpec):
        self.spec = spec

    def __missing__(self, word: str) -> tuple[int, ...]:
        mask = self.spec.dims - 1
        ids = [zlib.crc32(b"w" + word.encode()) & mask]
        ids += [zlib.crc32(b"p" + word[:k].encode()) & mask for k in self.spec.prefixes if len(word) >= k]
        if len(self) > 200_000:
            self.clear()
        self[word] = tuple(ids)
        return self[word]


def features(text: str | None, terms: _Terms) -> np.ndarray:
    """Sorted distinct feature ids of a whole text."""
    found = set(WORD.findall(text.lower())) if text else ()
    return np.unique(np.fromiter((i for w in found for i in terms[w]), dtype=np.int32))


@dataclass(frozen=True)
class FMModel:
    bias: float
    weights: np.ndarray  # dims
    vectors: np.ndarray  # dims x rank

    def margin(self, ids: np.ndarray) -> float:
        v = self.vectors[ids]
        pair = 0.5 * float((v.sum(0) ** 2).sum() - (v * v).sum())
        return self.bias + float(self.weights[ids].sum()) + pair

    def score(self, ids: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.margin(ids), -30, 30))))


def fit(rows: list[np.ndarray], labels: np.ndarray, spec: FMSpec = FMSpec()) -> FMModel:
    """Logistic loss by mini-batch AdaGrad; reproducible for the same rows in the same order."""
    rng = np.random.default_rng(spec.seed)
    count = lambda held: np.bincount(np.concatenate(held) if held else np.zeros(0, np.int64), minlength=spec.dims)
    seen, marked = count(rows), count([r for r, y in zip(rows, labels) if y])
    mean = labels.mean() if len(labels) else 0.0
    far = (marked - seen * mean) / np.sqrt(0.5 + seen * mean * (1 - mean) * (1 - seen / max(1, len(rows))))
    learned = (seen >= spec.min_docs) & (np.abs(far) >= spec.min_z)
    rows = [r[learned[r]] for r in rows]
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    bias, gb = float(np.log(share / (1 - share))), 1.0
    w, v = np.zeros(spec.dims), rng.normal(0, spec.spread, (spec.dims, spec.rank))
    v[~learned] = 0.0
    gw, gv = np.full(spec.dims, 1e-1), np.full((spec.dims, spec.rank), 1e-3)
    for _ in range(spec.epochs):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // spec.batch)):
            if not len(part):
                continue
            sizes = np.array([len(rows[i]) for i in part])
            ids = np.concatenate([rows[i] for i in part])
            owner = np.repeat(np.arange(len(part)), sizes)
            active, at = np.unique(ids, return_inverse=True)
            va = v[active]
            sums = np.stack([np.bincount(owner, va[at, k], len(part)) for k in range(spec.rank)], 1)
            squares = np.bincount(owner, (va[at] ** 2).sum(1), len(part))
            z = bias + np.bincount(owner, w[ids], len(part)) + 0.5 * ((sums**2).sum(1) - squares)
            err = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - labels[part]
            e = err[owner] / len(part)
            dw = np.bincount(at, e, len(active)) + spec.decay * w[active]
            es = e[:, None] * sums[owner]
            dv = np.stack([np.bincount(at, es[:, k], len(active)) for k in range(spec.rank)], 1).astype(float)
            dv += (spec.pair_decay - np.bincount(at, e, len(active)))[:, None] * va
            gw[active] += dw**2
            gv[active] += dv**2
            w[active] -= spec.rate * dw / np.sqrt(gw[active])
            v[active] -= spec.pair_rate * dv / np.sqrt(gv[active])
            gb += err.mean() ** 2
            bias -= spec.rate * err.mean() / np.sqrt(gb)
    return FMModel(bias, w.astype(np.float32), v.astype(np.float32))


def train(labelled: DataFrame, label: Column, spec: FMSpec = FMSpec()) -> FMModel:
    """Model from rows with a ``text`` and a 0/1 ``label``; rows with a null label are not used.

    Rows equal in text and label count once, so copies neither weigh more nor
    swell the sample; a text with both labels counts with each.
    """
    rows = labelled.select(F.coalesce("text", F.lit("")).alias("text"), label.cast("int").alias("y")).where("y is not null")
    total = rows.count()  # with copies, so the sample may be smaller than wanted, never larger
    drawn = rows.where(unit_hash("text", F.lit(spec.seed)) < min(1.0, spec.sample_rows / max(1, total)))
    drawn = drawn.groupBy(F.xxhash64("text").alias("h"), "y").agg(F.first("text").alias("text"))

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms = _Terms(spec)
        for texts in batches:
            yield pa.array([features(t.as_py(), terms) for t in texts], pa.list_(pa.int32()))

    got = drawn.select("y", ids(F.col("text")).alias("x"), "h").toArrow().sort_by([("h", "ascending"), ("y", "ascending")])
    x = got.column("x").combine_chunks()
    flat, ends = x.flatten().to_numpy(zero_copy_only=False), np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False)) if len(x) else []
    rows = np.split(flat.astype(np.int64), ends[:-1]) if len(x) else []
    return fit(rows, got.column("y").to_numpy().astype(float), spec)


def score_toxicity(df: DataFrame, model: FMModel, spec: FMSpec = FMSpec()) -> DataFrame:
    """All columns of ``df`` plus ``score`` (0 to 1) and ``predicted`` (1 from the threshold up).

    Only ``text`` is looked at, whole; a null or empty text has no terms and
    gets the bias. Input columns with the two names are replaced.
    """
    # fixed size: dims x (rank + 1) numbers
    shared = df.sparkSession.sparkContext.broadcast((model.bias, model.weights, model.vectors))

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fm, terms = FMModel(*shared.value), _Terms(spec)
        for texts in batches:
            yield pa.array([fm.score(features(t.as_py(), terms)) for t in texts], pa.float64())

    keep = [F.col(f"`{c}`") for c in df.columns if c not in ("score", "predicted")]
    return df.select(*keep, judge(F.col("text")).alias("score")).withColumn("predicted", (F.col("score") >= spec.threshold).cast("int"))
