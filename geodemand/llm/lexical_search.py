"""Ranked lexical search by presence masks (operator 13).

Documents become compact postings of the items' terms, once. A block of
postings is then searched by one task: for each item, term bitmaps give every
document its mask of matched terms, equal masks form a group, and groups are
evaluated by descending maximum score until the next one can't reach the best
ones found. A block yields at most ``top`` documents an item, so what is
merged does not grow with the matches.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import shared_table

_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAPS = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes.maketrans(_GAPS + _LETTERS, b" " * len(_GAPS) + _LETTERS.lower())


@dataclass(frozen=True)
class SearchSpec:
    """``top`` documents an item; items are searched ``chunk_terms`` terms (in all, about) at a time, so that
    what workers hold is bounded; ``block_docs`` documents form a block; ``step`` documents of the
    leading groups are scored first, then twice as many each time."""

    top: int = 10
    chunk_terms: int = 200_000
    block_docs: int = 8_192
    step: int = 64


def terms_of(raw: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters and digits and of all other non-ASCII characters, A-Z lower-cased."""
    return raw.translate(_FOLD).split() if raw else []


def _counted(text: Column) -> Column:
    """Distinct terms of a UTF-8 text with their counts, in order."""

    @F.arrow_udf("array<struct<term: binary, times: int>>")
    def count(texts: pa.Array) -> pa.Array:
        kind = pa.struct([("term", pa.binary()), ("times", pa.int32())])
        return pa.array([[{"term": t, "times": k} for t, k in sorted(Counter(terms_of(x.as_py())).items())] for x in texts], pa.list_(kind))

    return count(text.cast("binary"))


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of all documents: n counts all terms, the lists hold those of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most chunk_terms entries

    @F.arrow_udf("n long, terms array<int>, tfs array<int>")
    def post(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for texts in batches:
            sizes, ends, terms, tfs = [], [0], [], []
            for text in texts:
                found = terms_of(text.as_py())
                sizes.append(len(found))
                held = Counter(found)
                for t in held.keys() & known.keys():
                    terms.append(known[t])
                    tfs.append(held[t])
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), *lists], names=["n", "terms", "tfs"])

    return docs.select("doc_id", post(F.col("text").cast("binary")).alias("p")).select("doc_id", "p.*")


def _grouped(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a bit matrix (terms x documents): (terms x groups), group of each document."""
    packed = np.packbits(masks, axis=0)
    wide = np.zeros((-(-len(packed) // 8) * 8, masks.shape[1]), np.uint8)
    wide[: len(packed)] = packed
    parts = np.ascontiguousarray(wide.T).view(np.uint64)
    group = np.zeros(len(parts), np.int64)
    for part in parts.T:  # one round for every 64 terms
        values, code = np.unique(part, return_inverse=True)
        group = np.unique(group * len(values) + code, return_inverse=True)[1]
    first = np.unique(group, return_index=True)[1]
    return masks[:, first], group


class _Block:
    """Postings of some documents, by document and by term, with each posting's impact."""

    def __init__(self, sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_docs: int, total: int):
        self.ends, self.terms = ends, terms
        self.doc = np.repeat(np.arange(len(sizes)), np.diff(ends))
        m = 25 + (75 * sizes * n_docs) // max(1, total)
        self.impact = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[self.doc])
        order = np.argsort(terms, kind="stable")
        self.by_term_doc, sorted_terms = self.doc[order], terms[order]
        self.held, at = np.unique(sorted_terms, return_index=True)
        self.at = np.append(at, len(terms))
        self.most = np.maximum.reduceat(self.impact[order], at) if len(at) else np.zeros(0, np.int64)

    def scores(self, docs: np.ndarray, worth: np.ndarray) -> np.ndarray:
        """worth: what one unit of a term's impact adds, by term."""
        lengths = self.ends[docs + 1] - self.ends[docs]
        at = np.repeat(self.ends[docs] - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
        gains = np.append(0, np.cumsum(worth[self.terms[at]] * self.impact[at]))
        to = np.cumsum(lengths)
        return gains[to] - gains[to - lengths]

    def search(self, terms: np.ndarray, gains: np.ndarray, worth: np.ndarray, ids: np.ndarray, spec: SearchSpec) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of an item's best documents. ``ids``: each document's place in the order of ties."""
        at = np.minimum(np.searchsorted(self.held, terms), max(0, len(self.held) - 1))
        hit = self.held[at] == terms if len(self.held) else np.zeros(len(terms), bool)
        at, gains = at[hit], gains[hit]
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if not len(at):
            return found
        masks = np.zeros((len(at), len(ids)), bool)
        for row, k in zip(masks, at):
            row[self.by_term_doc[self.at[k] : self.at[k + 1]]] = True
        any_term = np.flatnonzero(masks.any(0))
        kinds, group = _grouped(masks[:, any_term])
        highest = (gains * self.most[at]) @ kinds  # the most that a document with just these terms can score
        order = np.argsort(-highest, kind="stable")
        members = any_term[np.argsort(np.argsort(order, kind="stable")[group], kind="stable")]
        until = np.cumsum(np.bincount(group)[order])
        done, step, best_docs, best = 0, spec.step, *found
        while done < len(members):
            k = int(np.searchsorted(until, done, side="right"))  # the next group
            if len(best) == spec.top and highest[order[k]] < best[-1]:
                break
            upto = int(until[min(len(until) - 1, np.searchsorted(until, done + step))])
            docs = members[done:upto]
            pool, pts = np.append(best_docs, docs), np.append(best, self.scores(docs, worth))
            keep = np.lexsort((ids[pool], -pts))[: spec.top]
            keep = keep[pts[keep] > 0]
            best_docs, best, done, step = pool[keep], pts[keep], upto, 2 * step
        return best_docs, best


def _search(docs: DataFrame, items: list[Row], spec: SearchSpec) -> DataFrame:
    """(slot, doc_id, score): the best documents of each item (its place in ``items``)."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(p["term"]) for r in items for p in r["terms"]}))}
    posted = shared_table(spark, _postings(docs, vocabulary))
    n_docs, total = posted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in posted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most one row a term of the chunk
        weight[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    wanted = []
    for r in items:
        terms = np.array([vocabulary[bytes(p["term"])] for p in r["terms"]], np.int64)
        wanted.append((terms, weight[terms] * np.array([p["times"] for p in r["terms"]], np.int64)))
    shared = spark.sparkContext.broadcast((wanted, len(vocabulary)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, n_terms = shared.value
        worth = np.zeros(n_terms, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, spec.block_docs):
                part = batch.slice(lo, spec.block_docs)
                ids, terms, tfs = part.column("doc_id"), part.column("terms"), part.column("tfs")
                ends = np.append(0, np.cumsum(terms.value_lengths().to_numpy())).astype(np.int64)
                flat = [x.flatten().to_numpy().astype(np.int64) for x in (terms, tfs)]
                block = _Block(part.column("n").to_numpy().astype(np.int64), ends, *flat, n_docs, total)
                ties = np.empty(len(ids), np.int64)
                ties[pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                slots, places, scores = [], [], []
                for slot, (words, gains) in enumerate(asked):
                    worth[words] = gains
                    at, pts = block.search(words, gains, worth, ties, spec)
                    worth[words] = 0
                    slots.append(np.full(len(at), slot, np.int32))
                    places.append(at)
                    scores.append(pts)
                if slots:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(slots)), ids.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(scores))], names=["slot", "doc_id", "score"])

    kind = posted.schema["doc_id"].dataType.simpleString()
    return posted.where("size(terms) > 0").mapInArrow(search, f"slot int, doc_id {kind}, score long")


def ranked_search(docs: DataFrame, items: DataFrame, spec: SearchSpec = SearchSpec()) -> DataFrame:
    """(item_id, rank, doc_id, score): the highest-scoring rows of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Weights and lengths are taken over all documents with a term. A null or
    empty text has no terms: such an item gets no rows, such a document is
    never found. Only scores above 0 count; equal scores go by doc_id, null
    ids last. Rows of ``docs`` that repeat are documents of their own. Rows of
    ``items`` equal in id and text are one item; several texts of one id are
    searched and ranked apart. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    counted = items.select("item_id", "text").distinct().select("item_id", F.xxhash64("text").alias("item"), _counted(F.col("text")).alias("terms"))
    held = shared_table(spark, counted.where("size(terms) > 0"))
    total = held.agg(F.sum(F.size("terms"))).first()[0] or 0
    parts = max(1, -(-total // spec.chunk_terms))
    found = []
    for part in range(parts):
        chunk = held.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(parts)) == part).orderBy("item_id", "item").collect()
        names = spark.createDataFrame([(i, r["item_id"], r["item"]) for i, r in enumerate(chunk)], f"slot int, item_id {held.schema['item_id'].dataType.simpleString()}, item long")
        best = _search(docs, chunk, spec).join(F.broadcast(names), "slot").drop("slot")
        found.append(best if parts == 1 else shared_table(spark, best))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    place = Window.partitionBy("item_id", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= spec.top)
    return ranked.select("item_id", "rank", "doc_id", "score")
