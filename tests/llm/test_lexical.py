import math
import random
import re
from collections import Counter

import numpy as np
from helpers import SCHEMA, awkward_rows, prose

from geodemand.llm.lexical_search import SearchSpec, _Block, _grouped, ranked_search, terms_of
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top=10):
    """The contract's formula over every pair."""
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for i, c in found:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            pts = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c
            )
            if pts > 0:
                scored.append((-pts, i is None, i, pts))
        out += [(item, k + 1, i, pts) for k, (_, _, i, pts) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    docs = [(i, prose(rng, rng.randint(1, 60)) + rng.choice(["", " Ünï-cødé rare", " X1 x1 X1", "\n\x00tail"])) for i in range(n)]
    items = [(k, prose(rng, rng.randint(1, 40)) + rng.choice(["", " rare x1", " ünï ÜNÏ"])) for k in range(25)]
    return docs, items


def test_terms_follow_the_pattern():
    for text in ("Don't STOP-me now_2", "ÀÉ x\x00y\x7fz", "a　b  c", "", "Æther's 3.14 €5", " İstanbul ß"):
        assert [t.decode() for t in terms_of(text.encode())] == terms(text)
    assert terms_of(None) == []


def test_search_matches_brute_force(spark):
    docs, items = corpus(1, 300)
    docs += [(1000 + k, docs[7][1]) for k in range(40)]  # copies tie and go by id
    df, asked = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, ITEMS)
    want = brute(docs, items)
    for spec in (SearchSpec(), SearchSpec(block_docs=17, step=1), SearchSpec(chunk_terms=60, block_docs=64, step=3)):
        assert rows_of(ranked_search(df, asked, spec)) == want
    assert rows_of(ranked_search(df, asked, SearchSpec(top=3))) == brute(docs, items, 3)


def test_items_of_more_than_64_terms(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(200)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(5, 150)))) for i in range(120)]
    items = [(1, " ".join(vocabulary)), (2, " ".join(rng.sample(vocabulary, 90)) + " w3 w3 w3")]
    assert rows_of(ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_masks_are_grouped_and_late_groups_are_not_scored():
    rng = np.random.default_rng(0)
    masks = rng.random((130, 400)) < 0.02
    masks[:, 200:] = masks[:, :200]
    kinds, group = _grouped(masks)
    assert (kinds[:, group] == masks).all() and kinds.shape[1] == len({c.tobytes() for c in masks.T})
    # one rare, heavy term in 20 documents: the thousands with the light term alone never need a score
    n = 5000
    ends = np.cumsum(np.append(0, np.where(np.arange(n) < 20, 2, 1)))
    terms = np.concatenate([[0, 1] if i < 20 else [1] for i in range(n)]).astype(np.int64)
    block = _Block(np.full(n, 10), ends, terms, np.ones(len(terms), np.int64), n, 10 * n)
    scored, real = [], block.scores
    block.scores = lambda docs, worth: scored.append(len(docs)) or real(docs, worth)
    gains = np.array([9000, 1], np.int64)
    at, pts = block.search(np.array([0, 1]), gains, gains, np.arange(n), SearchSpec(step=4))
    assert sum(scored) == 20 and at.tolist() == list(range(10)) and (np.diff(pts) <= 0).all()


def test_edge_rows(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("n", F.lit(1)).withColumn("terms", F.lit(2)).withColumn("item_id", F.lit(3))
    items = [(1, rows[0][1]), (1, rows[0][1]), (2, None), (3, ""), (4, "!? .."), (None, "one two"), (5, "nowhere-to-be-found zzzz"), (6, "é 12 34")]
    asked = spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit(9)).withColumn("rank", F.lit(9))
    out = ranked_search(df, asked)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(out) == brute([(r[0], r[1]) for r in rows], items)
    assert ranked_search(df.limit(0), asked).count() == 0 and ranked_search(df, asked.limit(0)).count() == 0
    # two texts under one id are searched and ranked apart
    twice = rows_of(ranked_search(df, spark.createDataFrame([(1, "one"), (1, rows[0][1])], ITEMS)))
    assert twice == brute([(r[0], r[1]) for r in rows], [(1, "one"), (1, rows[0][1])])
