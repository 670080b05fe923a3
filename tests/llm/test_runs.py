import hashlib
import random
import zlib

import pytest
from helpers import SCHEMA, SF, WORD, awkward_rows, prose

from geodemand.llm.periodic_runs import RunSpec, periodic_runs, planted, re_pair, run_digest, runs_of
from geodemand.llm.queries import QUERIES
from pyspark.sql import functions as F


def brute(w, least=12):
    """All stretches whose words equal those q on, by (start, length); the least q of an interval is its period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, 2 * q) and i > s:
                found.setdefault((s, i - s + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_text(rng):
    k = rng.choice([1, 2, 3, 5, 30])
    w = [rng.randrange(k) for _ in range(rng.choice([0, 1, 5, 12, 40, 150]))]
    for _ in range(rng.randint(0, 4)):
        u = [rng.randrange(k) for _ in range(rng.randint(1, 9))]
        at = rng.randint(0, len(w))
        w = w[:at] + (u * rng.randint(2, 9))[: rng.randint(1, 60)] + w[at:]
    return w + [rng.randrange(k)] + w + w if rng.random() < 0.3 else w


def test_runs_match_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        texts = [periodic_text(rng) for _ in range(rng.randint(1, 12))]
        for spec in (RunSpec(), RunSpec(min_length=6, batch_pairs=50), RunSpec(min_length=16)):
            assert runs_of(texts, spec) == [brute(w, spec.min_length) for w in texts]


def test_fibonacci_words_and_long_periods():
    a, b = ["a"], ["a", "b"]
    while len(b) < 2000:
        a, b = b, b + a
    assert runs_of([b])[0] == brute(b)
    assert runs_of([[i % 997 for i in range(60_000)], [0] * 100_000]) == [[(0, 60_000, 997)], [(0, 100_000, 1)]]


def test_grammar_spells_the_text():
    import numpy as np

    rng = random.Random(3)
    text = [rng.randrange(6) for _ in range(900)] + [1, 2, 3] * 60
    first = {}
    ids = np.array([first.setdefault(w, i) for i, w in enumerate(text)])
    symbol, start, half, size = re_pair(ids, np.zeros(len(ids), int))
    assert len(symbol) == len(text) - 1  # a binary tree over all words
    spelled = {}
    for x, s, h, n in zip(symbol, start, half, size):
        assert spelled.setdefault(x, (text[s : s + n], h)) == (text[s : s + n], h)
    assert len(spelled) < 0.8 * len(symbol)


def expected(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *longest, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def key(row):
    return tuple((x is not None, x) for x in row)


def test_query_matches_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    want = [expected(*r) for r in docs.where("length(text) < 4000").select("doc_id", "text").collect()]
    assert len(got) == docs.count() and {r for r in want} <= {tuple(r) for r in got}
    assert sum(r["n_runs"] > 0 for r in got) >= 10


def test_edge_rows(spark):
    rows = awkward_rows() + [(500 + i, ("ab cd e " * 20).strip() + "\n", "en", "s", 0) for i in range(60)] + [(None, "x " * 40, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("runs", F.lit(1)).withColumn("start", F.lit(2))
    out = periodic_runs(df.withColumn("text", planted(F.col("text"), F.col("doc_id"))), RunSpec(batch_words=50))
    assert out.columns == [c for c in df.columns if c != "runs"] + ["runs", "collapsed"]
    got = [tuple(r) for r in run_digest(out).collect()]
    assert sorted(got, key=key) == sorted((expected(r[0], r[1]) for r in rows), key=key)
    assert periodic_runs(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", [None, "", " \n\t ", "one"])
def test_texts_without_runs(spark, text):
    r = periodic_runs(spark.createDataFrame([(text,)], "text string")).first()
    assert r["runs"] == [] and r["collapsed"] == " ".join(WORD.findall(text or ""))
