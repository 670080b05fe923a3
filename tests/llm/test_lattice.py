import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SCHEMA, SF, awkward_rows

from geodemand.llm import queries
from geodemand.llm.lattice_lm import START, Lattice, LMModel, LMSpec, count_words, fit, lm_scores, read_pieces
from pyspark.sql import functions as F

PIECES = [START, START + "a", "a", "b", "ab", "ba", "aba", "é", "c" * 20]
LOGS = np.log(np.array([0.1, 0.1, 0.2, 0.1, 0.15, 0.05, 0.1, 0.05, 0.05] + [0.1 / 256] * 256))


def segmentations(word):
    """All ways to write the word with pieces, bytes standing for uncovered characters."""
    if not word:
        return [[]]
    out = [[i, *rest] for i, p in enumerate(PIECES) if word.startswith(p) for rest in segmentations(word[len(p) :])]
    if word[0] not in PIECES:
        raw = [len(PIECES) + b for b in word[0].encode()]
        out += [raw + rest for rest in segmentations(word[1:])]
    return out


WORDS = ["a", "ab", "aba", "abab", "baab", "é", "ü", "aüb", "zé", "abababab", "c" * 20]


def test_forward_sums_all_segmentations():
    lattice = Lattice(PIECES, LOGS, 20)
    got = lattice.log10([START + w for w in WORDS], 3)
    for w, x in zip(WORDS, got):
        ways = segmentations(START + w)
        assert math.isclose(10**x, sum(math.exp(sum(LOGS[i] for i in way)) for way in ways), rel_tol=1e-9), w


def test_expected_uses_match_brute_force():
    lattice = Lattice(PIECES, LOGS, 20)
    want = np.zeros(len(LOGS))
    for w, times in zip(WORDS, range(1, 20)):
        ways = segmentations(START + w)
        p = np.array([math.exp(sum(LOGS[i] for i in way)) for way in ways])
        for way, share in zip(ways, p / p.sum()):
            for i in way:
                want[i] += times * share
    got = sum(lattice.expected([START + WORDS[k] for k in at], np.arange(1.0, 20)[at]) for at in lattice.by_length([START + w for w in WORDS], 4))
    assert np.allclose(got, want)


def test_long_words_agree_with_short_ones(monkeypatch):
    """The path for long words, with blocks smaller than a word, against the one for all words."""
    from geodemand.llm import lattice_lm

    lattice, words = Lattice(PIECES, LOGS, 20), [START + w for w in [*WORDS, "abüé" * 9 + "c" * 41, "z" * 30]]
    want = lattice.log10(words, 3)
    uses = sum(lattice.expected([words[k] for k in at], np.arange(1.0, 20)[at]) for at in lattice.by_length(words, 4))
    monkeypatch.setattr(lattice_lm, "LONG", 0)
    for block in (3, 7, 65_536):
        monkeypatch.setattr(lattice_lm, "LONG_BLOCK", block)
        assert np.allclose(lattice.log10(words, 3), want)
        assert np.allclose(sum(lattice.expected([words[k] for k in at], np.arange(1.0, 20)[at]) for at in lattice.by_length(words, 4)), uses)


def test_a_word_of_a_million_characters_stays_small():
    import subprocess
    import sys

    code = """
import resource
from geodemand.llm.lattice_lm import Lattice, LMSpec, START, read_pieces
import numpy as np
pieces, scores = read_pieces(LMSpec().vocabulary)
lattice = Lattice(pieces, np.log(np.full(len(pieces) + 256, 1e-4)), LMSpec().longest)
rng = np.random.default_rng(1)
word = START + "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/"), 1_000_000))
x = lattice.log10([word], 20_000)[0]
y = lattice.expected([word], np.ones(1))
assert -1e7 < x < -1e5 and y.sum() > 1e5
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=600)
    assert int(got.stdout) < 1000


def test_long_words_do_not_underflow():
    lattice = Lattice(PIECES, LOGS, 20)
    x = lattice.log10([START + "ab" * 5000], 10)[0]
    assert math.isfinite(x) and x < -1000


def test_lookup_finds_every_piece_and_nothing_else():
    pieces, scores = read_pieces(LMSpec().vocabulary)
    assert len(pieces) == len(scores) > 20_000
    lattice = Lattice(pieces, np.zeros(len(pieces) + 256), 64)
    assert (lattice._ids(lattice.hashes) == np.arange(len(pieces))).all()
    other = np.array([Lattice._hash(p + "\x01") for p in pieces], dtype=np.uint64)
    assert (lattice._ids(other) == -1).all()


def test_word_shares_and_spelling_sum_to_one():
    """Over an alphabet of one letter: all words a, aa, ... and the end."""
    pieces, q, end = [START, "a"], np.array([0.5, 0.3]), 0.2
    logs = np.concatenate([np.log(q), np.full(256, -np.inf)])
    lattice = Lattice(pieces, logs, 4)
    begin = q[0] / (q[0] + 0.125)
    model = LMModel(pieces, logs, 1 - begin, 10, 3, 2, 0.6)
    words = ["a" * n for n in range(0, 60)]
    spelled = np.array([lattice.log10([START + w], 10)[0] for w in words])
    # words with the empty one: q0 * sum q1^n, scaled to the share of word starts
    scale = math.log10(begin * (1 - q[1]) / q[0])
    counts = np.array([0, 5, 3] + [0] * 57, dtype=float)
    total = (10 ** model.log10_word(counts, spelled + scale)).sum() + 10 ** model.log10_word(np.array([2.0]), np.array([math.log10(1 - begin)]))[0]
    assert math.isclose(total, 1.0, rel_tol=1e-6)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_base_matches_brute_force(spark):
    out = {r["doc_id"]: r for r in queries.QUERIES["op2_lattice_lm"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    words = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [None] for r in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    assert set(out) == set(words)
    for i, ws in words.items():
        r = out[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_scores_depend_on_the_text_only(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("word", F.lit(1)).withColumn("k", F.lit(2))
    for share in (2e-6, 0.05):
        out = lm_scores(df, F.coalesce(F.col("doc_id") < 120, F.lit(True)), LMSpec(heavy_share=share)).collect()
        assert len(out) == len(rows)
        by = {}
        for r in out:
            by.setdefault(r["n_tokens"], []).append(r)
        assert len(by[1]) == 4 and len({r["score"] for r in by[1]}) == 1
        assert math.isclose(*[r["score"] for r in out if r["doc_id"] in (1, 2)][:2], rel_tol=1e-9)
    nothing = lm_scores(df, F.lit(False)).collect()
    assert len(nothing) == len(rows) and all(r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in nothing)
    assert lm_scores(df.limit(0), F.lit(True)).count() == 0


def test_refitting_raises_the_likelihood_of_the_training_words(spark):
    df = spark.createDataFrame([(1, "banana bandana anab " * 50, None, None, None)], SCHEMA)
    words = count_words(df, F.lit(True))
    found = [START + w for w in ("banana", "bandana", "anab")]
    score = [Lattice(m.pieces, m.logs, 16).log10(found, 10).sum() for m in (fit(words, 1, LMSpec(rounds=r)) for r in (0, 1, 3))]
    assert score[0] < score[1] < score[2]
