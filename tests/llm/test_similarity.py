import itertools
import random
from collections import Counter

import numpy as np
from helpers import SCHEMA, awkward_rows, by_class, groups, prose, similar

from geodemand.llm import line_dedup
from geodemand.llm.components import connected_components
from geodemand.llm.line_dedup import LineSpec, line_classes
from geodemand.llm.ngram_join import JaccardSpec, _frequent_table, _pack, _unpack, _WordHash, ngram_groups, one_per_group, shingles, signatures
from pyspark.sql import functions as F


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(200, 260)] + [(1, k) for k in range(2, 120)] + [(rng.randint(300, 420), rng.randint(300, 420)) for _ in range(90)]
    links += [(5, 5), (None, 7), (1, 2), (2, 1)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = groups({x for p in real for x in p}, real)
    assert {r["node"]: r["root"] for r in got} == {n: r for n, r in want.items() if n != r}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def near_copies(rng, n_groups, copies, words):
    rows, i = [], 0
    for _ in range(n_groups):
        base = prose(rng, words).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = prose(rng, 1) + "x"
            rows.append((i, " ".join(w), "en", "s", 0))
            i += 1
    return rows


def word_sets(rows, n=3):
    out = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        out[i] = frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
    return out


def test_join_matches_brute_force_with_rare_and_frequent_tokens(spark):
    rng = random.Random(9)
    rows = near_copies(rng, 6, 25, 90) + [(1000 + i, prose(rng, rng.randint(0, 12)), "en", "s", 0) for i in range(120)]
    rows += [(2000 + i, "boiler plate line that many share " + prose(rng, 8), "en", "s", 0) for i in range(40)]
    sets = word_sets(rows)
    want = groups(sets, similar(sets, 90))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for frequent_at, table_bits, pairs_from in ((0, 24, 512), (3, 24, 512), (10_000, 24, 64), (5, 8, 512)):
        got = ngram_groups(df, JaccardSpec(frequent_at=frequent_at, table_bits=table_bits, pairs_from=pairs_from)).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want, frequent_at
        assert {r["doc_id"]: r["n_shingles"] for r in got} == {k: len(s) for k, s in sets.items()}
    wide = word_sets(rows, 5)
    got = ngram_groups(df, JaccardSpec(n=5, percent=80, frequent_at=3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == groups(wide, similar(wide, 80))
    kept = sorted(r["doc_id"] for r in one_per_group(ngram_groups(df), df.columns).collect())
    assert kept == sorted(set(want.values()))


def test_no_allowed_difference_escapes_the_signatures():
    """Whatever few tokens two sets differ in, their signatures meet."""
    rng = np.random.default_rng(1)
    for frequent_share, percent, pairs_from in itertools.product((0.0, 0.5, 0.9, 1.0), (80, 90), (32, 128, 512)):
        spec = JaccardSpec(percent=percent, pairs_from=pairs_from)
        flags = rng.random(1 << spec.table_bits) < frequent_share
        for _ in range(60):
            n = int(rng.integers(2, 300))
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            drop = int(rng.integers(0, len(a) * (100 - percent) // 100 + 1))
            b = np.delete(a, rng.choice(len(a), drop, replace=False)) if drop else a
            add = max(0, 100 * len(b) // percent - len(a))
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, add, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = (set(signatures(t, flags, spec)[0].tolist()) for t in (a, b))
                assert x & y or (len(a) == len(b) == both)


def test_join_edge_rows(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("component_id", F.lit("x")).withColumn("set", F.lit(1)).withColumn("n", F.lit(2)).withColumn("root", F.lit("r"))
    out = ngram_groups(df).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[2]["component_id"] == by_id[3]["component_id"] == 1
    assert by_id[10]["component_id"] == 9
    assert by_id[4]["n_shingles"] == by_id[5]["n_shingles"] == by_id[6]["n_shingles"] == 0
    assert all(by_id[i]["component_id"] == i for i in (4, 5, 6, 7))
    assert ngram_groups(df.limit(0)).count() == 0
    once = one_per_group(ngram_groups(df), df.columns).collect()
    assert sum(r["doc_id"] in (1, 2, 3) for r in once) == 1 and sum(r["doc_id"] in (4, 5, 6) for r in once) == 3


def grams(line, n=8):
    return frozenset(line[i : i + n] for i in range(max(1, len(line) - n + 1)))


def test_lines_match_brute_force(spark):
    rng = random.Random(10)
    bases = [prose(rng, 40) for _ in range(8)]
    lines = []
    for b in bases:
        for _ in range(20):
            w = b.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "zzz"
            lines.append(" ".join(w))
    lines += [prose(rng, rng.randint(1, 6)) for _ in range(60)] + ["é漢字 " * 5, "é漢字 " * 5 + "x", "short", "short "]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[k : k + 4]) + "\n\n", "en", "s", 0) for i, k in enumerate(range(0, len(lines), 4))]
    out = line_classes(spark.createDataFrame(rows, SCHEMA).repartition(3), LineSpec(bands=24)).collect()
    texts = {(i, k): t.strip(" ") for i, text, *_ in rows for k, t in enumerate(text.split("\n"))}
    assert {(r["doc_id"], r["line_no"]) for r in out} == set(texts)
    sets = {t: grams(t) for t in set(texts.values()) if t}
    want = groups(sets, similar(sets, 80))
    classes = by_class(((r["doc_id"], r["line_no"]), r["component"]) for r in out if r["component"] is not None)
    assert classes == by_class((k, want[t]) for k, t in texts.items() if t)
    for c in classes:
        assert [(r["doc_id"], r["line_no"]) for r in out if r["kept"] and (r["doc_id"], r["line_no"]) in c] == [min(c)]
    assert all(r["kept"] and r["component"] is None for r in out if not texts[r["doc_id"], r["line_no"]])


def test_recall_at_production_parameters(spark):
    """Pairs of lines at a similarity of 0.8 to 0.87, by length: nine in ten of them must be found, by brute force over each pair."""
    rng = random.Random(14)
    letters = "abcdefghijklmnopqrstuvwxyz "
    for length in (80, 120, 200, 400, 1200):
        lines, pairs = [], []
        while len(pairs) < 150:
            a = "".join(rng.choices(letters, k=length)).strip()
            b = list(a)
            for _ in range(max(1, round(length * 0.0135))):
                b[rng.randrange(len(b))] = rng.choice("XYZ")
            x, y = grams(a), grams("".join(b))
            if 0.8 <= len(x & y) / len(x | y) <= 0.87:
                pairs.append((len(lines), len(lines) + 1))
                lines += [a, "".join(b)]
        df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(lines)], SCHEMA)
        of = {r["doc_id"]: r["component"] for r in line_classes(df).collect()}
        assert sum(of[i] == of[j] for i, j in pairs) >= 0.97 * len(pairs), length
        assert len(set(of.values())) >= len(pairs)  # and nothing else links


def test_links_between_components_are_verified_about_once(spark, monkeypatch):
    """Lines that share a passage behind leads of their own: most pairs are links, but few of them are needed."""
    rng = random.Random(21)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n)).strip()
    passage = "A" + some(400) + "Z"
    lines = [some(rng.randint(5, 95)) + passage for _ in range(150)]
    verified, real = [], line_dedup._linked
    monkeypatch.setattr(line_dedup, "_linked", lambda pairs, *a: verified.append(pairs.count()) or real(pairs, *a))
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(lines)], SCHEMA)
    out = line_classes(df).collect()
    sets = dict(enumerate(map(grams, lines)))
    links = similar(sets, 80)
    assert by_class((r["doc_id"], r["component"]) for r in out) == by_class(groups(sets, links).items())
    assert len(links) > 20 * len(lines) and sum(verified) < 4 * len(lines)


def test_line_ends_are_trimmed_of_white_space_only(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(["é", " \té\x0b ", "\u00a0é", "é\r", "\x1fé", " ", "\t\r", "", "a b "])]
    got = {(r["doc_id"], r["line"]): r["lid"] for r in line_dedup.lines_of(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {(i, t.strip(" \t\n\x0b\x0c\r")) for i, t, *_ in rows}
    assert all((lid is None) == (line == "") for (_, line), lid in got.items())


def test_line_edge_rows(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("line", F.lit(1)).withColumn("lid", F.lit(2))
    out = line_classes(df).collect()
    assert len(out) == sum(len(r[1].split("\n")) for r in rows if r[1] is not None)
    for c in {r["component"] for r in out if r["component"] is not None}:
        assert sum(r["kept"] for r in out if r["component"] == c) == 1
    assert line_classes(df.limit(0)).count() == 0
    twice = line_classes(spark.createDataFrame([(None, "a line of its own", None, None, None)] * 3, SCHEMA)).collect()
    assert len(twice) == 3 and sum(r["kept"] for r in twice) == 1


def test_frequent_tokens_are_counted_over_all_batches(spark):
    """Counts per batch add up, whatever the batches and slices; packed columns come back as they were."""
    rng = np.random.default_rng(5)
    tokens = np.unique(rng.integers(0, 2**32, 1000, dtype=np.uint64).astype(np.uint32))
    for part in (tokens, tokens[:0], tokens[:1]):
        times = rng.integers(1, 10**9, len(part))
        back = _unpack(_pack(part, times))
        assert (back[0] == part).all() and (back[1] == times).all()

    texts = [f"hot words here now {i}" for i in range(400)] + ["a b c d"] * 30 + ["p q r s"] * 50 + ["", " ", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(9)
    seen = Counter()
    for t in texts:
        if t and t.strip():
            seen.update({int(x) >> 32 for x in shingles(t, 3, _WordHash())})
    for spec in (JaccardSpec(), JaccardSpec(count_slice=100)):
        flags = _frequent_table(df, spec)
        assert set(np.flatnonzero(flags)) == {x >> (32 - spec.table_bits) for x, n in seen.items() if n > spec.frequent_at}
