"""Fixtures shared by the text operator tests: awkward rows, and plain Python versions of the contracts."""

import random
import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def prose(rng, n, syllables=("er", "the", "on", "ti", "an", "sh", "wh", "ou", "ble", "ing")):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def awkward_rows():
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows."""
    rng = random.Random(4)
    long = "\n".join(prose(rng, 400) for _ in range(30))
    base = prose(rng, 120)
    rows = [
        (1, base, "en", "a", 5), (2, base, "en", "a", 5), (2, base, "en", "a", 5), (3, base.upper(), None, None, None),
        (4, None, "fr", "b", 0), (5, "", "fr", "b", 0), (6, " \t\n\x0b ", None, "b", 0), (None, prose(rng, 60), "fr", None, 1),
        (None, None, None, None, None), (7, long, "en", "a", 9), (8, "12 34 !!", "en", "c", 2), (9, "one", "en", "c", 2), (10, "one", "en", "c", 2),
        (11, base.replace(base.split()[60], "changed", 1), "en", "c", 1), (-3, prose(rng, 70) + "\n" + base, "en", "é", 1),
    ]
    return rows + [(100 + i, prose(rng, rng.randint(1, 200)), "en", rng.choice("abc"), 1) for i in range(30)]


def groups(nodes, links):
    """Root per node by union-find, the least node of each component."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def similar(sets, percent):
    """Pairs of keys whose sets have Jaccard >= percent / 100 (empty sets link with nothing)."""
    keys = [k for k in sets if sets[k]]
    out = []
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * len(sets[a] | sets[b]):
                out.append((a, b))
    return out


def by_class(pairs):
    """Set of the classes that (member, class) pairs describe."""
    out = defaultdict(set)
    for member, c in pairs:
        out[c].add(member)
    return {frozenset(v) for v in out.values()}
