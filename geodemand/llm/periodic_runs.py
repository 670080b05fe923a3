"""Detection of periodic runs of words over a grammar (operator 12).

A run is a maximal stretch of words with smallest period q that is at least
``max(min_length, 2 * q)`` words long. The word ids of a text are compressed
by Re-Pair; runs that cross the boundary between a nonterminal's two halves
are computed once, in one of its occurrences, then translated to all of them;
overlapping intervals of one period merge into the maximal ones.

Texts are worked on some at a time with numpy, in parallel over all of them:
each Re-Pair round replaces the pairs that are more frequent than the pairs
they touch (the most frequent one always is), and what stays is paired up in a
balanced tree. All comparisons are exact: equal substrings have equal names,
built by doubling their length. Any run holds a repeated ``min_length / 2``-gram,
so a text without one is not looked at further.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunSpec:
    """Runs have at least ``min_length`` (even) words and two periods. ``batch_words`` words, whole texts,
    are worked on at a time, ``batch_pairs`` candidate (boundary, period) pairs at a time."""

    min_length: int = 12
    batch_words: int = 100_000
    batch_pairs: int = 500_000


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each key and whether it occurs more than once."""
    _, rank, times = np.unique(keys, return_inverse=True, return_counts=True)
    return rank, times[rank] > 1


class _Names:
    """Names of the substrings of some texts, laid one after the other: equal substrings of one text, and only they, have equal names."""

    def __init__(self, ids: np.ndarray):
        """ids: equal for equal words of one text only."""
        self.n = len(ids)
        self.levels = [ids.astype(np.int64)]
        self.repeated = [_ranked(ids)[1]]

    def paired(self, left: np.ndarray, right: np.ndarray, gap: int, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Names of the substrings that join ``left[i]`` and ``right[i + gap]``; a lone one has a name of its own."""
        names, again = np.arange(self.n, 2 * self.n, dtype=np.int64), np.zeros(self.n, bool)
        at = np.flatnonzero(where[: max(0, self.n - gap)])
        if len(at):
            rank, twice = _ranked(left[at] * (2 * self.n) + right[at + gap])
            names[at[twice]], again[at[twice]] = rank[twice], True
        return names, again

    def grow(self) -> bool:
        """Names twice as long substrings; false if none of these repeats."""
        names, size = self.levels[-1], 1 << (len(self.levels) - 1)
        twice = self.repeated[-1]
        both = twice.copy()
        both[: max(0, self.n - size)] &= twice[size:]
        names, again = self.paired(names, names, size, both)
        self.levels.append(names)
        self.repeated.append(again)
        return bool(again.any())

    def gram(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of the substrings of ``size`` words, and which repeat."""
        k = size.bit_length() - 1
        while len(self.levels) <= k:
            self.grow()
        names = self.levels[k]
        if size == 1 << k:
            return names, self.repeated[k]
        gap = size - (1 << k)
        both = self.repeated[k].copy()
        both[: max(0, self.n - gap)] &= self.repeated[k][gap:]
        return self.paired(names, names, gap, both)

    def common(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of the longest common extensions of the positions i and j (i < j): to the right from them, to the left before them."""
        right, left = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            size, names = 1 << k, self.levels[k]
            a, b = i + right, j + right
            ok = b < self.n
            right += size * (ok & (names[np.minimum(a, self.n - 1)] == names[np.minimum(b, self.n - 1)]))
            a, b = i - left - size, j - left - size
            ok = a >= 0
            left += size * (ok & (names[np.maximum(a, 0)] == names[np.maximum(b, 0)]))
        return right, left


def _every_other(chosen: np.ndarray) -> np.ndarray:
    """Of each stretch of chosen neighbours the first, third, ..."""
    at = np.arange(len(chosen))
    first = chosen & ~np.append(False, chosen[:-1])
    return chosen & ((at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0)


def re_pair(ids: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Grammar of texts laid one after the other; ``ids`` equal for equal words of one text only, ``owner`` the text of each word.

    Returns all occurrences of the nonterminals: symbol, start, length of its
    left half, length. The pairs left at the end are nonterminals of one
    occurrence each.
    """
    symbol, start, size = ids.astype(np.int64), np.arange(len(ids)), np.ones(len(ids), np.int64)
    owner = owner.copy()
    unused = int(ids.max(initial=0)) + 1
    span = unused + 2 * len(ids)  # more than there can be symbols
    known: dict[int, int] = {}
    fresh, draw = count(unused), np.random.default_rng(len(ids))
    out = []

    def replace(at: np.ndarray, names: np.ndarray) -> None:
        nonlocal symbol, start, size, owner
        out.append((names, start[at], size[at], size[at] + size[at + 1]))
        symbol[at] = names
        size[at] += size[at + 1]
        stay = np.ones(len(symbol), bool)
        stay[at + 1] = False
        symbol, start, size, owner = symbol[stay], start[stay], size[stay], owner[stay]

    while len(symbol) > 1:
        pair = symbol[:-1] * span + symbol[1:]
        inside = owner[:-1] == owner[1:]
        _, kind, times = np.unique(pair, return_inverse=True, return_counts=True)
        # ties in a random order: in any other, neighbours could wait for each other along a whole text
        tie = draw.permutation(len(times))
        rank = np.where(inside & (times[kind] > 1), times[kind] * len(times) + tie[kind], -1)
        if not (rank >= 0).any():
            break
        beside = np.append(-1, rank), np.append(rank, -1)
        at = np.flatnonzero(_every_other((rank >= 0) & (rank >= beside[0][:-1]) & (rank >= beside[1][1:])))
        kinds, which = np.unique(pair[at], return_inverse=True)
        replace(at, np.array([known[k] if k in known else known.setdefault(k, next(fresh)) for k in kinds.tolist()], np.int64)[which])
    while len(symbol) > 1:
        first = np.append(True, owner[1:] != owner[:-1])
        place = np.arange(len(symbol)) - np.maximum.accumulate(np.where(first, np.arange(len(symbol)), 0))
        at = np.flatnonzero((place[:-1] % 2 == 0) & (owner[:-1] == owner[1:]))
        if not len(at):
            break
        replace(at, np.fromiter((next(fresh) for _ in at), np.int64, len(at)))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, counts[i] times: i, and 0, 1, ..."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def _crossing(names: _Names, grams: np.ndarray, again: np.ndarray, start: np.ndarray, half: np.ndarray, size: np.ndarray, spec: RunSpec) -> list[np.ndarray]:
    """(node, offset, length, period) of the runs within each node's words that cross the boundary of its halves."""
    width, n = spec.min_length // 2, len(grams)
    spots = np.flatnonzero(again)
    spots = spots[np.argsort(grams[spots], kind="stable")]  # positions by gram, then place
    ordered = grams[spots] * (n + 1) + spots
    many = np.append(0, np.cumsum(again))
    lo, hi = np.maximum(start, start + half - width), np.minimum(start + half, start + size - width + 1)
    nodes = np.flatnonzero((hi > lo) & (many[np.maximum(hi, 0)] - many[np.minimum(lo, n)] > 0))
    # windows of `width` words over the last word of the left half; one of them, or of its mates a period before, is within the run
    of, step = _spread(hi[nodes] - lo[nodes])
    node, window = nodes[of], lo[nodes][of] + step
    node, window = node[again[window]], window[again[window]]
    begin = np.searchsorted(ordered, grams[window] * (n + 1) + start[node])
    mates = np.searchsorted(ordered, grams[window] * (n + 1) + start[node] + size[node] - width, side="right") - begin
    out = []
    cuts = np.searchsorted(np.cumsum(mates), np.arange(spec.batch_pairs, mates.sum() + spec.batch_pairs, spec.batch_pairs))
    # windows of one node stay together
    cuts = np.unique(np.searchsorted(node, node[np.minimum(cuts, len(node) - 1)], side="right")) if len(node) else []
    for a, b in zip([0, *cuts[:-1]], cuts):
        of, step = _spread(mates[a:b])
        x, w = node[a:b][of], window[a:b][of]
        mate = spots[begin[a:b][of] + step]
        q = np.abs(mate - w)
        ok = (q > 0) & (2 * q <= size[x])
        x, w, mate, q = x[ok], w[ok], mate[ok], q[ok]
        # those on one side with one period lie in one stretch
        one = np.unique((x * 2 + (mate > w)) * (n + 1) + q, return_index=True)[1]
        x, w, mate, q = x[one], w[one], mate[one], q[one]
        i = np.minimum(w, mate)
        right, left = names.common(i, i + q)
        s, e = np.maximum(i - left, start[x]), np.minimum(i + right + q, start[x] + size[x])
        ok = (e - s >= np.maximum(spec.min_length, 2 * q)) & (s < start[x] + half[x]) & (e > start[x] + half[x])
        x, s, e, q = x[ok], s[ok], e[ok], q[ok]
        order = np.lexsort((q, e, s, x))
        x, s, e, q = x[order], s[order], e[order], q[order]
        # multiples of a period give the same interval
        least = np.append(True, (x[1:] != x[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])) if len(x) else np.zeros(0, bool)
        out.append((x[least], (s - start[x])[least], (e - s)[least], q[least]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals: those of one period that overlap by at least it become one; by start, then period."""
    if not len(start):
        return start, end, period
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    reach = int(end.max()) + 1
    group = np.cumsum(np.append(0, period[1:] != period[:-1]))
    furthest = np.maximum.accumulate(end + group * reach) - group * reach
    new = np.append(True, (group[1:] != group[:-1]) | (start[1:] + period[1:] > furthest[:-1]))
    first = np.flatnonzero(new)
    start, end, period = start[first], np.maximum.reduceat(end, first), period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of(texts: list[list], spec: RunSpec = RunSpec()) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs in each list of words, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.append(0, np.cumsum(sizes))
    total = int(base[-1])
    ids = np.zeros(total, np.int64)
    for t, at in zip(texts, base):
        ids[at : at + len(t)] = np.fromiter(map({}.setdefault, t, count(at)), np.int64, len(t))
    owner = np.repeat(np.arange(len(texts)), sizes)
    names = _Names(ids)
    grams, again = names.gram(spec.min_length // 2)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not again.any():
        return out
    while names.grow():
        pass
    looked_at = np.zeros(len(texts), bool)
    looked_at[owner[again]] = True
    place = np.flatnonzero(looked_at[owner])
    symbol, at, half, size = re_pair(ids[place], owner[place])
    at = place[at]  # texts stay whole, so a nonterminal's words are adjacent in both numberings
    order = np.argsort(symbol, kind="stable")
    symbol, at, half, size = symbol[order], at[order], half[order], size[order]
    first = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
    times = np.diff(np.append(first, len(symbol)))
    node, offset, length, period = _crossing(names, grams, again, at[first], half[first], size[first], spec)
    run, nth = _spread(times[node])
    start = at[first[node[run]] + nth] + offset[run]
    start, end, period = _merged(start, start + length[run], period[run])
    text = owner[start]
    for t, s, e, q in zip(text.tolist(), (start - base[text]).tolist(), (end - base[text]).tolist(), period.tolist()):
        out[t].append((s, e - s, q))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, length, q in runs:
        edge[s + q] += 1
        edge[s + length] -= 1
    return b" ".join(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))


def _judged(texts: pa.Array, spec: RunSpec) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs and collapsed text of each text, ``batch_words`` words at a time."""
    held: list[list[bytes]] = []
    words = 0
    for i, text in enumerate(texts):
        held.append((text.as_py() or b"").split())  # bytes split at ASCII white space only
        words += len(held[-1])
        if words >= spec.batch_words or i == len(texts) - 1:
            for w, runs in zip(held, runs_of(held, spec)):
                yield runs, _collapsed(w, runs)
            held, words = [], 0


def periodic_runs(df: DataFrame, spec: RunSpec = RunSpec()) -> DataFrame:
    """All rows and columns of ``df`` (with ``text``) plus ``runs`` and ``collapsed``.

    ``runs``: array of (start, length, period) by start, then period, counted
    in words (runs of characters other than ASCII white space). ``collapsed``:
    the text without the words that any run holds after its first period, the
    rest joined by one space. A null, empty or blank text has no runs and an
    empty ``collapsed``. Each row is judged by itself, whole, nothing is
    shuffled. Input columns with the two names are replaced.
    """
    triple = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    @F.arrow_udf("runs array<struct<start: long, length: long, period: long>>, collapsed string")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ends, flat, rest = [0], [], []
            for runs, collapsed in _judged(texts, spec):
                flat += runs
                ends.append(len(flat))
                rest.append(collapsed)
            columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(triple)))
            yield pa.StructArray.from_arrays([lists, pa.array(rest, pa.binary()).cast(pa.string())], names=["runs", "collapsed"])

    keep = [F.col(f"`{c}`") for c in df.columns if c not in ("runs", "collapsed")]
    judged = df.select(*keep, judge(F.col("text").cast("binary")).alias("__gd_runs"))
    return judged.select(*keep, "__gd_runs.runs", "__gd_runs.collapsed")


def run_digest(judged: DataFrame) -> DataFrame:
    """(doc_id, n_runs, the longest run and digests) of :func:`periodic_runs`' rows; ties of the longest: smallest start, then period."""
    runs = F.col("runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size(runs) > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return judged.select("doc_id", "runs", "collapsed", best.alias("best"), listed.alias("listed")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / (-F.col("best.q"))).cast("long").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def planted(text: Column, doc_id: Column) -> Column:
    """The text, for one document in ten with a periodic tail: with h the crc32 of the decimal doc_id (of the
    empty text for null) and g = h // 10, if h % 10 = 0 each of n words i >= a = g % n becomes word
    a + (i - a) % p, with p = 1 + (n - a) // (3 + g % 8)."""

    @F.arrow_udf("string")
    def plant(texts: pa.Array, hashes: pa.Array) -> pa.Array:
        out = []
        for raw, h in zip(texts, hashes):
            raw, (g, rest) = raw.as_py(), divmod(h.as_py(), 10)
            words = raw.split() if raw and not rest else []
            if words:
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                raw = b" ".join(words[:a] + [words[a + i % p] for i in range(len(words) - a)])
            out.append(raw)
        return pa.array(out, pa.binary()).cast(pa.string())

    return plant(text.cast("binary"), F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")))
