"""Language-model scoring over a subword lattice (operator 2).

A text is a run of words and one end. A word's probability sums over all ways
to spell it with the pieces of an existing vocabulary (forward recursion in log
space), each piece weighted by a unigram score. The vocabulary and its ranking
are given and stay as they are; the scores start from the ranking and are
refitted to the training words by expectation maximisation. Whole words seen in
training are arcs of the lattice too (absolute discounting decides how much
weight they leave to spelling). No piece spans a word boundary, so a
document's marginal probability is the product over its words and the end.

Spark counts the words of the corpus, computes each distinct word's lattice
once, and joins words back to texts. Frequent words (a bounded number, since a
share of all tokens is asked for) travel to the scan instead, so no word is a
hot join key.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, shared_table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"


@dataclass(frozen=True)
class LMSpec:
    """``heavy_share``: words with at least this share of the training tokens (at most its
    reciprocal many) are looked up during the scan. ``rounds`` of EM over all training words.
    ``smooth``: counts that the ranking's prior adds, as a share of all expected counts."""

    vocabulary: str = VOCABULARY
    heavy_share: float = 2e-6
    rounds: int = 1
    smooth: float = 1e-3
    longest: int = 16
    chunk: int = 20_000


def read_pieces(path: str) -> tuple[list[str], np.ndarray]:
    """Word pieces of a vocabulary file and their scores; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    kept = [i for i in ids if START not in model.id_to_piece(i)[1:] and len(model.id_to_piece(i)) <= 64]
    return [model.id_to_piece(i) for i in kept], np.array([model.get_score(i) for i in kept])


BASE = np.uint64(0x100000001B3)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
SLOT_BITS = 20
# Longer words are worked on one by one, with the arcs that exist only, this many positions at a time.
LONG, LONG_BLOCK = 256, 65_536


class Lattice:
    """Piece lookup by substring hash, and forward and backward sums over many words of one length at once.

    ``logs``: natural log probability per piece, then per byte value (256), for
    characters that no piece covers.
    """

    def __init__(self, pieces: list[str], logs: np.ndarray, longest: int):
        self.pieces, self.logs, self.longest = pieces, logs, min(longest, max(map(len, pieces), default=1))
        self.single = {p: i for i, p in enumerate(pieces) if len(p) == 1}
        self.hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        self.slots = []  # lookup tables: what collides in one goes to the next
        left, shift = np.arange(len(pieces)), 0
        while len(left):
            table = np.full(1 << SLOT_BITS, -1, np.int32)
            at = self._slot(self.hashes[left], shift)
            table[at] = left
            left, shift = left[table[at] != left], shift + 7
            self.slots.append(table)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for ch in piece:
            h = (h * int(BASE) + ord(ch) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def _slot(h: np.ndarray, shift: int) -> np.ndarray:
        return ((h * SPREAD) >> np.uint64(64 - SLOT_BITS - shift) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)

    def _ids(self, h: np.ndarray) -> np.ndarray:
        """Piece index per hash, -1 where there is none."""
        out = np.full(h.shape, -1, np.int32)
        for k, table in enumerate(self.slots):
            found = table[self._slot(h, 7 * k)]
            hit = (found >= 0) & (self.hashes[found] == h)
            out[hit] = found[hit]
        return out

    def _arcs(self, words: list[str]) -> tuple[np.ndarray, dict[tuple[int, int], np.ndarray], dict]:
        """Characters, piece index per (start, end), and log probability of uncovered characters."""
        n = len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n).astype(np.uint64)
        sums = np.zeros((len(words), n + 1), np.uint64)
        for j in range(n):
            sums[:, j + 1] = sums[:, j] * BASE + chars[:, j] + np.uint64(1)
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.longest, BASE)]), dtype=np.uint64)
        arcs = {}
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                arcs[i, j] = self._ids(sums[:, j] - sums[:, i] * powers[j - i])
        spelled = {}
        for i in range(n):
            bare = np.flatnonzero(arcs[i, i + 1] < 0)
            if len(bare):
                raw = {c: chr(c).encode("utf-8", "replace") for c in set(chars[bare, i].tolist())}
                spelled[i] = (bare, [raw[c] for c in chars[bare, i].tolist()])
        return chars, arcs, spelled

    def _weight(self, arcs, spelled, i: int, j: int) -> np.ndarray:
        ids = arcs[i, j]
        w = np.where(ids >= 0, self.logs[ids], -np.inf)
        if j == i + 1 and i in spelled:
            rows, raw = spelled[i]
            of = {r: sum(self.logs[len(self.pieces) + b] for b in r) for r in set(raw)}
            w[rows] = [of[r] for r in raw]
        return w

    def forward(self, words: list[str], weights: dict | None = None, arcs=None, spelled=None) -> np.ndarray:
        """Log of the summed weight of all segmentations up to each position: words x (length + 1)."""
        if arcs is None:
            _, arcs, spelled = self._arcs(words)
        n = len(words[0])
        alpha = np.full((len(words), n + 1), -np.inf)
        alpha[:, 0] = 0.0
        for j in range(1, n + 1):
            terms = []
            for i in range(max(0, j - self.longest), j):
                w = self._weight(arcs, spelled, i, j) if weights is None else weights[i, j]
                terms.append(alpha[:, i] + w)
            alpha[:, j] = _log_sum(terms)
        return alpha

    def _sparse(self, word: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, bytes]]]:
        """Arcs of one long word by their end, a block of positions at a time: (start, end, piece, weight), and the bytes of
        the characters that no piece covers (piece -1), by their start."""
        chars = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(chars)
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.longest, BASE)]), dtype=np.uint64)
        tail = np.zeros(1, np.uint64)  # running hashes at the positions just before the block
        for a in range(0, n, LONG_BLOCK):
            some = chars[a : a + LONG_BLOCK].astype(np.uint64) + np.uint64(1)
            sums = np.empty(len(tail) + len(some), np.uint64)
            sums[: len(tail)], h = tail, int(tail[-1])
            for k, c in enumerate(some.tolist(), len(tail)):
                h = (h * int(BASE) + c) & 0xFFFFFFFFFFFFFFFF
                sums[k] = h
            ends = np.arange(len(tail), len(sums))
            found = []
            for size in range(1, min(self.longest, len(sums) - 1) + 1):
                e = ends[ends >= size]
                ids = self._ids(sums[e] - sums[e - size] * powers[size])
                hit = np.flatnonzero((ids >= 0) | (size == 1))
                found.append((e[hit] - size, e[hit], ids[hit]))
            s, e, ids = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(e, kind="stable")
            shift = a - len(tail) + 1
            s, e, ids = s[order] + shift, e[order] + shift, ids[order]
            weight, bare = np.where(ids >= 0, self.logs[ids], 0.0), np.flatnonzero(ids < 0)
            raw = {int(s[k]): chr(chars[s[k]]).encode("utf-8", "replace") for k in bare}
            weight[bare] = [sum(self.logs[len(self.pieces) + b] for b in raw[int(s[k])]) for k in bare]
            yield s, e, ids, weight, raw
            tail = sums[-self.longest :]

    def _walk(self, arcs: Iterator, n: int, back: bool = False) -> np.ndarray:
        """Log of the summed weight of all ways to each position of a long word, or from it to the end."""
        out = [-math.inf] * (n + 1)
        out[n if back else 0] = 0.0
        for s, e, _, weight, _ in arcs:
            rows = zip(e.tolist(), s.tolist(), weight.tolist()) if back else zip(s.tolist(), e.tolist(), weight.tolist())
            for x, y, w in reversed(list(rows)) if back else rows:
                w += out[x]
                high, low = (w, out[y]) if w > out[y] else (out[y], w)
                if low > high - 40.0:
                    high += math.log1p(math.exp(low - high))
                out[y] = high
        return np.array(out)

    def _expected_long(self, word: str, times: float) -> np.ndarray:
        parts, n = list(self._sparse(word)), len(word)
        alpha, beta = self._walk(parts, n), self._walk(sorted(parts, key=lambda p: -p[1][-1]), n, back=True)
        out = np.zeros(len(self.logs))
        for s, e, ids, weight, raw in parts:
            share = np.exp(alpha[s] + weight + beta[e] - alpha[n]) * times
            hit = ids >= 0
            out += np.bincount(ids[hit], share[hit], len(out))
            for at, x in zip(s[~hit].tolist(), share[~hit].tolist()):
                for b in raw[at]:
                    out[len(self.pieces) + b] += x
        return out

    def expected(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """Expected uses of each piece and byte over the words, each counted ``times`` times."""
        if len(words[0]) > LONG:
            return sum(self._expected_long(w, t) for w, t in zip(words, times))
        _, arcs, spelled = self._arcs(words)
        n = len(words[0])
        weights = {k: self._weight(arcs, spelled, *k) for k in arcs}
        alpha = self.forward(words, weights, arcs, spelled)
        beta = np.full((len(words), n + 1), -np.inf)
        beta[:, n] = 0.0
        for i in range(n - 1, -1, -1):
            beta[:, i] = _log_sum([weights[i, j] + beta[:, j] for j in range(i + 1, min(n, i + self.longest) + 1)])
        out = np.zeros(len(self.logs))
        for (i, j), ids in arcs.items():
            share = np.exp(alpha[:, i] + weights[i, j] + beta[:, j] - alpha[:, n]) * times
            hit = ids >= 0
            out += np.bincount(ids[hit], share[hit], len(out))
            if j == i + 1 and i in spelled:
                rows, raw = spelled[i]
                for r, s in zip(raw, share[rows]):
                    for b in r:
                        out[len(self.pieces) + b] += s
        return out

    def by_length(self, words: list[str], chunk: int) -> Iterator[np.ndarray]:
        """Positions of words of one length, at most ``chunk`` (fewer if long) at a time."""
        lengths = np.array([len(w) for w in words])
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            step = max(1, chunk * 12 // int(n))
            yield from (at[k : k + step] for k in range(0, len(at), step))

    def log10(self, words: list[str], chunk: int) -> np.ndarray:
        """log10 of each word's marginal probability."""
        out = np.zeros(len(words))
        for at in self.by_length(words, chunk):
            if len(words[at[0]]) > LONG:
                out[at] = [self._walk(self._sparse(words[k]), len(words[k]))[-1] / math.log(10) for k in at]
            else:
                out[at] = self.forward([words[k] for k in at])[:, -1] / math.log(10)
        return out


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    t = np.stack(terms)
    top = t.max(0)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(t - safe).sum(0)) + safe


def word_counts(text: str | None) -> Counter:
    """Words of a whole text, A-Z lower-cased, with their counts."""
    return Counter(text.encode("utf-8", "replace").lower().split()) if text else Counter()


def count_words(docs: DataFrame, train: Column, flush: int = 300_000) -> DataFrame:
    """(word, count): every word of every text with its count in the training texts, which may be 0."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(held.values(), pa.int64())], ["word", "count"])

        for batch in batches:
            for text, use in zip(batch.column("text"), batch.column("use")):
                found = word_counts(text.as_py())
                if use.as_py():
                    held.update(found)
                else:
                    for w in found:
                        held.setdefault(w, 0)
                if len(held) > flush:
                    yield out()
                    held = Counter()
        yield out()

    part = docs.select("text", train.alias("use")).mapInArrow(tally, "word string, count long")
    return part.groupBy("word").agg(F.sum("count").alias("count"))


@dataclass(frozen=True)
class LMModel:
    """Scores per piece and byte (natural logs), the end's lattice probability, and the word statistics."""

    pieces: list[str]
    logs: np.ndarray
    end: float
    tokens: int
    types: int
    texts: int
    discount: float

    def log10_word(self, count: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """log10 of discounted word share plus the rest's share of the lattice probability (given as log10)."""
        if not self.tokens:
            return lattice
        rest = math.log10(self.discount * self.types / self.tokens)
        with np.errstate(divide="ignore"):
            seen = np.log10(np.maximum(count - self.discount, 0.0) / self.tokens)
        return np.logaddexp(seen * math.log(10), (rest + lattice) * math.log(10)) / math.log(10)

    def log10_base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.types + 1))


def _normal(weights: np.ndarray) -> np.ndarray:
    return np.log(weights / weights.sum())


def fit(words: DataFrame, texts: int, spec: LMSpec = LMSpec()) -> LMModel:
    """Piece scores and word statistics from (word, count) rows and the number of training texts."""
    facts = words.where("count > 0").agg(F.count(F.lit(1)), F.sum("count"), F.sum((F.col("count") == 1).cast("long")), F.sum((F.col("count") == 2).cast("long"))).first()
    types, tokens, ones, twos = facts[0] + (texts > 0), (facts[1] or 0) + texts, facts[2] or 0, facts[3] or 0
    discount = min(0.95, max(0.1, ones / (ones + 2.0 * twos))) if ones else 0.5
    pieces, scores = read_pieces(spec.vocabulary)
    # the given scores rank the pieces (0 is best): a rank's usual share is one over it
    prior = np.concatenate([1.0 / (2.0 + scores.max() - scores), np.full(256, 1e-6)])
    prior /= prior.sum()
    logs, end = _normal(prior), 0.1
    longest, chunk = spec.longest, spec.chunk

    for _ in range(spec.rounds if types else 0):
        shared = words.sparkSession.sparkContext.broadcast((pieces, logs))

        def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(*shared.value, longest), 0.0
            for batch in batches:
                found, times = batch.column("word").to_pylist(), batch.column("count").to_numpy()
                marked = [START + w for w in found]
                for at in lattice.by_length(marked, chunk):
                    total = total + lattice.expected([marked[k] for k in at], times[at])
            if not np.isscalar(total):
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], ["piece", "uses"])

        # one row per piece: bounded by the vocabulary; summed as decimals, so in any order alike
        got = words.where("count > 0").mapInArrow(uses, "piece int, uses double").groupBy("piece").agg(F.sum(F.col("uses").cast("decimal(30,6)")).cast("double").alias("uses")).toPandas()
        counts = np.zeros(len(prior))
        counts[got["piece"]] = got["uses"]
        logs = _normal(counts + spec.smooth * counts.sum() * prior)
        starts = np.array([p.startswith(START) for p in pieces] + [False] * 256)
        begin, stop = np.exp(logs[starts]).sum() * counts.sum(), float(texts)
        end = stop / (begin + stop)
    return LMModel(pieces, logs, end, int(tokens), int(types), texts, discount)


def score_words(words: DataFrame, model: LMModel, spec: LMSpec = LMSpec()) -> DataFrame:
    """(word, count, score, base, lattice): log10 probabilities of each word, its lattice computed once; ``lattice`` is that alone."""
    shared = words.sparkSession.sparkContext.broadcast((model.pieces, model.logs))
    facts = (model.end, model.tokens, model.types, model.texts, model.discount)
    longest, chunk = spec.longest, spec.chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, logs = shared.value
        lattice, lm = Lattice(pieces, logs, longest), LMModel(pieces, logs, *facts)
        for batch in batches:
            count = batch.column("count").to_numpy().astype(float)
            spelled = lattice.log10([START + w for w in batch.column("word").to_pylist()], chunk) + math.log10(1 - lm.end)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("count"), pa.array(lm.log10_word(count, spelled)), pa.array(lm.log10_base(count)), pa.array(spelled)],
                ["word", "count", "score", "base", "lattice"],
            )

    return words.select("word", "count").mapInArrow(run, "word string, count long, score double, base double, lattice double")


def score_texts(docs: DataFrame, words: DataFrame, model: LMModel, spec: LMSpec = LMSpec()) -> DataFrame:
    """All rows and columns of ``docs`` but ``text``, plus n_tokens, n_known, train_tokens, base_score,
    score and lattice_score (the words' and the end's lattice probability alone, without the word counts).

    ``words``: the scored words of all texts (:func:`score_words`). A null or
    empty text is scored by its end alone. Scores depend on the text only;
    repeated rows are kept. Input columns with the six names are replaced.
    """
    spark = docs.sparkSession
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "lattice_score"]
    keep = [c for c in docs.columns if c not in ("text", *added)]
    heavy_at = max(1, math.ceil(spec.heavy_share * model.tokens))
    # bounded: at most 1 / heavy_share words reach heavy_share of all tokens
    heavy = words.where(F.col("count") >= heavy_at).toPandas()
    shared = spark.sparkContext.broadcast({w.encode(): (s, b, x) for w, s, b, x in zip(heavy["word"], heavy["score"], heavy["base"], heavy["lattice"])})
    one = np.array([float(model.texts)])
    end = (float(model.log10_word(one, np.array([math.log10(model.end)]))[0]), float(model.log10_base(one)[0]), int(model.texts > 0), math.log10(model.end))

    @F.arrow_udf("n_tokens long, n_known long, base double, score double, lattice double, rare array<struct<word:string,n:int>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for texts in batches:
            rows, words, times, ends = [], [], [], [0]
            for text in texts:
                found = word_counts(text.as_py())
                n, score, base, lattice = 0, end[0], end[1], end[3]
                for w, k in found.items():
                    hit = known.get(w)
                    if hit is None:
                        words.append(w)
                        times.append(k)
                    else:
                        n += k
                        score += k * hit[0]
                        base += k * hit[1]
                        lattice += k * hit[2]
                ends.append(len(words))
                rows.append((sum(found.values()) + 1, n + end[2], base, score, lattice))
            numbers = [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * 5, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))]
            rare = pa.StructArray.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int32())], names=["word", "n"])
            yield pa.StructArray.from_arrays([*numbers, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare)], names=["n_tokens", "n_known", "base", "score", "lattice", "rare"])

    th, got = fresh("th"), fresh("got")
    scanned = shared_table(spark, docs.select(*[F.col(f"`{c}`") for c in keep], F.xxhash64("text").alias(th), scan("text").alias(got)))
    rare = scanned.select(th, F.explode(f"{got}.rare").alias("r")).select(th, F.col("r.word").alias("word"), F.col("r.n").alias("n"))
    light = words.where(F.col("count") < heavy_at)
    # copies of a text add up under its hash and are divided out again
    summed = (
        rare.join(light, "word")
        .groupBy(th)
        .agg(
            F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0)).alias("k"),
            F.sum(F.col("n") * F.col("base")).alias("b"),
            F.sum(F.col("n") * F.col("score")).alias("s"),
            F.sum(F.col("n") * F.col("lattice")).alias("l"),
        )
    )
    copies = scanned.groupBy(th).agg(F.count(F.lit(1)).alias("copies"))
    share = lambda c: (F.col(c) / F.col("copies")).alias(fresh(c))
    each = copies.join(summed, th).select(F.col(th).alias(fresh("of")), share("k"), share("b"), share("s"), share("l"))
    g = lambda c: F.col(f"{got}.{c}")
    more = lambda c: F.coalesce(fresh(c), F.lit(0.0))
    return scanned.join(each, F.col(th) == F.col(fresh("of")), "left").select(
        *[F.col(f"`{c}`") for c in keep],
        g("n_tokens").alias("n_tokens"),
        (g("n_known") + more("k").cast("long")).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (g("base") + more("b")).alias("base_score"),
        (g("score") + more("s")).alias("score"),
        (g("lattice") + more("l")).alias("lattice_score"),
    )


def lm_scores(docs: DataFrame, train: Column, spec: LMSpec = LMSpec()) -> DataFrame:
    """Learn from the texts where ``train`` holds, score all; see :func:`score_texts`."""
    words = shared_table(docs.sparkSession, count_words(docs, train))
    model = fit(words, docs.where(train).count(), spec)
    scored = shared_table(docs.sparkSession, score_words(words, model, spec))
    return score_texts(docs, scored, model, spec)
