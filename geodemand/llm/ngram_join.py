"""N-gram Jaccard self-join by token-combination prefixes (operator 8).

Two texts link when their sets of word n-grams have Jaccard similarity of at
least ``percent`` in 100. A set's tokens are put in one global order, rare
tokens first; a prefix is long enough when, whichever tokens the allowed
number of differences removes, some indexed signature survives:

* a rare token is a signature of its own;
* frequent tokens fall into classes by hash, and every pair of a class within
  the prefix is a signature, so a class with m tokens survives m - 2 losses and
  the prefix is extended until the classes together survive enough of them.

Sets that share a signature are candidates. They are verified exactly, first
against the most central set of each signature; then, with the components
known, across components only, which is where a missing link could matter.
Equal sets are one node from the start. Every candidate of differing
components passes or fails an exact bound (size and parity-sketch distance)
inside the join, so a group of thousands of copies never turns into all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, shared_table, small_side
from .components import connected_components


@dataclass(frozen=True)
class JaccardSpec:
    """``frequent_at``: a token is frequent above this count, or above the total count divided by
    ``2**frequent_bits`` if that is more, which bounds the number of frequent tokens.
    In sets of at least ``pairs_from`` tokens (a power of two), whose prefixes are so long that any two
    of them share some token, every token counts as frequent. ``class_bits``: a class has about
    ``2**class_bits`` tokens of a set; the lower, the fewer pairs a long prefix gives.
    ``count_slice``: about how many tokens one counting task merges."""

    n: int = 3
    percent: int = 90
    frequent_at: int = 32
    frequent_bits: int = 20
    table_bits: int = 24
    pairs_from: int = 512
    class_bits: int = 4
    count_slice: int = 4_000_000
    sketch_longs: int = 8
    histogram: int = 256
    broadcast_rows: int = 100_000
    broadcast_ids: int = 1_000_000


# Odd multipliers that mix word hashes into n-gram hashes.
MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]


class _WordHash(dict):
    """Word -> 64-bit hash; cleared when large, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _finish(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, n: int, hashes: _WordHash) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams; a shorter text is one n-gram of its own."""
    found = text.encode("utf-8", "replace").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.array([hashes[w] for w in found], dtype=np.uint64)
    k = min(n, len(h))
    x = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        x = _finish(x + h[i : len(h) - k + 1 + i]) * np.uint64(MIX[i % len(MIX)] + 2 * i)
    return np.unique(x)


def _pair_signatures(rest: np.ndarray, need: int, scale: int, class_bits: int) -> np.ndarray:
    """Pairs within the classes of the shortest prefix of ``rest`` that survives ``need`` losses."""
    classes = max(1, (1 << scale) >> class_bits)
    of = (rest >> np.uint64(7)) % np.uint64(classes)
    survivor = np.ones(len(rest), bool)
    survivor[np.unique(of, return_index=True)[1]] = False
    cut = int(np.searchsorted(np.cumsum(survivor), need)) + 1
    rest, of = rest[:cut], of[:cut]
    order = np.argsort(of, kind="stable")
    rest, of = rest[order], of[order]
    out, gap = [], 1
    while gap < len(rest):  # the classes are runs: pair each token with the one `gap` places on
        same = of[gap:] == of[:-gap]
        if not same.any():
            break
        out.append(_finish(rest[:-gap][same] * np.uint64(MIX[0]) + rest[gap:][same] * np.uint64(MIX[1]) + np.uint64(scale)))
        gap += 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def signatures(tokens: np.ndarray, frequent: np.ndarray, spec: JaccardSpec) -> tuple[np.ndarray, int]:
    """Signatures of one set (sorted tokens), and its number of rare tokens. ``frequent``: flag per leading token bits."""
    n = len(tokens)
    common = frequent[(tokens >> np.uint64(64 - spec.table_bits)).astype(np.int64)]
    rare, rest = tokens[~common], tokens[common]
    if n < 2:
        return tokens, len(rare)
    need = n - -(-spec.percent * n // 100) + 1
    out = []
    # the partner's size decides the classes: this size's scale, and the next if in reach
    for scale in range(n.bit_length() - 1, (100 * n // spec.percent).bit_length()):
        if 1 << scale >= spec.pairs_from:
            out.append(_pair_signatures(tokens, need, scale, spec.class_bits))
        elif len(rare) >= need:
            out.append(rare[:need])
        else:
            out += [rare, _pair_signatures(rest, need - len(rare), scale, spec.class_bits)]
    return np.concatenate(out), len(rare)


def _sketch(tokens: np.ndarray, longs: int) -> np.ndarray:
    """Parity of the tokens per bit: the sketches of two sets differ in no more bits than the sets in tokens."""
    bits = np.bincount((tokens >> np.uint64(20)).astype(np.int64) % (64 * longs), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _histogram(tokens: np.ndarray, bins: int) -> bytes:
    """Tokens per bin: the counts of two sets differ in no more places than the sets in tokens, however large they are."""
    counts = np.bincount((tokens >> np.uint64(30)).astype(np.int64) % bins, minlength=bins)
    return np.minimum(counts, 65_535).astype(np.uint16).tobytes()


def _frequent_table(texts: DataFrame, spec: JaccardSpec) -> np.ndarray:
    """Flags by leading token bits: counted over all texts, the bounded list of frequent ones reaches the driver."""
    total = (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6 + 1
    slices = max(1, -(-total // spec.count_slice))
    least = max(spec.frequent_at, total >> spec.frequent_bits)

    @F.arrow_udf("array<binary>")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """Distinct 32-bit tokens of a batch with their counts, cut into slices and packed; a packed column per slice in its first row."""
        hashes, packer = _WordHash(), zstandard.ZstdCompressor(level=1)
        edges = np.array([(s << 32) // slices for s in range(1, slices)], dtype=np.uint32)
        for batch in batches:
            held = [(shingles(t.as_py(), spec.n, hashes) >> np.uint64(32)).astype(np.uint32) for t in batch]
            tokens, times = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint32), return_counts=True)
            out: list = [None] * len(batch)
            if len(tokens):
                cuts = np.searchsorted(tokens, edges)
                out[0] = [packer.compress(_pack(p, n)) for p, n in zip(np.split(tokens, cuts), np.split(times, cuts))]
            yield pa.array(out, pa.list_(pa.binary()))

    @F.arrow_udf("array<int>")
    def frequent(parts: pa.Array) -> pa.Array:
        unpacker = zstandard.ZstdDecompressor()
        out = []
        for packed in parts:
            tokens, times = (np.concatenate(x) for x in zip(*[_unpack(unpacker.decompress(p.as_py())) for p in packed]))
            order = np.argsort(tokens, kind="stable")
            tokens, first = np.unique(tokens[order], return_index=True)
            held = np.add.reduceat(times[order], first, dtype=np.int64) if len(first) else first
            out.append(tokens[held > least].view(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    # one row per batch and slice, a token once in it: a slice merges at most about count_slice tokens however many texts
    # there are, and one that a third of them hold is one entry per batch
    rows = texts.select(F.posexplode(counts("text")).alias("slice", "packed"))
    merged = rows.groupBy("slice").agg(F.collect_list("packed").alias("parts")).select(F.explode(frequent("parts")).alias("token"))
    found = merged.toArrow().column("token").to_numpy().astype(np.int32).view(np.uint32)
    flags = np.zeros(1 << spec.table_bits, bool)
    flags[found >> np.uint32(32 - spec.table_bits)] = True
    return flags


def _pack(tokens: np.ndarray, times: np.ndarray) -> bytes:
    """Differences of sorted 32-bit tokens and their counts, byte planes apart (they compress well)."""
    return np.stack([np.diff(tokens, prepend=np.uint32(0)), times.astype(np.uint32)]).view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, times = np.frombuffer(raw, np.uint8).reshape(2, 4, -1).transpose(0, 2, 1).copy().view(np.uint32)[:, :, 0]
    return np.cumsum(steps, dtype=np.uint32), times


def _profiles(texts: DataFrame, spec: JaccardSpec) -> DataFrame:
    """Adds n, set (64-bit set hash, null when empty), rare, sketch, histogram and signatures of ``text``."""
    flags = texts.sparkSession.sparkContext.broadcast(np.packbits(_frequent_table(texts, spec)))  # 2**table_bits bits

    kinds = {"n": pa.int64(), "set": pa.int64(), "rare": pa.int32(), "sketch": pa.list_(pa.int64()), "histogram": pa.binary(), "signatures": pa.list_(pa.int64())}

    @F.arrow_udf("n long, set long, rare int, sketch array<long>, histogram binary, signatures array<long>")
    def profile(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, frequent = _WordHash(), np.unpackbits(flags.value).astype(bool)
        for batch in batches:
            rows = []
            for text in batch:
                tokens = shingles(text.as_py(), spec.n, hashes)
                if not len(tokens):
                    rows.append((0, None, 0, None, None, None))
                    continue
                found, rare = signatures(tokens, frequent, spec)
                name = xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)
                rows.append((len(tokens), name, rare, _sketch(tokens, spec.sketch_longs), _histogram(tokens, spec.histogram), np.unique(found).view(np.int64)))
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds.values())], names=list(kinds))

    return texts.withColumn(fresh("profile"), profile("text")).drop("text").select("*", f"{fresh('profile')}.*").drop(fresh("profile"))


def _within_bounds(a: str, b: str, spec: JaccardSpec) -> Column:
    """Necessary for a link: sizes near enough, and sketches no further apart than two such sets can be."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(spec.sketch_longs)), F.lit(0))
    sizes = 100 * F.least(na, nb) >= spec.percent * F.greatest(na, nb)
    return sizes & ((100 + spec.percent) * apart <= (100 - spec.percent) * (na + nb))


def _verified(pairs: DataFrame, texts: DataFrame, sets: DataFrame, spec: JaccardSpec) -> DataFrame:
    """Those of the distinct pairs (a, b) of set hashes that truly link. ``sets``: set, n, histogram and the hash of one text of it."""

    @F.arrow_udf("boolean")
    def possible(left: pa.Array, right: pa.Array, sizes: pa.Array) -> pa.Array:
        counts = [np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(len(x), spec.histogram).astype(np.int32) for x in (left, right)]
        apart = np.abs(counts[0] - counts[1]).sum(1, dtype=np.int64)
        return pa.array((100 + spec.percent) * apart <= (100 - spec.percent) * sizes.to_numpy(zero_copy_only=False))

    facts = lambda x: sets.select(F.col("set").alias(x), F.col("n").alias(f"n{x}"), F.col("histogram").alias(f"h{x}"))
    near = pairs.join(facts("a"), "a").join(facts("b"), "b").where(possible("ha", "hb", F.col("na") + F.col("nb")))
    pairs = shared_table(texts.sparkSession, near.select("a", "b"))
    wanted = shared_table(
        texts.sparkSession, pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct().join(sets.select("set", "th"), "set").select("th", "set")
    )

    held = texts.join(small_side(wanted, spec.broadcast_rows), "th").groupBy("set").agg(F.first("text").alias("text"))
    side = lambda x: held.select(F.col("set").alias(x), F.col("text").alias(f"t{x}"))

    @F.arrow_udf("boolean")
    def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hashes = _WordHash()
        for left, right in batches:
            out = []
            for t, u in zip(left, right):
                x, y = shingles(t.as_py(), spec.n, hashes), shingles(u.as_py(), spec.n, hashes)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * both >= spec.percent * (len(x) + len(y) - both))
            yield pa.array(out, pa.bool_())

    # texts travel, not their sets of hashes: they are smaller and compress
    return pairs.join(side("a"), "a").join(side("b"), "b").where(linked("ta", "tb")).select("a", "b")


def _links(texts: DataFrame, profiles: DataFrame, spec: JaccardSpec) -> DataFrame:
    """(node, root) over set hashes; sets without links are left out."""
    spark = texts.sparkSession
    # one row of each set stands for it; its signatures stay where they are stored and are read from there
    nodes = shared_table(
        spark, profiles.where("n > 0").groupBy("set").agg(F.min("rid").alias("rid"), *[F.first(c).alias(c) for c in ("n", "rare", "sketch", "histogram", "th")])
    )
    stored = profiles.where("n > 0").select("rid", "set", "signatures")
    postings = stored.join(small_side(nodes.select("rid"), spec.broadcast_ids), "rid").select(F.explode("signatures").alias("sig"), "set")
    shared = shared_table(spark, postings.groupBy("sig").agg(F.count(F.lit(1)).alias("held")).where("held > 1").select("sig"))
    facts = nodes.select("set", "n", "rare", *[F.col("sketch")[i].alias(f"s{i}") for i in range(spec.sketch_longs)])
    members = shared_table(spark, postings.join(shared, "sig").join(facts, "set"))
    sets = nodes.select("set", "n", "histogram", "th")

    # each signature's members against its most central one
    names = ["rare", "set", "n", *[f"s{i}" for i in range(spec.sketch_longs)]]
    hubs = members.groupBy("sig").agg(F.min(F.struct(*names)).alias("h")).select("sig", "h.*")
    near = members.alias("a").join(hubs.alias("b"), (F.col("a.sig") == F.col("b.sig")) & (F.col("a.set") != F.col("b.set")) & _within_bounds("a", "b", spec))
    as_pairs = lambda df: df.select(F.least("a.set", "b.set").alias("a"), F.greatest("a.set", "b.set").alias("b")).distinct()
    first = _verified(shared_table(spark, as_pairs(near)), texts, sets, spec).checkpoint()
    roots = connected_components(first, "a", "b")

    # what is still apart and shares a signature
    labelled = members.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    mixed = labelled.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("sig")
    rest = shared_table(spark, labelled.join(mixed, "sig"))
    across = rest.alias("a").join(
        rest.alias("b"),
        (F.col("a.sig") == F.col("b.sig")) & (F.col("a.set") < F.col("b.set")) & (F.col("a.root") != F.col("b.root")) & _within_bounds("a", "b", spec),
    )
    second = _verified(shared_table(spark, as_pairs(across)), texts, sets, spec).checkpoint()
    return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(second), "a", "b")


def ngram_groups(docs: DataFrame, spec: JaccardSpec = JaccardSpec()) -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_shingles``, ``component_id`` and ``group_id``.

    ``component_id`` is the least non-null doc_id reachable by links. A text
    without words (or null) has no shingles and is a component of its own;
    ``group_id`` (a hash naming the component) is then null. Equal texts always
    share a component. Repeated rows are kept. Sets and texts are told apart by
    64-bit hashes. Input columns with the three names are replaced.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in ("n_shingles", "component_id", "group_id")]
    plain = docs.select(*[F.col(f"`{c}`") for c in keep])
    texts = plain.select(F.xxhash64("text").alias("th"), "text")
    profiles = _profiles(plain.select("doc_id", F.xxhash64("text").alias("th"), "text"), spec)
    profiles = shared_table(spark, profiles.withColumn("rid", F.monotonically_increasing_id()))  # numbered once, as stored
    roots = _links(texts, profiles, spec)
    ids = profiles.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("least"))
    of = ids.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    least = of.groupBy("root").agg(F.min("least").alias("least"))
    named = of.drop("least").join(least, "root")
    classes = profiles.where("n > 0").select("th", "set", "n").distinct().join(named, "set")
    th, n, root, first = (fresh(x) for x in ("th", "n", "root", "least"))
    classes = classes.select(F.col("th").alias(fresh("of")), F.col("n").alias(n), F.col("root").alias(root), F.col("least").alias(first))
    joined = plain.withColumn(th, F.xxhash64("text")).join(classes, F.col(th) == F.col(fresh("of")), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in keep],
        F.coalesce(n, F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col(n).isNull(), F.col("doc_id")).otherwise(F.col(first)).alias("component_id"),
        F.col(root).alias("group_id"),
    )


def one_per_group(grouped: DataFrame, columns: list[str]) -> DataFrame:
    """The row with the least doc_id of each group; rows without shingles all stay."""
    quoted = [F.col(f"`{c}`") for c in columns]
    first = grouped.where("n_shingles > 0 and doc_id <=> component_id").dropDuplicates(["group_id"]).select(*quoted)
    return first.unionByName(grouped.where("n_shingles = 0").select(*quoted))
