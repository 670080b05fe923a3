"""Sharding by sampled splitters (operator 4, built-in functions only).

Records are ordered by (text checksum, row hash), so equal texts stand next to
each other, and cut into shards of nearly equal bytes:

1. a size-weighted sample of the sort keys (bounded, reproducible by hash)
   gives quantile splitters, several ranges per shard;
2. each range's exact bytes and rows are counted; overfull ranges are sampled
   again and subdivided until each is small or holds a single key;
3. a record's global position is its range's offset plus a running sum inside
   the range, and the position decides shard and slot. Only ranges are sorted,
   each in one task, so no task sees a whole shard or a whole group of copies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, row_hash, unit_hash


@dataclass(frozen=True)
class ShardSpec:
    """``ranges_per_shard`` splitter ranges are aimed at per shard, from ``sample_per_range``
    expected sample keys each (the only rows that reach the driver). A range holding over
    ``overfull`` times its share is subdivided, at most ``max_rounds`` times."""

    shards: int = 40
    ranges_per_shard: int = 6
    sample_per_range: int = 12
    overfull: float = 3.0
    max_rounds: int = 3
    seed: int = 17


KEY, BYTES, RANGE, POS, ROW = (fresh(x) for x in ("key", "bytes", "range", "pos", "row"))


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def sort_key(checksum: Column, tie: Column) -> Column:
    """32 bits of checksum, then 31 bits of ``tie``: equal texts are adjacent, yet divisible."""
    return F.shiftleft(checksum.cast("long"), 31).bitwiseOR(tie.bitwiseAND(F.lit((1 << 31) - 1)))


def _range_of(splitters: list[int]) -> Column:
    """Number of splitters at or below the key."""
    if not splitters:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(s).cast("long") for s in splitters]), lambda s: s <= F.col(KEY)))


def _sample(keyed: DataFrame, bytes_per_key: float, seed: int) -> list[int]:
    """Sorted distinct sort keys, a record being drawn with probability bytes / bytes_per_key."""
    draw = unit_hash(F.col(KEY), F.lit(seed)) < F.col(BYTES) / F.lit(float(bytes_per_key))
    return sorted({r[0] for r in keyed.where(draw).select(KEY).distinct().collect()})


def _cuts(sample: list[int], parts: int) -> list[int]:
    """Quantile splitters of a sorted sample."""
    return sorted({sample[i * len(sample) // parts] for i in range(1, parts)}) if sample else []


def _splitters(keyed: DataFrame, spec: ShardSpec) -> tuple[list[int], dict[int, tuple[int, int]], int]:
    total = keyed.agg(F.sum(BYTES)).first()[0] or 0
    parts = spec.shards * spec.ranges_per_shard
    share = max(1.0, total / parts)
    cuts = _cuts(_sample(keyed, share / spec.sample_per_range, spec.seed), parts)
    for attempt in range(spec.max_rounds + 1):
        ranged = keyed.withColumn(RANGE, _range_of(cuts))
        held = {
            r[0]: (r[1], r[2], r[3] < r[4])
            for r in ranged.groupBy(RANGE)
            .agg(F.sum(BYTES), F.count(F.lit(1)), F.min(KEY), F.max(KEY))
            .collect()
        }
        full = [k for k, (b, _, divisible) in held.items() if b > spec.overfull * share and divisible]
        if not full or attempt == spec.max_rounds:
            return cuts, {k: (b, n) for k, (b, n, _) in held.items()}, total
        more = _sample(ranged.where(F.col(RANGE).isin(full)), share / spec.sample_per_range, spec.seed + attempt + 1)
        for k in full:
            inside = [s for s in more if sum(c <= s for c in cuts) == k]
            cuts = sorted({*cuts, *_cuts(inside, max(2, round(held[k][0] / share)))})
    raise AssertionError("unreachable")


def shard_by_size(df: DataFrame, size: Column, checksum: Column, spec: ShardSpec = ShardSpec(), order_by: list[str] | None = None) -> DataFrame:
    """All rows and columns of ``df`` plus ``shard`` (int) and ``slot`` (long, gapless from 0 per shard).

    ``size`` is a positive number of bytes per record and ``checksum`` a 32-bit
    key that equal records share. A record goes where its middle lies, so a
    shard's bytes differ from an equal share by at most half the record at
    either end. Repeated rows are all kept; they are interchangeable. An empty
    table gives an empty result. Input columns named ``shard`` or ``slot`` are
    replaced. ``order_by`` names the columns that break ties (default: the
    hash of the whole row).
    """
    cols = [c for c in df.columns if c not in ("shard", "slot")]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in order_by]) if order_by else row_hash(df)
    keyed = df.withColumn(BYTES, size.cast("long")).withColumn(KEY, sort_key(checksum, tie))
    cuts, held, total = _splitters(keyed.select(KEY, BYTES), spec)
    ranges = sorted(held)
    byte_at, row_at, b, n = [], [], 0, 0
    for k in range((ranges[-1] if ranges else 0) + 1):
        byte_at.append(b)
        row_at.append(n)
        b, n = b + held.get(k, (0, 0))[0], n + held.get(k, (0, 0))[1]
    at = lambda xs: F.element_at(F.array(*[F.lit(x).cast("long") for x in xs]), F.col(RANGE) + 1)
    w = Window.partitionBy(RANGE).orderBy(KEY, *(order_by or []))
    before = F.sum(BYTES).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col(BYTES)
    placed = (
        keyed.withColumn(RANGE, _range_of(cuts))
        .withColumn(POS, at(byte_at) + before)
        .withColumn(ROW, at(row_at) + F.row_number().over(w) - 1)
        .withColumn("shard", F.least(F.floor((F.col(POS) + F.col(BYTES) / 2) * spec.shards / F.lit(max(1, total))), F.lit(spec.shards - 1)).cast("int"))
    )
    # One row per shard: bounded by the shard count, so it is safe to broadcast.
    first = placed.groupBy(F.col("shard").alias(fresh("shard"))).agg(F.min(ROW).alias(fresh("first")))
    return (
        placed.join(F.broadcast(first), F.col("shard") == F.col(fresh("shard")))
        .withColumn("slot", (F.col(ROW) - F.col(fresh("first"))).cast("long"))
        .select(*[F.col(f"`{c}`") for c in cols], "shard", "slot")
    )


def shard_documents(docs: DataFrame, spec: ShardSpec = ShardSpec()) -> DataFrame:
    """Documents with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    Law ``bytes``: shard sizes are nearly equal. A null text counts as empty
    (size 16, checksum 0).
    """
    keep = [c for c in docs.columns if c not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    sized = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        (text_bytes(F.col("text")) + 16).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    ties = ["doc_id", *[c for c in keep if c not in ("doc_id", "text")]]
    out = shard_by_size(sized, F.col("size"), F.col("text_crc32"), spec, order_by=ties)
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))
