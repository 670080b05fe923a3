"""Mixing sources to target weights (operator 5, built-in functions only).

Each source's documents form one token stream, cut into blocks of a fixed
length. The output is a sequence of shards of block slots; every shard draws
how many of its slots each source fills (multinomial: the whole part of the
expected count, the remainder by random draws). A source numbers its slots
across shards, and slot number r takes block ``permutation(r mod blocks)``, so
each pass over a source uses every block once, in pseudorandom order. Blocks
are joined to documents by index.

Skew: a stream is laid out by hash buckets (running sums inside a bucket, then
over bucket totals), so a source holding most rows is never one task.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, row_hash, unit_hash, words


@dataclass(frozen=True)
class MixSpec:
    """``block`` tokens per block, ``shard_slots`` block slots per output shard, at most
    ``max_repeats`` passes over a source, about ``bucket_rows`` documents per layout bucket."""

    block: int = 128
    shard_slots: int = 512
    max_repeats: int = 3
    bucket_rows: int = 20_000
    seed: int = 5


@dataclass(frozen=True)
class SourcePlan:
    index: int
    name: str | None
    tokens: int
    target: float
    blocks: int
    step: int
    offsets: tuple[int, ...]


SRC, BUCKET, ORDER, OFF, SIZE, BLOCK, HELD, START, NUMBER, TAKEN = (fresh(x) for x in "src bucket order off size block held start number taken".split())


def default_weights(names: list[str | None]) -> list[float]:
    """1, 2, 3, repeating, over the sources in code point order with null last."""
    return [float(i % 3 + 1) for i in range(len(names))]


def share_out(tokens: list[int], weights: list[float], max_repeats: int) -> list[float]:
    """Targets by weight over the sum of all tokens, none above ``max_repeats`` times its source;
    what a capped source cannot take is shared again by weight among the rest."""
    target = [0.0] * len(tokens)
    free, left = [i for i in range(len(tokens))], float(sum(tokens))
    while free:
        total = sum(weights[i] for i in free)
        capped = [i for i in free if left * weights[i] / total > max_repeats * tokens[i]]
        if not capped:
            for i in free:
                target[i] = left * weights[i] / total
            break
        for i in capped:
            target[i] = float(max_repeats * tokens[i])
        left -= sum(target[i] for i in capped)
        free = [i for i in free if i not in capped]
    return target


def _permutation(name: str | None, blocks: int, spec: MixSpec) -> tuple[int, tuple[int, ...]]:
    """Multiplier coprime to the block count, and one offset per pass."""
    raw = hashlib.blake2b(f"{spec.seed}|{name is None}|{name}".encode(), digest_size=32).digest()
    num = [int.from_bytes(raw[i : i + 8], "big") for i in range(0, 32, 8)]
    # near the golden section of the range, moved by the hash: neighbours land far apart
    step = max(1, int(blocks * (0.55 + 0.2 * (num[0] / 2**64))))
    while math.gcd(step, blocks) != 1:
        step += 1
    salt = [int.from_bytes(hashlib.blake2b(raw + bytes([e]), digest_size=8).digest(), "big") for e in range(spec.max_repeats)]
    return step, tuple(s % blocks for s in salt)


def plan_sources(sized: DataFrame, spec: MixSpec, weights=default_weights) -> list[SourcePlan]:
    """Targets and permutations, one entry per source (the only rows that reach the driver)."""
    rows = sized.groupBy("source").agg(F.sum(SIZE).alias("tokens")).collect()
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    names, tokens = [r["source"] for r in rows], [int(r["tokens"]) for r in rows]
    targets = share_out(tokens, weights(names), spec.max_repeats)
    out = []
    for i, (name, t, goal) in enumerate(zip(names, tokens, targets)):
        blocks = -(-t // spec.block)
        step, offsets = _permutation(name, blocks, spec) if blocks else (1, (0,) * spec.max_repeats)
        out.append(SourcePlan(i, name, t, goal, blocks, step, offsets))
    return out


def _pick(plans: list[SourcePlan], values: list, kind: str, index: Column) -> Column:
    """``values`` by source index."""
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), index + 1)


def slot_counts(spark: SparkSession, plans: list[SourcePlan], spec: MixSpec) -> DataFrame:
    """(shard, source index, count): how many slots of each output shard each source fills."""
    want = [p.target * p.blocks / p.tokens if p.tokens else 0.0 for p in plans]
    slots = round(sum(want))
    total = sum(want) or 1.0
    shards = -(-slots // spec.shard_slots)
    shard = spark.range(shards).select(
        F.col("id").alias("shard"),
        F.least(F.lit(spec.shard_slots), F.lit(slots) - F.col("id") * spec.shard_slots).cast("double").alias("slots"),
    )
    parts = shard.select("shard", "slots", F.posexplode(F.array(*[F.lit(w / total) for w in want])).alias(SRC, "p"))
    whole = parts.select("shard", SRC, F.floor(F.col("slots") * F.col("p")).alias("n"))
    # The remainder: draws from the fractional parts' distribution, which full shards share.
    full, rest = ([w / total * n % 1.0 for w in want] for n in (spec.shard_slots, slots - (shards - 1) * spec.shard_slots))
    steps = [F.array(*[F.lit(c) for c in itertools.accumulate(x)]) for x in (full, rest)]
    left = shard.withColumn("cum", F.when(F.col("shard") < shards - 1, steps[0]).otherwise(steps[1])).withColumn("mass", F.element_at("cum", -1))
    draws = left.where(F.round("mass") > 0).select(
        "shard", "cum", "mass", F.explode(F.sequence(F.lit(1), F.round("mass").cast("int"))).alias("draw")
    )
    u = unit_hash(F.lit(spec.seed), F.col("shard"), F.col("draw")) * F.col("mass")
    drawn = draws.withColumn("u", u).select(
        "shard", F.least(F.size(F.filter("cum", lambda c: c <= F.col("u"))), F.lit(len(plans) - 1)).alias(SRC), F.lit(1).cast("long").alias("n")
    )
    return whole.unionByName(drawn).groupBy("shard", SRC).agg(F.sum("n").alias("n")).where("n > 0")


def block_uses(spark: SparkSession, plans: list[SourcePlan], spec: MixSpec) -> DataFrame:
    """(source index, block, uses): how often the mix takes each block."""
    counts = slot_counts(spark, plans, spec)
    w = Window.partitionBy(SRC).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("start", F.coalesce(F.sum("n").over(w), F.lit(0)))
    slots = ranked.select(SRC, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("rank"))
    blocks = _pick(plans, [max(1, p.blocks) for p in plans], "long", F.col(SRC))
    turn = F.floor(F.col("rank") / F.col("blocks"))
    offset = F.element_at(F.element_at(F.array(*[F.array(*[F.lit(o).cast("long") for o in p.offsets]) for p in plans]), F.col(SRC) + 1), turn.cast("int") + 1)
    at = F.pmod(F.col("rank") % F.col("blocks") * _pick(plans, [p.step for p in plans], "long", F.col(SRC)) + offset, F.col("blocks"))
    return (
        slots.withColumn("blocks", blocks)
        .where(turn < spec.max_repeats)  # a slot drawn beyond the last pass stays unfilled
        .select(SRC, at.alias(BLOCK))
        .groupBy(SRC, BLOCK)
        .agg(F.count(F.lit(1)).alias("uses"))
    )


def mix_documents(docs: DataFrame, spec: MixSpec = MixSpec(), weights=default_weights) -> DataFrame:
    """All columns of ``docs`` plus ``size``, ``source_size``, ``target`` and ``taken``.

    ``size``: words of the text (0 for null), ``taken``: words of the document
    that the mix takes, repeats counted, at most ``max_repeats * size``.
    Repeated rows each hold their own place in the stream; a null source is a
    source of its own; an empty table gives an empty result. Input columns
    with those four names are replaced.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    quoted = [F.col(f"`{c}`") for c in keep]
    sized = docs.select(*quoted, F.size(words(F.col("text"))).cast("long").alias(SIZE), row_hash(docs.select(*quoted)).alias(ORDER))
    plans = plan_sources(sized, spec, weights)
    if not plans:
        plans = [SourcePlan(0, None, 0, 0.0, 0, 1, (0,) * spec.max_repeats)]
    rows = sized.count()
    buckets = max(1, 1 << math.ceil(math.log2(max(1, rows) / spec.bucket_rows + 1)))
    names = F.array(*[F.coalesce(F.lit(p.name).cast("string"), F.lit("")) for p in plans if p.name is not None]).cast("array<string>")
    index = F.when(F.col("source").isNull(), F.lit(len(plans) - 1)).otherwise(F.array_position(names, F.col("source")).cast("int") - 1)
    laid = sized.withColumn(SRC, index).withColumn(BUCKET, F.pmod(F.col(ORDER), F.lit(buckets)).cast("int"))
    # offsets: bucket totals are summed per source (one row per bucket), rows inside a bucket
    totals = laid.groupBy(SRC, BUCKET).agg(F.sum(SIZE).alias(HELD))
    before = Window.partitionBy(SRC).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(SRC, BUCKET, F.coalesce(F.sum(HELD).over(before), F.lit(0)).alias(START))
    inside = Window.partitionBy(SRC, BUCKET).orderBy(ORDER)
    run = F.sum(SIZE).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(SIZE)
    laid = laid.withColumn(NUMBER, F.row_number().over(inside)).withColumn(OFF, run).join(starts, [SRC, BUCKET]).withColumn(OFF, F.col(OFF) + F.col(START))
    last = F.col(OFF) + F.col(SIZE) - 1
    parts = laid.select(SRC, BUCKET, NUMBER, OFF, SIZE).where(F.col(SIZE) > 0).select(
        SRC, BUCKET, NUMBER, OFF, SIZE,
        F.explode(F.sequence(F.floor(F.col(OFF) / spec.block), F.floor(last / spec.block))).alias(BLOCK),
    )
    shared = F.least(last + 1, (F.col(BLOCK) + 1) * spec.block) - F.greatest(F.col(OFF), F.col(BLOCK) * spec.block)
    taken = (
        parts.withColumn("shared", shared)
        # the planner cannot see how many slots the counts explode into: without the hint it would broadcast them
        .join(block_uses(spark, plans, spec).hint("merge"), [SRC, BLOCK])
        .groupBy(SRC, BUCKET, NUMBER)
        .agg(F.sum(F.col("uses") * F.col("shared")).alias(TAKEN))
    )
    return laid.join(taken, [SRC, BUCKET, NUMBER], "left").select(
        *quoted,
        F.col(SIZE).alias("size"),
        _pick(plans, [p.tokens for p in plans], "long", F.col(SRC)).alias("source_size"),
        _pick(plans, [p.target for p in plans], "double", F.col(SRC)).alias("target"),
        F.coalesce(F.col(TAKEN), F.lit(0)).cast("long").alias("taken"),
    )


def mixed_copies(mixed: DataFrame, columns: list[str], seed: int = 5) -> DataFrame:
    """Whole documents as often as the mix takes them: ``taken / size`` copies, the fractional
    part rounded by a reproducible draw; documents without words are left out."""
    share = F.col("taken") / F.col("size")
    u = unit_hash(F.lit(seed), *[F.col(f"`{c}`") for c in columns])
    copies = (F.floor(share) + (u < share - F.floor(share)).cast("int")).cast("int")
    return (
        mixed.where(F.col("size") > 0)
        .withColumn(fresh("copies"), copies)
        .where(F.col(fresh("copies")) > 0)
        .withColumn(fresh("copy"), F.explode(F.sequence(F.lit(1), F.col(fresh("copies")))))
        .select(*[F.col(f"`{c}`") for c in columns])
    )
