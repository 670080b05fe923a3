import random
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import SCHEMA, WORD, awkward_rows, prose

from geodemand.llm.mixing import MixSpec, default_weights, mix_documents, mixed_copies, share_out
from geodemand.llm.shards import ShardSpec, shard_by_size, shard_documents
from pyspark.sql import functions as F


def check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < shards
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    held = Counter()
    for r in rows:
        held[r["shard"]] += r["size"]
    return held


def test_shards_hold_every_row_once_in_nearly_equal_bytes(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(1, 60)), None, None, 0) for i in range(900)] + [(1000 + i, "copy " * 20, None, None, 0) for i in range(450)]
    out = shard_documents(spark.createDataFrame(rows, SCHEMA).repartition(7), ShardSpec(shards=10)).collect()
    held = check_shards(out, 10)
    assert sorted(r["doc_id"] for r in out) == sorted(r[0] for r in rows)
    for r in out:
        raw = r["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    largest = max(r["size"] for r in out)
    share = sum(held.values()) / 10
    assert all(abs(b - share) <= largest for b in held.values())
    # equal texts stand together: the copies fill a run of shards
    mine = sorted({r["shard"] for r in out if r["text"].startswith("copy")})
    assert mine == list(range(mine[0], mine[-1] + 1))


def test_sharding_does_not_depend_on_partitioning(spark):
    rows = [(i, f"text {i % 40}", None, None, 0) for i in range(300)]
    one, two = (sorted(map(tuple, shard_documents(spark.createDataFrame(rows, SCHEMA).repartition(n), ShardSpec(shards=7)).collect())) for n in (1, 5))
    assert one == two


def test_an_overfull_range_is_subdivided(spark):
    rows = [(i, "same", None, None, 0) for i in range(3000)] + [(9000 + i, f"t{i}", None, None, 0) for i in range(50)]
    spec = ShardSpec(shards=6, ranges_per_shard=3, sample_per_range=2)
    held = check_shards(shard_documents(spark.createDataFrame(rows, SCHEMA), spec).collect(), 6)
    assert len(held) == 6 and max(held.values()) - min(held.values()) <= 40


def test_awkward_and_empty_tables_for_shards(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("x")).withColumn("slot", F.lit(1.5)).withColumn("size", F.lit(None))
    out = shard_documents(df, ShardSpec(shards=3)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((r[0], r[1]) for r in rows)
    check_shards(out, 3)
    assert {r["size"] for r in out if r["text"] is None} == {16}
    assert shard_documents(df.limit(0)).count() == 0
    assert shard_by_size(df.drop("size"), F.lit(1), F.lit(0), ShardSpec(shards=2)).count() == len(rows)


@pytest.mark.parametrize("tokens,weights,want", [
    ([100, 100, 100], [1, 2, 3], [50, 100, 150]),
    ([10, 1000], [1, 1], [30, 980]),
    ([0, 60], [5, 1], [0, 60]),
    ([], [], []),
])
def test_share_out(tokens, weights, want):
    assert share_out(tokens, weights, 3) == pytest.approx(want)


def test_mix_meets_targets_and_bounds(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(1, 80)), None, "big" if i % 3 else f"s{i % 7}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    spec = MixSpec(block=16, shard_slots=64, bucket_rows=50)
    out = mix_documents(df, spec).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(900))
    size, taken, target, source = Counter(), Counter(), {}, Counter()
    for r in out:
        assert r["size"] == len(WORD.findall(r["text"])) and 0 <= r["taken"] <= 3 * r["size"]
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]], source[r["source"]] = r["target"], r["source_size"]
    assert size == source
    names = sorted(size)
    assert [target[n] for n in names] == pytest.approx(share_out([size[n] for n in names], default_weights(names), 3))
    for n in names:
        assert abs(taken[n] - target[n]) <= 0.06 * target[n] + 2 * spec.block
    again = mix_documents(df.repartition(3), spec).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in out)
    copies = Counter(r["doc_id"] for r in mixed_copies(mix_documents(df, spec), df.columns).collect())
    for r in out:
        assert r["taken"] // r["size"] <= copies[r["doc_id"]] <= -(-r["taken"] // r["size"])


def test_awkward_and_empty_tables_for_mixing(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("taken", F.lit("x")).withColumn("n", F.lit(7)).withColumn("start", F.lit("s"))
    out = mix_documents(df, MixSpec(block=8, shard_slots=16, bucket_rows=4)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((r[0], r[1]) for r in rows)
    for r in out:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["taken"] <= 3 * r["size"]
    assert mix_documents(df.limit(0)).count() == 0
    assert mix_documents(df.where("text is null")).agg(F.sum("taken")).first()[0] == 0
