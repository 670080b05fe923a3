"""Line deduplication by MinHash (operator 1, built-in functions only).

Lines are compared by their sets of character n-grams. Equal lines are one
node. A line's signature is made by one-permutation MinHash: its n-gram hashes
are dealt into bins and each bin keeps its least, an empty bin taking the next
one's; signature bands propose candidates with high recall; candidates are
verified by exact Jaccard similarity; distributed union-find over the verified
links gives components, and one line per component is kept.

Within a band bucket, lines are first verified against one of them; then, with
the components known, the others of the bucket across components only. An exact bound (size and
parity-sketch distance) discards hopeless pairs before they are verified, in
the last step inside the join. So a bucket of thousands of similar lines never
turns into all pairs. Between two components the likeliest pair is verified
first, and the others only if that one is no link.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, release, shared_table, small_side
from .components import connected_components


@dataclass(frozen=True)
class LineSpec:
    """Lines link at a Jaccard similarity of at least ``percent`` in 100 over ``n``-character n-grams.
    9 bands of 3 rows propose 0.997 or more of the pairs at 0.8, whatever the lines' length (measured)."""

    n: int = 8
    percent: int = 80
    bands: int = 9
    rows: int = 3
    sketch_longs: int = 32
    broadcast_rows: int = 500_000


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no from 0, line hash, line) of every line; blank lines have a null hash, null texts no lines."""
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # trimming walks the whole line; one whose outer bytes lie above all white space needs none
    end = lambda at: F.substring(F.col("line").cast("binary"), F.lit(at), F.lit(1)) > F.lit(b" ")
    bare = F.when(end(1) & end(-1), F.col("line")).otherwise(F.btrim("line", F.lit(SPACE_CHARS)))
    return rows.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.when(bare != "", F.xxhash64(bare)).alias("lid"), bare.alias("line"))


def _gram(encoded: Column, at: Column, n: int) -> Column:
    """Hash of the n-gram that starts at byte ``at`` (from 1) of UTF-32 text: a fixed-width slice."""
    return F.xxhash64(F.substring(encoded, at, F.lit(4 * n)))


def _gram_starts(encoded: Column, n: int) -> Column:
    """First byte of every n-gram of UTF-32 text; a shorter text is one n-gram."""
    return F.sequence(F.lit(1), F.greatest(F.octet_length(encoded) - (4 * n - 4), F.lit(1)), F.lit(4))


def _encoded(line: Column) -> Column:
    return F.encode(line, "UTF-32")


def grams(line: Column, n: int) -> Column:
    """Distinct n-gram hashes of a line; a shorter line is one n-gram."""
    code = F.transform(F.array(_encoded(line)), lambda e: F.transform(_gram_starts(e, n), lambda at: _gram(e, at, n)))
    return F.array_distinct(F.element_at(code, 1))


def _each_gram(lines: DataFrame, n: int) -> DataFrame:
    """(lid, h): a row per n-gram, repeats included."""
    # encoded below the explode, once per line; above it, every n-gram would encode its line again
    coded = lines.select("lid", _encoded(F.col("line")).alias("e"))
    return coded.select("lid", "e", F.explode(_gram_starts(F.col("e"), n)).alias("at")).select("lid", _gram(F.col("e"), F.col("at"), n).alias("h"))


def _filled(least: Column) -> Column:
    """Bins with each empty one taking the next that is not, around the end."""
    twice = F.concat(least, least)
    return F.transform(least, lambda m, i: F.coalesce(m, F.get(F.filter(F.slice(twice, i + 2, F.size(least) - 1), lambda x: x.isNotNull()), F.lit(0))))


def band_keys(distinct: DataFrame, spec: LineSpec) -> DataFrame:
    """(lid, bands): signature bands of lines that are partitioned by ``lid`` already, so the minima need no shuffle."""
    k = spec.bands * spec.rows
    # never null, so the minima are made without null checks
    binned = _each_gram(distinct, spec.n).withColumn("bin", F.coalesce(F.pmod("h", F.lit(k)).cast("int"), F.lit(0)))
    # filtered aggregates: an n-gram touches its own bin only
    least = binned.groupBy("lid").agg(*[F.expr(f"min(h) filter (where bin = {i})").alias(f"m{i}") for i in range(k)])
    bins = least.select("lid", F.array(*[f"m{i}" for i in range(k)]).alias("m")).select("lid", _filled(F.col("m")).alias("m"))
    return bins.select("lid", F.array(*[F.xxhash64(F.lit(b), *[F.col("m")[b * spec.rows + r] for r in range(spec.rows)]) for b in range(spec.bands)]).alias("bands"))


def _apart(spec: LineSpec, a: str, b: str) -> Column:
    """Bits in which two sketches differ: never more than the n-grams that only one of the lines has."""
    return functools.reduce(operator.add, [F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(spec.sketch_longs)])


def _possible(spec: LineSpec, a: str = "a", b: str = "b") -> Column:
    """Necessary for a link: sizes near enough, and sketches no further apart than two such sets can be."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * F.least(na, nb) >= spec.percent * F.greatest(na, nb)) & ((100 + spec.percent) * _apart(spec, a, b) <= (100 - spec.percent) * (na + nb))


def _sketches(texts: DataFrame, spec: LineSpec) -> DataFrame:
    """(lid, n, s0..): set size and parity sketch of each line."""
    # the sets are generated, not projected: the optimizer would make them once more to ask for their size
    sets = texts.select("lid", F.explode(F.array(grams(F.col("line"), spec.n))).alias("g"))
    each = sets.select("lid", F.explode("g").alias("h"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    word = F.pmod(F.shiftright("h", 6), F.lit(spec.sketch_longs))
    folded = each.select("lid", bit.alias("bit"), word.cast("int").alias("word")).groupBy("lid").agg(
        F.count(F.lit(1)).alias("n"), *[F.expr(f"bit_xor(bit) filter (where word = {i})").alias(f"s{i}") for i in range(spec.sketch_longs)]
    )
    return folded.fillna(0)


def _linked(pairs: DataFrame, texts: DataFrame, spec: LineSpec) -> DataFrame:
    """Those of the distinct pairs (a, b) whose n-gram sets are similar enough, by exact count."""
    side = lambda x: texts.select(F.col("lid").alias(x), F.col("line").alias(f"l{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    # a generated column is made once a row; a projected one would be put into the condition, once for every use
    sets = both.select("a", "b", F.explode(F.array(F.struct(grams(F.col("la"), spec.n).alias("x"), grams(F.col("lb"), spec.n).alias("y")))).alias("g"))
    return sets.where((100 + spec.percent) * F.size(F.array_intersect("g.x", "g.y")) >= spec.percent * (F.size("g.x") + F.size("g.y"))).select("a", "b")


def line_links(lines: DataFrame, spec: LineSpec) -> DataFrame:
    """(node, root) over line hashes; lines without links are left out."""
    spark = lines.sparkSession
    distinct = lines.where("lid is not null").groupBy("lid").agg(F.first("line").alias("line"))
    nodes = shared_table(spark, band_keys(distinct, spec))
    postings = nodes.select("lid", F.explode("bands").alias("bk"))
    # buckets of two and more lines, each with the line that the others are first compared to
    buckets = shared_table(spark, postings.groupBy("bk").agg(F.count(F.lit(1)).alias("held"), F.min("lid").alias("hub")).where("held > 1").select("bk", "hub"))
    members = shared_table(spark, postings.join(small_side(buckets, spec.broadcast_rows), "bk"))
    release(buckets)
    # the lines that share a bucket are read again from the source, once
    wanted = shared_table(spark, members.select("lid").distinct())
    texts = shared_table(spark, lines.select("lid", "line").join(small_side(wanted, spec.broadcast_rows), "lid").groupBy("lid").agg(F.first("line").alias("line")))
    facts = shared_table(spark, _sketches(texts, spec))

    facing = members.where("lid <> hub").select(F.col("hub").alias("x"), F.col("lid").alias("y")).distinct()
    near = facing.join(facts.alias("a"), F.col("x") == F.col("a.lid")).join(facts.alias("b"), F.col("y") == F.col("b.lid")).where(_possible(spec))
    pairs = shared_table(spark, near.select(F.col("x").alias("a"), F.col("y").alias("b")))
    roots = connected_components(_linked(pairs, texts, spec), "a", "b")
    release(pairs, wanted)

    # buckets that still hold more than one component; their hubs have been compared with all the others
    now = members.where("lid <> hub").select("bk", "lid").join(roots.withColumnRenamed("node", "lid"), "lid", "left").withColumn("root", F.coalesce("root", "lid"))
    mixed = now.groupBy("bk").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bk")
    apart = now.join(mixed, "bk").select("bk", "lid", "root")
    bands = nodes.select("lid", *[F.col("bands")[i].alias(f"b{i}") for i in range(spec.bands)], "bands")
    rest = apart.join(facts, "lid").join(bands, "lid").withColumn("band", F.array_position("bands", F.col("bk")) - 1).drop("bands")
    # columns that are never null keep the join's condition small enough for the JVM to compile
    rest = shared_table(spark, rest).fillna(0)
    a, b = rest.alias("a"), rest.alias("b")
    # a pair that shares several buckets is looked at in the first of them
    is_first = functools.reduce(operator.and_, [(F.col("a.band") <= i) | (F.col(f"a.b{i}") != F.col(f"b.b{i}")) for i in range(spec.bands)])
    across = a.join(b, (F.col("a.bk") == F.col("b.bk")) & (F.col("a.lid") < F.col("b.lid")) & (F.col("a.root") != F.col("b.root")) & is_first & _possible(spec))
    off = (_apart(spec, "a", "b") / (F.col("a.n") + F.col("b.n"))).alias("off")
    pairs = shared_table(spark, across.select(F.col("a.lid").alias("a"), F.col("b.lid").alias("b"), F.least("a.root", "b.root").alias("u"), F.greatest("a.root", "b.root").alias("v"), off))
    release(rest)
    # one link joins two components, so of the pairs between them the likeliest is verified first ...
    likely = shared_table(spark, pairs.groupBy("u", "v").agg(F.min(F.struct("off", "a", "b")).alias("p")).select("p.a", "p.b", "u", "v"))
    joins = shared_table(spark, _linked(likely.select("a", "b"), texts, spec))
    # ... and the others only where that one is no link
    settled = likely.join(joins, ["a", "b"]).select("u", "v")
    others = shared_table(spark, pairs.join(settled, ["u", "v"], "left_anti").join(likely, ["a", "b"], "left_anti").select("a", "b"))
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(joins).unionByName(_linked(others, texts, spec))
    found = connected_components(links, "a", "b")
    release(nodes, members, texts, facts, pairs, likely, joins, others)
    return found


def line_classes(docs: DataFrame, spec: LineSpec = LineSpec()) -> DataFrame:
    """One row per line: doc_id, line_no, line_hash, component (its class), n_class_lines and kept.

    The kept line of a class is its first by (doc_id, line_no), nulls last.
    Blank lines have no class and are kept; a null text has no lines, an empty
    one has one blank line. Repeated rows are lines of their own, of which one
    stays. Lines are told apart by 64-bit hashes of their trimmed text.
    """
    lines = lines_of(docs)
    roots = line_links(lines, spec)
    found = lines.where("lid is not null").select("doc_id", "line_no", "lid")
    named = found.join(small_side(roots, spec.broadcast_rows), F.col("lid") == F.col("node"), "left").select("doc_id", "line_no", "lid", F.coalesce("root", "lid").alias("component"))
    # repeated rows agree in all of these; they are numbered when written out
    counted = named.groupBy("component", "doc_id", "line_no", "lid").agg(F.count(F.lit(1)).alias("times"))
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("line_no"), F.col("lid"))
    first = counted.groupBy("component").agg(F.min(place).alias("first"), F.sum("times").alias("held")).withColumnRenamed("component", "c")
    each = counted.join(first, F.col("component") == F.col("c")).select("*", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("i"))
    out = each.select("doc_id", "line_no", F.col("lid").alias("line_hash"), "component", F.col("held").alias("n_class_lines"), (place.eqNullSafe(F.col("first")) & (F.col("i") == 1)).alias("kept"))
    nothing = [F.lit(None).cast("long").alias(c) for c in ("line_hash", "component", "n_class_lines")]
    return out.unionByName(lines.where("lid is null").select("doc_id", "line_no", *nothing, F.lit(True).alias("kept")))
