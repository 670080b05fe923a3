"""Benchmark decontamination by template canonicalisation (operator 7, built-in functions only).

Numbers, names and units become typed placeholders, everything else is
lower-cased, so a benchmark question and a re-parameterised copy of it share
their template. Windows of template tokens are hash-joined to the benchmark's
windows; a document contains an item when enough of the item's windows occur
in it and the slots are consistent: one value of the item stands for one value
in the document throughout, or throughout one of the places where the item occurs.
Items that templates cannot tell are matched word for word instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, shared_table, small_side


@dataclass(frozen=True)
class TemplateSpec:
    """Windows of ``window`` tokens (an item with fewer tokens is one window), of which at least
    ``min_words`` are words; an item without such a window, or in a script without spaces, is matched by windows of its raw
    tokens, if it has ``min_words`` of them (two characters count as one), else by the whole document. A document contains an item when at least ``min_cover`` of the item's
    windows occur and at least ``min_consistent`` of its slot values keep one counterpart, in the whole
    document or in one occurrence: the windows at one distance from the item's own positions, or up to
    ``max_shift`` tokens off it where words were put in or left out.
    The benchmark's windows are broadcast up to ``broadcast_rows``, else joined by shuffle."""

    window: int = 8
    min_words: int = 4
    min_cover: float = 0.4
    min_consistent: float = 0.8
    max_shift: int = 8
    broadcast_rows: int = 500_000


NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"

# Measures that count as units after a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams ton tons ounce ounces pound pounds lb "
    "ml l liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees mph kmh meter meters metre metres"
).split()

TOKEN = "[.!?\\n]+|[0-9]+(?:[.,][0-9]+)*|[\\p{L}\\p{M}\\p{N}]+"
ENDS = [".", "!", "?", "\n"]

# Letters written without spaces, one token each where items are matched as they are; signs of arithmetic.
UNSPACED = "\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}"
RAW_TOKEN = f"[0-9]+(?:[.,][0-9]+)*|[{UNSPACED}]|[\\p{{L}}\\p{{M}}\\p{{N}}&&[^{UNSPACED}]]+|[\\p{{Sm}}*/%^-]"


def template(text: Column) -> Column:
    """Array of (tag, raw): template token and the text it came from, in order; empty for null."""
    raw = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    first = lambda x: F.substring(x, 1, 1)
    is_number = lambda x: first(x).between("0", "9")

    def tag(x: Column, before: Column) -> Column:
        low = F.lower(x)
        capital = (first(x) != first(low)) & (F.length(x) > 1) & (F.substring(x, 2, 1_000_000) == F.substring(low, 2, 1_000_000))
        return (
            F.when(first(x).isin(ENDS), F.lit(None).cast("string"))
            .when(is_number(x), F.lit(NUMBER))
            .when(low.isin(UNITS) & F.coalesce(is_number(before), F.lit(False)), F.lit(UNIT))
            .when(capital & ~F.coalesce(first(before).isin(ENDS), F.lit(True)), F.lit(NAME))
            .otherwise(low)
        )

    def tagged(tokens: Column) -> Column:
        each = F.transform(tokens, lambda x, i: F.struct(tag(x, F.get(tokens, i - 1)).alias("tag"), x.alias("raw")))
        return F.filter(each, lambda t: t["tag"].isNotNull())

    return F.element_at(F.transform(F.array(raw), tagged), 1)


def _tokens(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, tags, raws) of every text, empty arrays where it has no tokens. A filter on them here would be moved
    below and make every template twice."""
    split = df.withColumn("t", template(F.col("text")))
    return split.select(*keys, F.transform("t", lambda x: x["tag"]).alias("tags"), F.transform("t", lambda x: x["raw"]).alias("raws"))


def _hash(tags: Column, at: Column, length: int) -> Column:
    """Hash of ``length`` tags from a position; null where they run past the end."""
    return F.when(at + length <= F.size(tags), F.xxhash64(F.lit(length), *[F.get(tags, at + k) for k in range(length)]))


def _windows(tokens: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """(keep, at, h): one row per window position of each length. Tags that are not kept are hashed
    where they are exploded and travel no further."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("tags") - min(lengths), F.lit(0)))
    each = tokens.select(*{*keep, "tags"}, F.explode(starts).alias("at"))
    found = [_hash(F.col("tags"), F.col("at"), m) for m in lengths]
    if len(found) == 1:
        out = each.select(*keep, "at", found[0].alias("h"))
    else:
        out = each.select(*keep, "at", F.array(*found).alias("hs")).select(*keep, "at", F.explode("hs").alias("h"))
    return out.where(F.col("h").isNotNull())


def benchmark_windows(benchmark: DataFrame, spec: TemplateSpec) -> tuple[DataFrame, list[int]]:
    """(h, item_id, item_at, slots, n_windows) of the item windows that can be matched, with their
    placeholders' values, and the window lengths in use (``spec.window``, and those of shorter items)."""
    items = _tokens(benchmark.where("text is not null").select("item_id", "text").dropDuplicates(), "item_id").where(F.size("tags") > 0)
    items = items.withColumn("m", F.least(F.size("tags"), F.lit(spec.window)))
    lengths = sorted({r[0] for r in items.select("m").distinct().collect()}) or [spec.window]  # at most spec.window values
    w = _windows(items, lengths, "item_id", "tags", "raws", "m").where(F.col("h") == F.coalesce(*[F.when(F.col("m") == m, _hash(F.col("tags"), F.col("at"), m)) for m in lengths]))
    cut = lambda c: F.slice(c, F.col("at") + 1, F.col("m"))
    w = w.select("h", "item_id", F.col("at").alias("item_at"), cut("tags").alias("tags"), cut("raws").alias("raws"))
    placed = F.transform("tags", lambda t, i: F.struct(t.alias("kind"), F.get("raws", i).alias("value"), i.alias("at")))
    kept = w.withColumn("slots", F.filter(placed, lambda s: s["kind"].isin(NUMBER, NAME, UNIT))).where(F.size("tags") - F.size("slots") >= spec.min_words)
    counts = kept.groupBy("item_id").agg(F.countDistinct("item_at").alias("n_windows")).withColumnRenamed("item_id", "i")
    return kept.join(counts, F.col("item_id").eqNullSafe(F.col("i"))).select("h", "item_id", "item_at", "slots", "n_windows"), lengths


def _same(a: DataFrame, b: DataFrame, part: list[str], how: str = "left") -> DataFrame:
    """``a`` joined to ``b`` on the columns ``part``, of which nulls are equal."""
    renamed = b.select(*[F.col(c).alias(fresh(c)) for c in part], *[c for c in b.columns if c not in part])
    return a.join(renamed, [F.col(c).eqNullSafe(F.col(fresh(c))) for c in part], how).drop(*[fresh(c) for c in part])


def _agreement(slots: DataFrame, part: list[str]) -> DataFrame:
    """(part, n_slots, single, n_changed, clear) of distinct slots (part, kind, value, stands): a slot value
    keeps one counterpart, and shares it with no other value of its kind."""
    each = slots.groupBy(*part, "kind", "value").agg(F.count(F.lit(1)).alias("ways"), F.max((F.col("value") != F.col("stands")).cast("int")).alias("changed"))
    taken = slots.groupBy(*part, "kind", "stands").agg(F.count(F.lit(1)).alias("users"))
    agreed = each.groupBy(*part).agg(F.count(F.lit(1)).alias("n_slots"), F.sum((F.col("ways") == 1).cast("int")).alias("single"), F.sum("changed").alias("n_changed"))
    clear = taken.groupBy(*part).agg((F.sum((F.col("users") == 1).cast("int")) / F.count(F.lit(1))).alias("clear"))
    return _same(agreed, clear, part)


def _consistent(spec: TemplateSpec) -> Column:
    return F.coalesce((F.col("single") >= spec.min_consistent * F.col("n_slots")) & (F.col("clear") >= spec.min_consistent), F.lit(True))


def _occurrences(mixed: DataFrame, hits: DataFrame, index: DataFrame, texts: DataFrame, spec: TemplateSpec) -> DataFrame:
    """(text_hash, item_id, n_found, n_slots, n_changed) of the best single occurrence that passes, of the
    texts and items in ``mixed``, whose slots do not agree over the whole text."""
    part = ["text_hash", "item_id"]
    mixed = shared_table(mixed.sparkSession, mixed)
    mine = _same(hits.select(*part, "at", "item_at").distinct(), small_side(mixed, spec.broadcast_rows), part, "inner")
    slots_of = index.select("item_id", "item_at", "slots").distinct()
    mine = _same(mine, small_side(slots_of, spec.broadcast_rows), ["item_id", "item_at"], "inner")
    own = texts.select("text_hash", "text").join(small_side(mixed.select("text_hash").distinct(), spec.broadcast_rows), "text_hash").groupBy("text_hash").agg(F.first("text").alias("text"))
    pair = lambda s: F.struct(s["kind"].alias("kind"), F.lower(s["value"]).alias("value"), F.lower(F.get("raws", F.col("at") + s["at"])).alias("stands"))
    mine = _tokens(own, "text_hash").drop("tags").join(mine, "text_hash").select(*part, "n_windows", "item_at", (F.col("at") - F.col("item_at")).alias("d"), F.transform("slots", pair).alias("pairs"))
    # an occurrence lies at one distance, or near it; of an item window's places it has the nearest
    place = lambda d, reach: F.struct(F.lit(reach).alias("reach"), d.alias("anchor"))
    near = F.transform(F.sequence(F.col("d") - spec.max_shift, F.col("d") + spec.max_shift), lambda d: place(d, spec.max_shift))
    exact = F.array(place(F.col("d"), 0))
    mine = mine.withColumn("place", F.explode(F.concat(exact, near) if spec.max_shift else exact)).select("*", "place.*")
    here = [*part, "reach", "anchor"]
    nearest = F.min(F.struct(F.abs(F.col("d") - F.col("anchor")).alias("off"), "d", "pairs")).alias("one")
    chosen = shared_table(mixed.sparkSession, mine.groupBy(*here, "n_windows", "item_at").agg(nearest).select(*here, "n_windows", "one.pairs"))
    found = chosen.groupBy(*here, "n_windows").agg(F.count(F.lit(1)).alias("n_found")).where(F.col("n_found") >= spec.min_cover * F.col("n_windows"))
    slots = chosen.select(*here, F.explode("pairs").alias("s")).select(*here, "s.*").distinct()
    passed = _same(found, _agreement(slots, here), here).where(_consistent(spec))
    facts = F.struct("n_found", (-F.coalesce("n_changed", F.lit(0))).alias("kept"), "n_slots", "n_changed")
    return passed.groupBy(*part).agg(F.max(facts).alias("best")).select(*part, "best.n_found", "best.n_slots", "best.n_changed")


def _raw_tokens(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, tags) of texts with tokens: lower-case words, numbers, signs and unspaced characters as they are."""
    return df.select(*keys, F.regexp_extract_all(F.lower("text"), F.lit(RAW_TOKEN), F.lit(0)).alias("tags")).where(F.size("tags") > 0)


def untemplated_items(benchmark: DataFrame, spec: TemplateSpec = TemplateSpec()) -> DataFrame:
    """Distinct (item_id, text) of items that their template cannot tell: no window has enough words, or the script has no spaces."""
    items = benchmark.where("text is not null").select("item_id", "text").dropDuplicates().withColumn("tags", F.transform(template(F.col("text")), lambda t: t["tag"]))
    m = F.least(F.size("tags"), F.lit(spec.window))
    is_word = lambda at: F.size(F.filter(F.slice("tags", at + 1, m), lambda t: ~t.isin(NUMBER, NAME, UNIT))) >= spec.min_words
    told = F.exists(F.sequence(F.lit(0), F.size("tags") - m), is_word)
    return items.where(~told | F.rlike("text", F.lit(f"[{UNSPACED}]"))).select("item_id", "text")


def _contained_as_they_are(docs: DataFrame, items: DataFrame, spec: TemplateSpec) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, n_found) by raw tokens: enough of an item's windows
    occur, or an item that is too short for that is the whole document."""
    key = ["doc_id", "text_hash", "item_id"]
    tokens = _raw_tokens(items, "item_id")
    heavy = F.size(F.filter("tags", lambda t: F.rlike(t, F.lit("^[\\p{L}\\p{M}\\p{N}]"))))
    letters = F.size(F.filter("tags", lambda t: F.rlike(t, F.lit(f"^[{UNSPACED}]"))))
    tokens = shared_table(items.sparkSession, tokens.withColumn("long", heavy - letters / 2 >= spec.min_words).withColumn("m", F.least(F.size("tags"), F.lit(spec.window))))
    texts = _raw_tokens(docs, "doc_id", "text_hash")
    short = tokens.where("not long").select(F.xxhash64("tags").alias("h"), "item_id").distinct()
    whole = texts.select("doc_id", "text_hash", F.xxhash64("tags").alias("h")).join(small_side(short, spec.broadcast_rows), "h")
    found = whole.select(*key, F.lit(1).cast("long").alias("n_windows"), F.lit(1).cast("long").alias("n_found")).distinct()
    tokens = tokens.where("long")
    lengths = sorted({r[0] for r in tokens.select("m").distinct().collect()})  # at most spec.window values
    if lengths:
        index = _windows(tokens, lengths, "item_id", "tags", "m").where(F.col("h") == F.coalesce(*[F.when(F.col("m") == m, _hash(F.col("tags"), F.col("at"), m)) for m in lengths]))
        index = index.select("h", "item_id", F.col("at").alias("item_at"))
        index = shared_table(items.sparkSession, _same(index, index.groupBy("item_id").agg(F.countDistinct("item_at").alias("n_windows")), ["item_id"], "inner"))
        hits = _windows(texts, lengths, "doc_id", "text_hash").join(small_side(index, spec.broadcast_rows), "h")
        counted = hits.groupBy(*key, "n_windows").agg(F.countDistinct("item_at").alias("n_found"))
        found = found.unionByName(counted.where(F.col("n_found") >= spec.min_cover * F.col("n_windows")))
    return found


def contained_items(docs: DataFrame, benchmark: DataFrame, spec: TemplateSpec = TemplateSpec()) -> DataFrame:
    """One row per document and benchmark item that it contains: doc_id, text_hash, item_id, n_windows,
    n_found, cover, n_slots, n_changed (slot values that differ from the item's) and consistent.

    The figures are those of the whole document, or of the best occurrence where only single ones pass.
    Repeated rows with equal doc_id and text give one row. Null and empty texts
    contain nothing; null and empty items are contained in nothing. Without
    items or documents the result is empty.
    """
    spark = docs.sparkSession
    index, lengths = benchmark_windows(benchmark, spec)
    index = shared_table(spark, index)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    narrow = small_side(index.select("h", "item_id", "item_at", "n_windows"), spec.broadcast_rows)
    hits = shared_table(spark, _windows(_tokens(texts, "doc_id", "text_hash"), lengths, "doc_id", "text_hash").join(narrow, "h").drop("h"))
    key = ["doc_id", "text_hash", "item_id"]
    found = hits.groupBy(*key, "n_windows").agg(F.countDistinct("item_at").alias("n_found"))
    found = found.where(F.col("n_found") >= spec.min_cover * F.col("n_windows"))
    # the raw words behind the slots: only of texts that match an item with slots
    with_slots = index.where(F.size("slots") > 0).select("item_id", F.col("item_at").alias("i_at"), "slots").distinct()
    match = hits.join(small_side(with_slots.withColumnRenamed("item_id", "i"), spec.broadcast_rows), F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_at") == F.col("i_at")))
    match = shared_table(spark, match.select("text_hash", "item_id", "at", "slots").distinct())
    own = texts.select("text_hash", "text").join(small_side(match.select("text_hash").distinct(), spec.broadcast_rows), "text_hash").groupBy("text_hash").agg(F.first("text").alias("text"))
    pairs = _tokens(own, "text_hash").drop("tags").join(match, "text_hash").select(
        "text_hash", "item_id", F.explode(F.transform("slots", lambda s: F.struct(s["kind"].alias("kind"), F.lower(s["value"]).alias("value"), F.lower(F.get("raws", F.col("at") + s["at"])).alias("stands")))).alias("s")
    )
    slots = pairs.select("text_hash", "item_id", "s.*").distinct()
    judged = _same(found, _agreement(slots, ["text_hash", "item_id"]), ["text_hash", "item_id"])
    judged = shared_table(spark, judged.withColumn("agrees", _consistent(spec)))
    facts = ["n_windows", "n_found", "n_slots", "n_changed"]
    out = judged.where("agrees").select(*key, *facts)
    mixed = judged.where("not agrees")
    if not mixed.isEmpty():
        one = _occurrences(mixed.select("text_hash", "item_id", "n_windows").distinct(), hits, index, texts, spec)
        out = out.unionByName(_same(mixed.select(*key, "n_windows"), one, ["text_hash", "item_id"], "inner").select(*key, *facts))
    untold = shared_table(spark, untemplated_items(benchmark, spec))
    if not untold.isEmpty():
        more = _contained_as_they_are(texts, untold, spec).withColumn("n_slots", F.lit(0).cast("long")).withColumn("n_changed", F.lit(0).cast("long"))
        out = out.withColumn("by", F.lit(1)).unionByName(more.withColumn("by", F.lit(0)))
        out = out.groupBy(*key).agg(F.max(F.struct("by", *facts)).alias("best")).select(*key, "best.*")
    return out.select(
        *key, "n_windows", "n_found", (F.col("n_found") / F.col("n_windows")).alias("cover"),
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("n_changed", F.lit(0)).cast("long").alias("n_changed"),
    )


def without_contained(docs: DataFrame, benchmark: DataFrame, spec: TemplateSpec = TemplateSpec()) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    bad = contained_items(docs, benchmark, spec).select(F.col("text_hash").alias(fresh("bad"))).distinct()
    return docs.join(small_side(bad, spec.broadcast_rows), F.xxhash64(docs["text"]) == F.col(fresh("bad")), "left_anti")
