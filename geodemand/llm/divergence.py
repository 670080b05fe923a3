"""Quality rules by distribution divergence (operator 9, built-in functions only).

Each document's character classes and common words are compared, as
histograms, to language references by Jensen-Shannon distance (base 2, 0 to 1).
References are counted over all documents. A document is judged against the
nearest of the widespread languages and its own language, and only if it is
long enough for its histograms to mean something. A document of a language
with too few words for a reference is judged by its base counts alone.

All of a document's figures are computed inside its own row. The references of
widespread languages (bounded by ``min_share``) are constants; those of the
others, however many, are a table joined by language.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CHARS, fresh, shared_table, small_side, words


@dataclass(frozen=True)
class QualitySpec:
    """References: languages with at least ``min_ref_words`` words, their ``common_words`` most frequent
    words, each at least ``min_word_share`` of its language. Every document is compared to the languages
    with at least ``min_share`` of all words, and to its own. A text of at least
    ``min_words`` words fails if its common-word distance exceeds ``max_words_jsd``, one of at
    least ``min_chars`` characters if its character-class distance exceeds ``max_class_jsd``, one
    that is long enough for both if their sum exceeds ``max_sum_jsd``."""

    common_words: int = 40
    min_ref_words: int = 5_000
    min_share: float = 0.01
    min_word_share: float = 0.0005
    min_words: int = 50
    min_chars: int = 200
    max_class_jsd: float = 0.28
    max_words_jsd: float = 0.45
    max_sum_jsd: float = 0.55
    broadcast_langs: int = 10_000


# The character classes in order; what matches none of them is the last one.
CLASSES = ["space", "lower", "upper", "digit", "point", "symbol", "other"]
PLAIN = "[\\p{Ll} \\t\\n\\x0B\\f\\r]+"
UPPER = "\\p{Lu}+"
DIGIT = "\\p{Nd}+"
POINTS = ".,;:!?'\"()-"
SYMBOLS = "#*$%&|<>"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _removed(text: Column, rest: Column) -> Column:
    return F.length(text) - F.length(rest)


def with_rest(df: DataFrame) -> DataFrame:
    """Adds (hidden) the words and what is left of the text without lower-case letters and white space:
    a small part of ordinary prose, from which the other classes are counted."""
    return df.withColumn(fresh("words"), words(F.col("text"))).withColumn(fresh("rest"), F.regexp_replace(F.coalesce("text", F.lit("")), PLAIN, ""))


def _repeat_words(w: Column) -> Column:
    """Words inside a 3-word window that occurs at least twice.

    Windows become longs: hash in the high bits, position in the low ones, so
    that sorting puts equal windows side by side; then the union of the
    repeated windows' positions is measured.
    """
    n = F.size(w)
    bits = F.length(F.bin(n.cast("long")))
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    packed = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.call_function("shiftleft", window(i), bits).bitwiseOR(i.cast("long")),
        )
    )

    def measure(p: Column) -> Column:
        high = lambda x: F.call_function("shiftright", x, bits)
        twin = F.filter(p, lambda x, j: (high(x) == high(F.get(p, j - 1))) | (high(x) == high(F.get(p, j + 1))))
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        at = F.sort_array(F.transform(twin, lambda x: x.bitwiseAND(low).cast("int")))
        return F.aggregate(
            at,
            F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(3), i - acc["last"])).alias("sum"), i.alias("last")),
            lambda acc: acc["sum"],
        )

    # one-element transform: binds the sorted array once for all the lambdas that look at it
    found = F.element_at(F.transform(F.array(packed), lambda p: F.coalesce(measure(p), F.lit(0).cast("long"))), 1)
    return F.when(n >= 4, found).otherwise(F.lit(0)).cast("long")


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


WORDS, REST = fresh("words"), fresh("rest")


def _symbols() -> Column:
    return _removed(F.col(REST), F.translate(F.col(REST), SYMBOLS, "")).cast("long")


def _word_chars() -> Column:
    return F.length(F.array_join(F.col(WORDS), "")).cast("long")


def with_base(df: DataFrame) -> DataFrame:
    """Adds the base counts to rows that have the hidden columns; a null text has none of anything."""
    return (
        df.withColumn("n_words", F.size(F.col(WORDS)).cast("long"))
        .withColumn("word_chars", _word_chars())
        .withColumn("n_symbols", _symbols())
        .withColumn("n_dup_lines", _dup_lines(F.coalesce("text", F.lit(""))))
        .withColumn("n_repeat_words", _repeat_words(F.col(WORDS)))
    )


def class_counts(word_chars: Column, symbols: Column) -> Column:
    """Array of character counts per class, given the base counts."""
    t = F.coalesce("text", F.lit(""))
    upper, digit = (_removed(F.col(REST), F.regexp_replace(F.col(REST), p, "")) for p in (UPPER, DIGIT))
    points = _removed(F.col(REST), F.translate(F.col(REST), POINTS, ""))
    space = F.length(t) - word_chars
    other = F.length(F.col(REST)) - upper - digit - points - symbols
    return F.array(*[x.cast("double") for x in (space, _removed(t, F.col(REST)) - space, upper, digit, points, symbols, other)])


@dataclass(frozen=True)
class References:
    """Per widespread language: class shares, and shares of its common words. ``others``: the same for all further
    languages, a row each (lang, words, other, classes), or None."""

    classes: dict[str, list[float]]
    words: dict[str, dict[str, float]]
    others: DataFrame | None = field(default=None, compare=False)


def language_references(docs: DataFrame, spec: QualitySpec = QualitySpec()) -> References:
    """Count the references over all documents (columns text, lang); rows without a language are left out."""
    spark = docs.sparkSession
    known = docs.where(F.col("lang").isNotNull()).select("lang", "text")
    k = len(CLASSES)
    counted = with_rest(known).select("lang", class_counts(_word_chars(), _symbols()).alias("c"), F.size(F.col(WORDS)).alias("n"))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"), *[F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(k)])
    chars = functools.reduce(operator.add, [F.col(f"c{i}") for i in range(k)])
    share = F.col("n") / F.sum("n").over(Window.partitionBy())  # one row per language
    totals = totals.select("lang", "n", F.array(*[F.col(f"c{i}") / chars for i in range(k)]).alias("classes"), (share >= spec.min_share).alias("widespread"))
    held = shared_table(spark, totals.where(F.col("n") >= spec.min_ref_words))
    sizes = small_side(held.select("lang", F.col("n").alias("all")), spec.broadcast_langs)
    count = known.join(sizes, "lang").select("lang", "all", F.explode(words(F.lower("text"))).alias("word")).groupBy("lang", "all", "word").count()
    # bounded: at most 1 / min_word_share words per language reach the ranking
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    top = count.where(F.col("count") >= F.col("all") * spec.min_word_share).withColumn("rank", rank).where(F.col("rank") <= spec.common_words)
    lists = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("word", (F.col("count") / F.col("all")).alias("share")))).alias("top"))
    refs = shared_table(spark, held.join(lists, "lang"))
    wide = refs.where("widespread").collect()  # bounded: at most 1 / min_share languages
    other = F.greatest(F.lit(0.0), 1 - F.aggregate("top", F.lit(0.0), lambda acc, x: acc + x["share"]))
    rest = refs.where("not widespread").select("lang", F.map_from_entries("top").alias("words"), other.alias("other"), "classes")
    return References(
        {r["lang"]: list(r["classes"]) for r in wide},
        {r["lang"]: {x["word"]: x["share"] for x in r["top"]} for r in wide},
        None if rest.isEmpty() else rest,
    )


def _term(p: Column, q: Column) -> Column:
    """One bin's share of the divergence, in bits."""
    half = lambda a: F.when(a > 0, a * F.log2(2 * a / (p + q))).otherwise(0.0)
    return (half(p) + half(q)) / 2


def _classes_distance(counts: Column, total: Column, ref: Column) -> Column:
    terms = F.zip_with(counts, ref, lambda c, q: _term(c / total, q))
    return F.when(total > 0, F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x))))


def _words_distance(runs: Column, n: Column, ref: Column, q_other: Column) -> Column:
    """``runs``: array of (word, count) of the document's common words of any language; ``ref``: map of shares."""
    mine = F.filter(F.transform(runs, lambda r: F.struct((r["n"] / n).alias("p"), F.try_element_at(ref, r["w"]).alias("q"))), lambda x: x["q"].isNotNull())
    start = F.struct(((1 - q_other) / 2).alias("jsd"), F.lit(0.0).alias("p"))
    step = lambda acc, x: F.struct((acc["jsd"] + _term(x["p"], x["q"]) - x["q"] / 2).alias("jsd"), (acc["p"] + x["p"]).alias("p"))
    done = lambda acc: F.sqrt(F.greatest(F.lit(0.0), acc["jsd"] + _term(F.greatest(F.lit(0.0), 1 - acc["p"]), q_other)))
    return F.when(n > 0, F.aggregate(mine, start, step, done))


def _as_column(refs: References) -> Column:
    """The references as one constant array, a struct per language."""
    one = lambda l: F.struct(
        F.lit(l).alias("lang"),
        F.create_map(*[F.lit(v) for w, q in sorted(refs.words[l].items()) for v in (w, q)]).cast("map<string,double>").alias("words"),
        F.lit(max(0.0, 1.0 - sum(refs.words[l].values()))).alias("other"),
        F.array(*[F.lit(q) for q in refs.classes[l]]).alias("classes"),
    )
    return F.array(*[one(l) for l in sorted(refs.words)])


def _runs(w: Column, vocabulary: list[str], own: Column | None) -> Column:
    """(word, count) of the words in ``vocabulary`` or the language's own map ``own``: sorted, then cut where the word changes."""
    wanted = lambda x: x.isin(vocabulary) if own is None else x.isin(vocabulary) | F.coalesce(F.map_contains_key(own, x), F.lit(False))
    common = F.sort_array(F.filter(F.transform(w, F.lower), wanted))

    def cut(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i)), lambda i: i.isNotNull())
        return F.element_at(
            F.transform(
                F.array(starts),
                lambda a: F.transform(a, lambda i, j: F.struct(F.get(s, i).alias("w"), (F.coalesce(F.get(a, j + 1), F.size(s)) - i).alias("n"))),
            ),
            1,
        )

    return F.element_at(F.transform(F.array(common), cut), 1)


def judge_quality(docs: DataFrame, refs: References, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """All columns of ``docs`` plus the base counts, ``nearest_lang``, ``words_jsd``, ``class_jsd``,
    ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base. Below the length
    guards, and for a text whose ``lang`` (if ``docs`` has that column) is not
    null and has no reference, a distance is null and fails nothing (and such a
    text has no ``nearest_lang``). Every row gives one row; input columns with these names are replaced.
    """
    added = [*BASE, "nearest_lang", "words_jsd", "class_jsd", "base_failed", "kept"]
    keep = [c for c in docs.columns if c not in added]
    out = with_base(with_rest(docs.select(*[F.col(f"`{c}`") for c in keep])))
    langs = sorted(refs.words)
    own, referenced = fresh("own"), F.lit(True)
    further = refs.others is not None and "lang" in docs.columns
    if further:
        theirs = refs.others.select(F.col("lang").alias(fresh("lang")), F.struct("lang", "words", "other", "classes").alias(own))
        out = out.join(small_side(theirs, spec.broadcast_langs), F.col("lang") == F.col(fresh("lang")), "left")
    if "lang" in docs.columns:
        referenced = F.col("lang").isNull() | F.col("lang").isin(langs) | (F.col(own).isNotNull() if further else F.lit(False))
    if langs or further:
        vocabulary = sorted({w for ref in refs.words.values() for w in ref})
        scored = out.withColumn(fresh("runs"), _runs(F.col(WORDS), vocabulary, F.col(own)["words"] if further else None))
        scored = scored.withColumn(fresh("classes"), class_counts(F.col("word_chars"), F.col("n_symbols")))
        counts, runs = F.col(fresh("classes")), F.col(fresh("runs"))
        total = F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x)
        against = [_as_column(refs)] if langs else []
        if further:
            against.append(F.filter(F.array(own), lambda r: r.isNotNull()))
        judged = F.transform(
            F.concat(*against) if len(against) > 1 else against[0],
            lambda r: F.struct(
                _words_distance(runs, F.col("n_words"), r["words"], r["other"]).alias("words"),
                r["lang"].alias("lang"),
                _classes_distance(counts, total, r["classes"]).alias("classes"),
            ),
        )
        out = scored.withColumn(fresh("best"), F.when(referenced, F.array_min(judged)))
        best = F.col(fresh("best"))
        long_enough = F.col("n_words") >= spec.min_words
        out = (
            out.withColumn("nearest_lang", F.when(F.col("n_words") > 0, best["lang"]))
            .withColumn("words_jsd", F.when(long_enough, best["words"]))
            .withColumn("class_jsd", F.when(F.length("text") >= spec.min_chars, best["classes"]))
        )
    else:
        out = out.withColumn("nearest_lang", F.lit(None).cast("string")).withColumn("words_jsd", F.lit(None).cast("double")).withColumn("class_jsd", F.lit(None).cast("double"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    by_words, by_class = F.col("words_jsd"), F.col("class_jsd")
    passes = lambda x, most: F.coalesce(x <= most, F.lit(True))
    near = passes(by_words, spec.max_words_jsd) & passes(by_class, spec.max_class_jsd) & passes(by_words + by_class, spec.max_sum_jsd)
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & near).select(*[F.col(f"`{c}`") for c in keep], *added)
