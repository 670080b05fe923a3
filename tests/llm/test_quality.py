import math
import random
from collections import Counter

from helpers import SCHEMA, WORD, awkward_rows, prose

from geodemand.llm.divergence import References, QualitySpec, judge_quality, language_references
from pyspark.sql import functions as F


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    cover = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(cover)


def test_base_counts_match_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("a b c d e".split()) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += ["x y z x y z", "x y z w x y z", "a\n\n a\na\na", "é ü\x0bß\x0cÉ|<>#", " lead and trail ", "a a a a", "the same the", "\n".join(["l m n o"] * 5)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(-1 - i, *r[1:]) for i, r in enumerate(awkward_rows())]
    out = judge_quality(spark.createDataFrame(rows, SCHEMA), References({}, {})).collect()
    assert len(out) == len(rows)
    for r in out:
        want = base(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, r["text"]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"])


def distance(p, q):
    return math.sqrt(max(0.0, sum((a * math.log2(2 * a / (a + b)) if a else 0) / 2 + (b * math.log2(2 * b / (a + b)) if b else 0) / 2 for a, b in zip(p, q))))


def test_distances_match_brute_force(spark):
    rng = random.Random(5)
    en = [(i, prose(rng, 150), "en", "s", 0) for i in range(40)]
    fr = [(100 + i, prose(rng, 150, ("le", "la", "é", "ou", "que")), "fr", "s", 0) for i in range(40)]
    junk = [(200, " ".join("#%&" + str(rng.randint(0, 9)) for _ in range(150)), None, "s", 0)]
    df = spark.createDataFrame(en + fr + junk, SCHEMA)
    spec = QualitySpec(common_words=12, min_ref_words=1000)
    refs = language_references(df, spec)
    assert set(refs.words) == {"en", "fr"}
    for lang, rows in (("en", en), ("fr", fr)):
        count = Counter(w for r in rows for w in WORD.findall(r[1].lower()))
        n = sum(count.values())
        top = sorted(count.items(), key=lambda x: (-x[1], x[0]))[:12]
        assert refs.words[lang] == {w: c / n for w, c in top}
        assert math.isclose(sum(refs.classes[lang]), 1.0)
    out = {r["doc_id"]: r for r in judge_quality(df, refs, spec).collect()}
    for i, text, *_ in en + fr + junk:
        w = WORD.findall(text.lower())
        each = {}
        for lang, ref in refs.words.items():
            mine = [w.count(x) / len(w) for x in ref]
            each[lang] = distance(mine + [1 - sum(mine)], [*ref.values(), 1 - sum(ref.values())])
        best = min(each, key=lambda x: (each[x], x))
        assert out[i]["nearest_lang"] == best and math.isclose(out[i]["words_jsd"], each[best], abs_tol=1e-9)
    assert all(out[r[0]]["kept"] for r in en + fr) and not out[200]["kept"]


def test_clean_texts_of_small_languages_stay(spark):
    """No language loses its texts for being small beside another one, whether or not it has a reference of its own."""
    rng = random.Random(7)
    tongues = {"fi": ("kuu", "yö", "lla", "nen", "tta", "vä"), "th": ("กา", "มา", "ที่", "ไป", "เด"), "sw": ("wa", "ki", "ngo", "mba", "ji")}
    rows = [(i, prose(rng, 120), "en", "s", 0) for i in range(1200)]
    small = [(10_000 + 1000 * k + i, prose(rng, 120, syllables), lang, "s", 0) for k, (lang, syllables) in enumerate(tongues.items()) for i in range(8 if lang != "sw" else 60)]
    junk = [(20_000 + i, " ".join("#%&" + str(rng.randint(0, 9)) for _ in range(150)), lang, "s", 0) for i, lang in enumerate(("en", "sw", None))]
    df = spark.createDataFrame(rows + small + junk, SCHEMA)
    refs = language_references(df, QualitySpec(min_share=0.08))
    assert set(refs.words) == {"en"} and [r["lang"] for r in refs.others.collect()] == ["sw"]
    out = {r["doc_id"]: r for r in judge_quality(df, refs).collect()}
    assert len(out) == len(rows + small + junk) and all(out[r[0]]["kept"] for r in rows + small)
    assert all(out[r[0]]["nearest_lang"] == "sw" and out[r[0]]["words_jsd"] is not None for r in small if r[2] == "sw")
    assert all(out[r[0]]["words_jsd"] is None for r in small if r[2] in ("fi", "th"))
    assert not any(out[r[0]]["kept"] for r in junk)


def test_edges(spark):
    df = spark.createDataFrame(awkward_rows(), SCHEMA).withColumn("kept", F.lit("x")).withColumn("n_words", F.lit("y"))
    out = judge_quality(df, language_references(df)).collect()
    assert len(out) == len(awkward_rows())
    short = [r for r in out if r["n_words"] < 50]
    assert short and all(r["words_jsd"] is None and not r["kept"] for r in short)
    none = language_references(df.limit(0))
    assert none == References({}, {}) and judge_quality(df.limit(0), none).count() == 0
