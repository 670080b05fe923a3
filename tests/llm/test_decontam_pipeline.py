import os
import random
import shutil
from collections import Counter

import pytest
from helpers import SCHEMA, SF, WORD, awkward_rows, groups, prose, similar
from test_similarity import word_sets

import corpus_pipeline
from geodemand.llm import queries
from geodemand.llm.template_decontam import TemplateSpec, contained_items, template, without_contained
from pyspark.sql import functions as F

QUESTION = "A farmer named Alice has 12 apples and sells 5 kg of them at the market each day. How many apples does Alice keep after 3 days of selling at the market?"
PAD = "This is unrelated prose that goes on for a while before and after the point. "


def found(spark, text, item=QUESTION):
    docs = spark.createDataFrame([(1, text, None, None, None)], SCHEMA)
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    return [r.asDict() for r in contained_items(docs, bench).collect()]


def test_templates(spark):
    df = spark.createDataFrame([("Tom saw Ann. They ran 3.5 km in 2 hours.",)], "text string")
    tags = [t["tag"] for t in df.select(template(F.col("text")).alias("t")).first()["t"]]
    assert tags == "tom saw <name> they ran <number> <unit> in <number> <unit>".split()


@pytest.mark.parametrize("change,changed", [
    (lambda q: q, 0),
    (lambda q: q.replace("12", "40").replace("5 kg", "9 lb").replace(" 3 ", " 8 "), 4),
    (lambda q: q.replace("Alice", "Bob"), 1),
    (lambda q: "\n".join(q.split(", ")).replace(" ", "  "), 0),
])
def test_copies_and_reparameterised_copies_are_found(spark, change, changed):
    out = found(spark, PAD + change(QUESTION) + " " + PAD)
    assert [r["item_id"] for r in out] == [7] and out[0]["n_changed"] == changed


def test_inconsistent_slots_are_not_the_question(spark):
    item = "If Ann has 4 pens then Ann buys 4 pens and Ann gives 4 pens away to a friend with 4 pens while Ann keeps 4 pens of hers."
    same = item.replace("4", "6")
    assert found(spark, PAD + same, item)
    mixed = item
    for n in "15678":
        mixed = mixed.replace(" 4 ", f" {n} ", 1)
    assert not found(spark, PAD + mixed, item)


def test_each_occurrence_counts_by_itself(spark):
    variant = lambda name, a, b, c: QUESTION.replace("Alice", name).replace("12", a).replace("5 kg", f"{b} lb").replace(" 3 ", f" {c} ")
    sheet = [QUESTION, variant("Bob", "40", "9", "8"), variant("Carol", "31", "7", "6")]
    for text in (PAD.join(sheet), " ".join(sheet[1:]), PAD.join(sheet).replace("at the market", "at the old town market")):
        out = found(spark, PAD + text + " " + PAD)
        assert [r["item_id"] for r in out] == [7] and out[0]["n_slots"] == 6, text
    assert found(spark, PAD.join(sheet))[0]["n_changed"] == 0
    item = "At the school fair today we see that Tom has 3 apples and Ann has 5 apples and Bob has 7 apples and Eve has 9 apples and Joe has 2 apples in all."
    assert [(r["item_id"], r["n_changed"]) for r in found(spark, PAD + item + " " + PAD, item)] == [(7, 0)]
    assert found(spark, PAD + item.replace("Tom", "Sam").replace("5", "8") + " " + PAD, item)
    mixed = item.replace("5", "3").replace("7", "3").replace("9", "3").replace("Ann", "Tom").replace("Eve", "Tom").replace("Joe", "Tom")
    assert not found(spark, PAD + mixed + " " + PAD, item)


def test_items_without_a_template_are_found_as_they_are(spark):
    items = {
        1: "12 + 5 * 7 - 30 / 2 = ? 4 * 9 + 61", 2: "Paris London 4 Madrid Rome 7 Vienna Oslo 9 Berlin", 3: "小明有十二个苹果他每天在市场上卖掉五公斤苹果三天后还剩多少",
        4: "りんごをななつ", 5: "the capital", 6: None, 7: "?!", 8: "ธนาคารแห่งประเทศไทยตั้งอยู่ที่ใด",
    }
    texts = {
        1: PAD + items[1] + " " + PAD, 2: PAD + items[2].lower() + " 3", 3: "问题：请看" + items[3] + "谢谢大家", 4: items[4] + "。", 5: "The capital.", 8: PAD + items[8] + PAD,
        11: PAD + "12 + 5 * 8 - 31 / 2", 12: "Paris London", 13: "小明有苹果", 14: "あかい" + items[4], 15: "what is the capital of france", 16: "", 17: None, 18: "?!",
    }
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in texts.items()], SCHEMA)
    out = contained_items(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in out) == [(k, k) for k in (1, 2, 3, 4, 5, 8)]
    assert all(r["cover"] == 1.0 and r["n_changed"] == 0 for r in out)


def test_a_short_overlap_is_left_alone(spark):
    assert not found(spark, PAD + " ".join(QUESTION.split()[:12]) + " " + PAD)
    assert not found(spark, PAD)


def test_short_items_are_one_window(spark):
    assert found(spark, "what is the capital of france", "What is the capital")
    assert found(spark, PAD + "So what is the capital of spain?", "What is the capital")
    assert not found(spark, "the capital is old", "What is the capital")
    assert not found(spark, "what is the capital of france", "the capital")


def test_decontam_edges(spark):
    df = spark.createDataFrame(awkward_rows(), SCHEMA).withColumn("h", F.lit(1)).withColumn("tags", F.lit(2)).withColumn("item_id", F.lit(3))
    bench = spark.createDataFrame([(1, None), (2, ""), (None, awkward_rows()[0][1]), (3, awkward_rows()[0][1]), (3, awkward_rows()[0][1])], "item_id long, text string")
    out = contained_items(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} >= {(1, 3), (2, 3), (1, None)} and len(out) == len({(r["doc_id"], r["text_hash"], r["item_id"]) for r in out})
    clean = without_contained(df, bench)
    assert clean.columns == df.columns and clean.where("doc_id in (1, 2)").count() == 0 and clean.where("doc_id between 4 and 6").count() == 3
    assert contained_items(df, bench.limit(0)).count() == 0 and without_contained(df, bench.limit(0)).count() == df.count()
    assert contained_items(df.limit(0), bench).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_planted_items_are_found_and_nothing_else(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op7_template_decontam"](spark, sf).collect()}
    norm = lambda t: " " + " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split()) + " "
    docs = [(r["doc_id"], norm(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], norm(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert got == {(d, i) for d, t in docs for i, q in items if q in t}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_pipeline_stages_decide_as_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(corpus_pipeline.shared_table(spark, stage(spark, kept[-1], SF)))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept[-1].columns == columns
    ids = [Counter(r["doc_id"] for r in k.select("doc_id").collect()) for k in kept]
    assert ids[1] <= ids[0] and sum(ids[1].values()) >= 0.97 * sum(ids[0].values())
    sets = word_sets([tuple(r) for r in kept[1].select("doc_id", "text").collect()], 5)
    assert ids[2] == Counter(set(groups(sets, similar(sets, 80)).values()))
    bad = {r["doc_id"] for r in contained_items(kept[2], spark.read.parquet(f"{SF}/benchmark.parquet"), TemplateSpec()).collect()}
    assert bad and ids[3] == Counter({i: n for i, n in ids[2].items() if i not in bad})
    size = {r["doc_id"]: len(WORD.findall(r["text"])) for r in kept[3].collect()}
    assert all(n <= 3 for n in ids[4].values())
    assert 0.9 < sum(size[i] * n for i, n in ids[4].items()) / sum(size.values()) < 1.1
    assert ids[5] == ids[4] and set(columns) < set(kept[5].columns)
    run = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect())
    assert run == ids[5]


def test_corpus_without_labels_passes_the_language_stage(spark):
    docs = spark.createDataFrame([(i, prose(random.Random(i), 80), None, "a", 1) for i in range(20)], SCHEMA)
    with pytest.warns(UserWarning, match="no document has"):
        assert corpus_pipeline.language(spark, docs, "").count() == 20


def test_near_copies_at_five_words_and_four_fifths_go(spark):
    rng = random.Random(12)
    new = lambda n: [prose(rng, 1) + str(rng.randrange(10**6)) for _ in range(n)]
    rows = []
    for i in range(20):
        base = new(200 if i % 2 else 900)
        changed = list(base)
        for k in range(4):
            changed[20 + k * len(base) // 5] += "x"
        rows += [(10 * i + k, " ".join(t), "en", "a", 1) for k, t in enumerate((base, base + new(len(base) * 3 // 20), changed, base + new(len(base) * 3 // 10)))]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(5), "")
    sets = word_sets(rows, 5)
    kept = sorted(set(groups(sets, similar(sets, 80)).values()))
    assert kept == sorted(10 * i + k for i in range(20) for k in (0, 3)) and sorted(r["doc_id"] for r in out.collect()) == kept


def test_every_stage_takes_awkward_rows(spark, tmp_path):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        for docs in (df, df.limit(0), df.where("text is null")):
            out = stage(spark, docs, str(tmp_path))
            assert out.count() <= 3 * docs.count()
            assert set(df.columns) <= set(out.columns), name
    shutil.rmtree(tmp_path, ignore_errors=True)


def test_every_text_is_tokenised_once(spark):
    from geodemand.llm import template_decontam as t

    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine"), (2, ""), (3, None), (4, "?!")], "doc_id long, text string")
    windows = t._windows(t._tokens(docs, "doc_id"), [8], "doc_id")
    assert windows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted((r["doc_id"], r["at"]) for r in windows.collect()) == [(1, 0), (1, 1)]
