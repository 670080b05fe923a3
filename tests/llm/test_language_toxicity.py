import os
import random

import numpy as np
import pytest
from helpers import SCHEMA, SF, awkward_rows, prose

from geodemand.llm import queries, toxicity
from geodemand.llm.langid import LangSpec, identify_language, train_dictionaries
from geodemand.llm.toxicity import FMSpec, score_toxicity
from pyspark.sql import functions as F

tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@tables
def test_held_out_language_accuracy(spark):
    got = queries.QUERIES["op6_langid"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    held = got.where("held_out").join(truth, "doc_id")
    right, n = held.agg(F.sum((F.col("lang_pred") == F.col("truth")).cast("int")), F.count(F.lit(1))).first()
    assert got.count() == truth.count() and n > 150
    assert right / n >= 0.97
    assert got.where("score < 0 or score > 1 or score is null").count() == 0
    assert got.where("rejected").count() <= 0.02 * got.count()


def test_language_edge_rows(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("rejected", F.lit(3))
    known = train_dictionaries(df, LangSpec(sample_docs=5, dict_bytes=2000))
    assert set(known) == {"en", "fr"}
    out = identify_language(df, known).collect()
    assert len(out) == len(rows)
    for r in out:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in known and 0 <= r["score"] <= 1
    numbers = spark.createDataFrame([(t,) for t in ("½", "²³", "①②", "Ⅷ", "12 ¾!", "_", "ª", "é")], "text string")
    assert [r["lang_pred"] == "und" for r in identify_language(numbers, known).collect()] == [True] * 6 + [False] * 2
    assert identify_language(df, {}).where("lang_pred <> 'und' or not rejected").count() == 0
    assert identify_language(df.limit(0), known).count() == 0
    assert train_dictionaries(df.limit(0)) == {}


def auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    pos = labels == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_pairs_that_no_linear_model_learns():
    """Label: both or neither of two terms. Each term alone says nothing."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        noise = rng.choice(np.arange(50, 90), 4, replace=False)
        rows.append(np.unique(np.concatenate([[10 + a, 20 + b], noise])).astype(np.int64))
        labels.append(float(a == b))
    labels = np.array(labels)
    spec = FMSpec(dims=128, rank=4, epochs=60, rate=0.3, min_z=0)  # either term alone has no share of its own
    model = toxicity.fit(rows[:1000], labels[:1000], spec)
    scores = np.array([model.score(r) for r in rows[1000:]])
    assert auc(scores, labels[1000:]) > 0.95
    alone = toxicity.FMModel(model.bias, model.weights, np.zeros_like(model.vectors))
    assert auc(np.array([alone.score(r) for r in rows[1000:]]), labels[1000:]) < 0.7


def insult_texts(rng, n):
    """Insults among themselves and groups among themselves are harmless; one with the other is not."""
    insults, group_words = "idiot moron trash scum loser clown".split(), "redfolk bluefolk greenfolk hillmen seamen plainsmen".split()
    vocabulary = [prose(rng, 1) for _ in range(1500)]
    out = []
    for _ in range(n):
        kind = rng.randrange(4)
        held = [rng.sample(insults, rng.randint(1, 4)), rng.sample(group_words, rng.randint(1, 4)), rng.sample(insults, 1 + rng.randrange(2)) + rng.sample(group_words, 1 + rng.randrange(2)), []][kind]
        w = rng.choices(vocabulary, k=rng.randint(30, 120)) + held
        rng.shuffle(w)
        out.append((" ".join(w), int(kind == 2)))
    return out


def margins(model, rows, spec=FMSpec()):
    terms = toxicity._Terms(spec)
    return np.array([model.margin(toxicity.features(t, terms)) for t, _ in rows])


def test_production_pairs_learn_insult_with_group(spark):
    rows = insult_texts(random.Random(5), 6000)
    train, held = rows[:4000], rows[4000:]
    model = toxicity.train(spark.createDataFrame(train, "text string, toxic int"), F.col("toxic"))
    truth = np.array([y for _, y in held])
    whole = auc(margins(model, held), truth)
    linear = auc(margins(toxicity.FMModel(model.bias, model.weights, np.zeros_like(model.vectors)), held), truth)
    # a linear model fitted by itself does not do it either
    terms = toxicity._Terms(FMSpec())
    alone = toxicity.fit([toxicity.features(t, terms) for t, _ in train], np.array([float(y) for _, y in train]), FMSpec(spread=0.0, pair_rate=0.0))
    assert whole > 0.9 and whole > linear + 0.2 and whole > auc(margins(alone, held), truth) + 0.1


def test_copies_do_not_swell_the_sample(spark):
    rows = insult_texts(random.Random(6), 600)
    once = toxicity.train(spark.createDataFrame(rows, "text string, toxic int"), F.col("toxic"))
    copies = spark.createDataFrame(rows + [rows[0]] * 3000 + [(None, 0), ("", 0)] * 400, "text string, toxic int").repartition(5)
    again = toxicity.train(copies.where("text <> ''"), F.col("toxic"))
    assert again.bias == once.bias and (again.weights == once.weights).all() and (again.vectors == once.vectors).all()
    with_empty = toxicity.train(copies, F.col("toxic"), FMSpec(epochs=1))
    assert np.isfinite(with_empty.bias)


@tables
def test_toxicity_pairs_matter_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").join(labels, "doc_id").withColumn("held_out", queries.fold(F.col("doc_id"), 4) == 2)
    model = toxicity.train(docs.where("not held_out"), F.col("toxic"))
    rows = [(r["text"], r["toxic"]) for r in docs.where("held_out").collect()]
    truth = np.array([y for _, y in rows])
    alone = toxicity.FMModel(model.bias, model.weights, np.zeros_like(model.vectors))
    assert auc(margins(model, rows), truth) > 0.97 and auc(margins(model, rows), truth) > auc(margins(alone, rows), truth) + 0.01


@tables
def test_toxicity_separates_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op10_toxicity"](spark, sf)
    rows = got.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("score", "predicted", "toxic").toPandas()
    assert auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.97
    assert (rows.predicted == (rows.score >= 0.3)).all()
    flagged = rows[rows.predicted == 1]
    assert (flagged.toxic == 1).mean() > 0.9


def test_toxicity_edge_rows(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("predicted", F.lit("y"))
    labelled = df.withColumn("toxic", F.when(F.col("doc_id") < 5, 1).when(F.col("doc_id") < 110, 0))
    spec = FMSpec(dims=256, epochs=2, min_docs=1)
    model = toxicity.train(labelled, F.col("toxic"), spec)
    out = score_toxicity(df, model, spec).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if not r["text"]}) == 1
    assert score_toxicity(df.limit(0), model, spec).count() == 0
    empty = toxicity.train(labelled.limit(0), F.col("toxic"), spec)
    assert score_toxicity(df, empty, spec).count() == len(rows)
