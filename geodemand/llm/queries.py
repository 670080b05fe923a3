"""Queries over the driver tables: one per operator, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import fold
from .divergence import BASE, judge_quality, language_references
from .html_blocks import extract_main_text, train_labeller
from .langid import identify_language, train_dictionaries
from .ngram_join import ngram_groups
from .lattice_lm import lm_scores
from .lexical_search import ranked_search
from .line_dedup import line_classes
from .mixing import mix_documents
from .periodic_runs import periodic_runs, planted, run_digest
from .shards import shard_documents
from .template_decontam import contained_items
from .toxicity import score_toxicity
from .toxicity import train as train_toxicity
from .vector_search import nearest_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op4_shards")
def op4_shards(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return shard_documents(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@register("op5_mixing")
def op5_mixing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return mix_documents(docs).select("doc_id", "size", "source_size", "target", "taken")


@register("op6_langid")
def op6_langid(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    held = docs.withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    known = train_dictionaries(held.where(~F.col("held_out")))
    return identify_language(held.drop("lang"), known).drop("text")


@register("op10_toxicity")
def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held = docs.withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    model = train_toxicity(held.where(~F.col("held_out")).join(labels, "doc_id"), F.col("toxic"))
    return score_toxicity(held, model).drop("text")


@register("op9_quality", oracles.quality())
def op9_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    judged = judge_quality(docs, language_references(docs))
    return judged.select("doc_id", *BASE, "base_failed", "kept")


@register("op8_ngram_join", oracles.NGRAM_JOIN)
def op8_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_groups(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


@register("op2_lattice_lm")
def op2_lattice_lm(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text").withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    return lm_scores(docs, ~F.col("held_out"))


@register("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_classes(table(spark, d, "documents").select("doc_id", "text"))


@register("op7_template_decontam", oracles.template_decontam())
def op7_template_decontam(spark: SparkSession, d: str) -> DataFrame:
    return contained_items(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark")).drop("text_hash")


@register("op3_html_text")
def op3_html_text(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    return extract_main_text(pages, train_labeller(pages)).drop("html")


@register("op13_lexical_search", oracles.LEXICAL_SEARCH)
def op13_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked_search(table(spark, d, "documents"), table(spark, d, "benchmark"))


@register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return run_digest(periodic_runs(docs.withColumn("text", planted(F.col("text"), F.col("doc_id")))))


@register("op11_tree_neighbours")
def op11_tree_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return nearest_vectors(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)
