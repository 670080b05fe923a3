"""The corpus pipeline: each stage applies one text operator to all that the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes each result as Parquet in the shared checkpoint folder and reads it
back as the next stage's documents. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geodemand.llm.common import fold, shared_table
from geodemand.llm.langid import identify_language, train_dictionaries
from geodemand.llm.mixing import mix_documents, mixed_copies
from geodemand.llm.ngram_join import JaccardSpec, ngram_groups, one_per_group
from geodemand.llm.shards import shard_documents
from geodemand.llm.template_decontam import without_contained

#: Small classes: at 0.8 the prefixes are twice as long as at 0.9, and so many more pairs would be written.
NEAR = JaccardSpec(n=5, percent=80, class_bits=2)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6, learning from this stage's own labelled documents; those it rejects go, null, empty and letterless texts among them.

    Without a labelled text there is nothing to learn from: all documents stay, with a warning.
    """
    known = train_dictionaries(docs.where(fold(F.col("doc_id"), 5) != 0))
    if not known:
        warnings.warn("no document has a text and a language: the language stage keeps all documents", stacklevel=2)
        return docs
    return identify_language(docs, known).where("not rejected").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8 at five words and 0.8: the document with the least id of each group stays."""
    return one_per_group(ngram_groups(docs, NEAR), docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that contain a benchmark item go."""
    return without_contained(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: whole documents, as often as the mix takes them; texts without words are never taken and go."""
    return mixed_copies(mix_documents(docs), docs.columns)


def make_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents with shard and slot."""
    return shard_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", make_shards),
]

#: Compression, learned models and unions over links: not expressible in SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = shared_table(spark, docs)
    return docs
