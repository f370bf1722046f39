"""Corpus pipeline: documents to training sequences, in four stages.

Each stage is one of the operators in ``shopsignal.llm``.  It works on every
row its predecessor kept, and its decisions take effect: rejected documents go,
one document of every near-duplicate class stays, and the last stage packs what
is left.  All stages but the last return the columns of ``documents``.  Stages
hand over written tables, so an executor lost in one stage never costs the work
of those before it.

Columns beside doc_id and text only pass through (whatever they are called),
nulls included; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopsignal.llm import packing, quality_classifier, quality_rules, simhash
from shopsignal.llm.common import ship_package, written
from shopsignal.llm.tokens import vocabulary
from shopsignal.session import delete_scratch, scratch_scope

END_ID = 0  # appended to every document that is packed


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def apply_quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows of the whole corpus: the rules before it leave hardly a bad one to learn from."""
    ship_package(spark)
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_classifier.keep_good(docs, quality_classifier.train(corpus, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(packing.pieces(docs, vocabulary("byte_bpe_50k.json"), END_ID))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", apply_quality_rules),
    ("quality_classifier", apply_quality_classifier),
    ("simhash_near_dedup", drop_near_duplicates),
    ("best_fit_packing", pack_sequences),
]

# A compression classifier and a tokenizer can't be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read again as the next one's input.

    Once a stage's result is written, what it read and its own intermediate
    tables are deleted, so at most two copies of the corpus exist at a time.
    """
    ship_package(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with scratch_scope() as drawn:
            docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
        delete_scratch(spark, [*before, *drawn[:-1]])
        before = drawn[-1:]
    return docs
