"""The registered queries of the training-data operators, and the DuckDB oracles of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, conversation_repair, fingerprints, html_text, lm_scoring, merkle, packing, quality_classifier, quality_rules,
    sharding, simhash, token_files, toxicity,
)
from .common import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _in_tasks(query: Query) -> Query:
    """A query whose tasks run Python of this package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    "op1_toxicity": _in_tasks(toxicity.query),
    "op2_token_files": _in_tasks(token_files.query),
    "op3_quality_classifier": _in_tasks(quality_classifier.query),
    "op4_lm_scoring": _in_tasks(lm_scoring.query),
    "op5_best_fit_packing": _in_tasks(packing.query),
    "op6_quality_rules": quality_rules.query,
    "op7_simhash_near_dedup": _in_tasks(simhash.query),
    "op8_sharding": sharding.query,
    "op9_bpe_codec": _in_tasks(bpe.query),
    "op10_document_fingerprints": fingerprints.query,
    "op11_html_text": _in_tasks(html_text.query),
    "op12_merkle_manifest": _in_tasks(merkle.query),
    "op13_conversation_repair": _in_tasks(conversation_repair.query),
}

ORACLE = {
    "op6_quality_rules": quality_rules.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
