"""Queries of this package: ``opN_<name>`` and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from fleetlens.llm import bpe, decontaminate, fingerprints, hard_negatives, html_extract, line_dedup, ngram_join, quality, sharding, source_audit, suffix_dedup, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_ngram_jaccard": ngram_join.op1_ngram_jaccard,
        "op2_sharding": sharding.op2_sharding,
        "op3_quality": quality.op3_quality,
        "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_bpe": bpe.op6_bpe,
        "op7_url_filter": url_filter.op7_url_filter,
        "op8_line_dedup": line_dedup.op8_line_dedup,
        "op9_html": html_extract.op9_html,
        "op10_decontaminate": decontaminate.op10_decontaminate,
        "op11_source_audit": source_audit.op11_source_audit,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_fingerprint": fingerprints.op13_fingerprint,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_sharding": sharding.SQL, "op11_source_audit": source_audit.SQL, "op12_hard_negatives": hard_negatives.SQL}
