"""Corpus pipeline: toxicity, line dedup, near duplicates, benchmark decontamination, BPE.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of ``documents`` (the last adds the encoding).  ``run``
writes every stage's result as Parquet under the shared checkpoint folder and
rereads it, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.bpe import bpe_encode, default_vocabulary
from fleetlens.llm.common import read, written
from fleetlens.llm.decontaminate import decontaminate
from fleetlens.llm.line_dedup import dedup_lines
from fleetlens.llm.ngram_join import drop_near_duplicates
from fleetlens.llm.toxicity import toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents scored 0.5 or more; empty and null texts stay."""
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity(docs, labels).where("predicted = 0").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated lines; a document that has nothing left because of it goes."""
    emptied = (F.col("n_removed") > 0) & (F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")) == "")
    return dedup_lines(docs).where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at similarity 0.8 or more."""
    return drop_near_duplicates(docs, n=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_encode(docs, default_vocabulary())


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: SQL can express none of the decoder, the tokenizer's merges or the components: tests/llm hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
