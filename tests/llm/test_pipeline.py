"""The corpus pipeline on the smallest tables and on awkward rows."""

from __future__ import annotations

import inspect

import corpus_pipeline
from fleetlens.llm import registry
from tests.conftest import SF_SMALL
from tests.llm.data import SCHEMA, documents


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    source = {r.doc_id: r.text for r in docs.collect()}
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        out = corpus_pipeline.written(stage(spark, docs, SF_SMALL), name)
        assert out.columns == docs.columns
        counts.append(out.count())
        docs = out
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert counts == sorted(counts, reverse=True) and 0 < len(kept) == counts[-1]
    assert kept.keys() <= source.keys()
    for doc_id, text in kept.items():
        lines = iter(source[doc_id].split("\n"))
        assert all(any(x == line for x in lines) for line in text.split("\n"))     # what is left is a subsequence
        assert not any(item in text for item in items)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert set(docs.columns) < set(last.columns) and last.count() == len(kept)
    assert not any(r.decoded == "" for r in last.where("text <> ''").collect())


def test_stages_survive_awkward_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = corpus_pipeline.written(stage(spark, docs, SF_SMALL), "awkward")
        assert docs.count() > 0
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_one_query_per_operator():
    names = set(registry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}
