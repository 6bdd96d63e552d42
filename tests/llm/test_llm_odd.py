"""Nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import pytest
from llm_rows import ODD

import corpus_pipeline
from recordloom.llm.queries import QUERIES

ONE_ROW_EACH = ["op1_", "op4_", "op5_", "op6_", "op7_", "op9_", "op10_", "op12_"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows(spark, odd, name):
    rows = QUERIES[name](spark, odd).collect()
    if any(name.startswith(x) for x in ONE_ROW_EACH):
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(d[0]) for d in ODD)
    else:
        assert rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_pipeline_on_odd_and_empty(spark, odd, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, odd)
        assert out.dtypes == docs.dtypes, name
        assert out.count() > 0
    assert corpus_pipeline.run(spark, odd).count() > 0
