"""Small tables with every odd case, and empty ones, as the registered queries read them."""

from __future__ import annotations

import pytest
from llm_rows import BENCHMARK, CLASHING, LABELS, ODD, SCHEMA
from pyspark.sql import functions as F

def write(spark, folder, rows, labels, benchmark, clashing=True):
    docs = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        docs = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("odd"), ODD, LABELS, BENCHMARK)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [], [], [])
