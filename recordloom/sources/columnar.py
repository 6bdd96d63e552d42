"""Parquet tables as numbered entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.functions.records import logical_file_of


def read_table(spark: SparkSession, path: str, source_type: str, numbered: bool = True) -> DataFrame:
    """A Parquet table with ``source_file``, ``source_type`` and ``row_number``.

    The row number is the reader's own row index, so it costs no shuffle and no second
    pass, however large the file. The parts of a table written as a folder
    ``<name>.parquet`` carry its name and count on in name order; only the numbers of their
    rows are looked up for that, which the files' footers tell.
    """
    table = spark.read.parquet(path)
    parts = F.col("_metadata.file_path")
    lineage = [logical_file_of(parts, ".parquet").alias("source_file"), F.lit(source_type).alias("source_type")]
    if not numbered:
        return table.select("*", *lineage)
    index = F.col("_metadata.row_index") + 1
    if len(table.inputFiles()) == 1:
        return table.select("*", *lineage, index.alias("row_number"))
    sizes = table.groupBy(parts.alias("_path")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per part, so the single ordered pass is over the list of parts only.
    earlier = W.partitionBy("source_file").orderBy("_path").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("source_file", logical_file_of(F.col("_path"), ".parquet")).select(
        "_path", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    placed = table.select("*", *lineage, index.alias("_index"), parts.alias("_path")).join(F.broadcast(starts), "_path")
    return placed.withColumn("row_number", F.col("_start") + F.col("_index")).drop("_path", "_start", "_index")
