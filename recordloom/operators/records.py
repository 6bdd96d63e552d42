"""Rows of any table to uniform hybrid records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.functions import records as R
from recordloom.functions import text as X

LINEAGE = ["source_file", "source_type", "source_dir", "row_number"]
LINEAGE_KEPT = ["source_file", "source_type", "row_number"]


def cell_columns(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in LINEAGE]


def rename_headers(table: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename headers to roles, keeping unmapped ones; two headers may not meet in one name."""
    renamed = [mapping.get(c, c) for c in table.columns]
    doubled = sorted({c for c in renamed if renamed.count(c) > 1})
    if doubled:
        raise ValueError(f"headers collide after mapping: {doubled}")
    return table.withColumnsRenamed({k: v for k, v in mapping.items() if k in table.columns})


def build_records(
    table: DataFrame,
    columns: Sequence[str] | None = None,
    skip: str = "null",
    integral: bool = False,
) -> DataFrame:
    """Hybrid records with the template statement: pure expressions, no shuffle.

    ``skip`` is the rule of the structured text; ``integral`` drops the ``.0`` of
    whole doubles.
    """
    columns = list(columns) if columns is not None else cell_columns(table)
    fields = X.field_texts(table, columns)
    if integral:
        doubles = {f.name for f in table.schema.fields if f.dataType.typeName() == "double"}
        fields = {n: X.integral_text(n) if n in doubles else t for n, t in fields.items()}
    # Cell texts are named first so that the three texts built on them do not repeat their expressions.
    names = {n: f"_cell_{i}" for i, n in enumerate(fields)}
    cells = table.select(*LINEAGE_KEPT, *[F.expr(t).alias(names[n]) for n, t in fields.items()])
    texts = {n: X.column_sql(c) for n, c in names.items()}
    built = cells.select(
        *LINEAGE_KEPT,
        X.json_map(texts).alias("json_data"),
        X.template_statement(texts).alias("semantic_statement"),
        X.structured_text(texts, skip).alias("_structured"),
    )
    return built.select(
        *LINEAGE_KEPT,
        "json_data",
        "semantic_statement",
        X.combined_text(F.col("semantic_statement"), F.col("_structured")).alias("combined_text"),
    )


def union_records(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union of record tables."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_metadata(records: DataFrame) -> DataFrame:
    """The searchable metadata of each record: id, type, lineage and criticality."""
    data = F.col("json_data")
    extra = [c for c in ("source_dir",) if c in records.columns]
    return records.select(
        R.record_id(data, R.row_label(F.col("row_number"))).alias("id"),
        F.col("source_type").alias("type"),
        "source_file",
        *extra,
        "row_number",
        R.map_default(data, "Criticality").alias("criticality"),
        "json_data",
        "semantic_statement",
    )


def with_ordinal(records: DataFrame, result: str = "ordinal") -> DataFrame:
    """0-based position in the union of all files, files taken in name order.

    Needs one row per file: the running count of the earlier files is added to
    the row number. These few rows go to every task, so the records stay where they
    are, however many of them one file holds.
    """
    sizes = records.groupBy("source_file").agg(F.max("row_number").alias("_rows"))
    # One row per file, so the single ordered pass is over the file list only.
    earlier = W.orderBy("source_file").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("source_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    return (
        records.join(F.broadcast(starts), "source_file")
        .withColumn(result, F.col("_start") + F.col("row_number") - 1)
        .drop("_start")
    )


def remaining(records: DataFrame, done: DataFrame, keys: Sequence[str] = ("source_file", "row_number")) -> DataFrame:
    """Rows not handled by an earlier run."""
    return records.join(done.select(*keys).distinct(), list(keys), "left_anti")


def resumed(records: DataFrame, last_row: int, prior: DataFrame) -> DataFrame:
    """Earlier results followed by the rows after ``last_row``."""
    return prior.unionByName(records.filter(F.col("row_number") > last_row))
