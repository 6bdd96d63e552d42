"""Tables and folders of tables to hybrid records with run summaries."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import planning as P
from recordloom.operators import profiling, summarizing
from recordloom.operators.describing import Describer, describe
from recordloom.operators.numbering import batch_id
from recordloom.operators.records import build_records, rename_headers, union_records
from recordloom.sources.delimited import folder_files, list_files, read_folder, read_typed


@dataclass(frozen=True)
class Run:
    """The lazy results of a run: one row per input row, and its summaries."""

    outcomes: DataFrame
    # Files that could not be read, and why.
    unreadable: Mapping[str, str] = field(default_factory=dict)

    @property
    def file_results(self) -> DataFrame:
        return summarizing.file_results(self.outcomes, self.unreadable)

    @property
    def totals(self) -> DataFrame:
        return summarizing.folder_totals(self.file_results)

    @property
    def progress(self) -> DataFrame:
        return summarizing.progress(self.outcomes)


def process_table(
    table: DataFrame,
    batch_size: int = 10,
    describer: Describer | None = None,
    on_error: str = "split",
    header_mapping: Mapping[str, str] | None = None,
    partitions: int | None = None,
    built: bool = False,
) -> DataFrame:
    """Outcome rows of one numbered table, or of records ``built`` from several.

    Without a ``describer`` the statement is the built-in template: expressions
    only, one call booked per batch, nothing can fail.
    """
    if header_mapping:
        table = rename_headers(table, header_mapping)
    records = table if built else build_records(table)
    if describer is not None:
        return describe(records, describer, batch_size, on_error, partitions=partitions)
    position = F.pmod(F.col("row_number") - 1, F.lit(batch_size))
    return records.select(
        "*",
        batch_id(F.col("row_number"), batch_size).alias("batch_id"),
        F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("error_type"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(0).alias("retry_count"),
        F.when(position == 0, 1).otherwise(0).alias("calls"),
    )


def process_tables(
    tables: Mapping[str, DataFrame],
    batch_size: int | Mapping[str, int] = 10,
    describer: Describer | None = None,
    on_error: str = "split",
    unreadable: Mapping[str, str] | None = None,
) -> Run:
    """Several entity tables as one run."""
    size = lambda name: batch_size if isinstance(batch_size, int) else batch_size[name]
    parts = [process_table(t, size(n), describer, on_error) for n, t in tables.items()]
    return Run(union_records(parts), dict(unreadable or {}))


def process_file(spark: SparkSession, path: str, **options) -> Run:
    return Run(process_table(read_typed(spark, path), **options))


def process_folder(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    schemas: Mapping[str, T.StructType] | None = None,
    multi_line: bool | None = None,
    entity_pattern: str | None = None,
    **options,
) -> Run:
    """All files of a folder; one that cannot be read is a failed file of the run, not its end."""
    unreadable: dict[str, str] = {}
    tables = read_folder(spark, folder, pattern, True, schemas, multi_line, unreadable, entity_pattern)
    if not tables:
        raise FileNotFoundError(f"no readable {pattern} in {folder} {unreadable or ''}")
    return process_tables(tables, unreadable=unreadable, **options)


def file_modes(spark: SparkSession, folder: str, pattern: str, rows: DataFrame) -> DataFrame:
    """Mode and batch size for every file of a folder, from its size and its row count.

    ``rows`` has ``source_file, rows``; a file missing there counts as unreadable.
    """
    files = (
        list_files(spark, folder, pattern)
        .groupBy(F.col("file_name").alias("source_file"))
        .agg((F.sum("length") / (1024 * 1024)).alias("size_mb"))
    )
    mode = P.detected_mode(F.lit(False), F.lower("source_file").endswith(".csv"), F.col("rows"), F.col("size_mb"))
    return files.join(rows, "source_file", "left").select(
        "source_file",
        "rows",
        "size_mb",
        mode.alias("mode"),
        P.detected_batch_size(mode, F.col("rows")).alias("batch_size"),
    )


def process_auto(
    spark: SparkSession, folder: str, pattern: str = "*.csv", describer: Describer | None = None, on_error: str = "split"
) -> Run:
    """Process a folder with the mode and batch size chosen per file; simple mode is a batch of one."""
    unreadable: dict[str, str] = {}
    tables = read_folder(spark, folder, pattern, errors=unreadable)
    if not tables:
        raise FileNotFoundError(f"no readable {pattern} in {folder} {unreadable or ''}")
    names = {key: name for key, (name, _) in folder_files(list_files(spark, folder, pattern)).items()}
    counts = spark.createDataFrame([(key, names[key]) for key in tables], "source_type string, source_file string")
    counts = profiling.profiles(tables).join(counts, "source_type").select("source_file", "rows")
    chosen = {r["source_file"]: r for r in file_modes(spark, folder, pattern, counts).collect()}
    sizes = {
        key: 1 if chosen[names[key]]["mode"] == "simple" else chosen[names[key]]["batch_size"] for key in tables
    }
    return process_tables(tables, sizes, describer, on_error, unreadable)


def analyze(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Profile and batch plan per table, and the totals."""
    plan = profiling.batch_plan(profiling.profiles(tables))
    return plan, profiling.plan_totals(plan)
