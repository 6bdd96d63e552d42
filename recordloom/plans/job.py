"""A resumable run over a file or a folder: what is done stays done, outputs follow from it.

``<output>/outcomes/run=<n>`` is the ledger: the outcome of every row that run *n* dealt
with. A run takes only rows that no earlier run has settled, so a run that was stopped,
suspended by its describer or killed goes on where its ledger ends; a part that was not
committed does not count and is written anew. Rows that failed are tried again unless told
otherwise. Records, failed rows and the summary are written from the latest outcome of each
row.
"""

from __future__ import annotations

import math
import re
import time
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import planning as P
from recordloom.operators import profiling, summarizing
from recordloom.operators.describing import Describer
from recordloom.operators.records import build_records, rename_headers, union_records
from recordloom.plans.processing import file_modes, process_table
from recordloom.session import fresh_folder, written
from recordloom.sinks import envelopes as E
from recordloom.sources.delimited import folder_files, list_files, read_files, read_typed

ROW = ["source_file", "row_number"]
CLOCK = "started timestamp, seconds double"
MODES = ("auto", "simple", "optimized", "folder")
OUTPUT_MODES = ("separate", "consolidated")
# Rows of one file or task of a commit, where it has more of them.
FILE_ROWS = 100_000


@dataclass(frozen=True)
class Job:
    """What a run left under its output folder."""

    output: str
    runs: list[int]
    # Every outcome of every run, and the latest one of each row.
    ledger: DataFrame
    outcomes: DataFrame
    # When each run started and the seconds it took; None for one that was killed before it said so.
    clock: DataFrame
    unreadable: Mapping[str, str] = field(default_factory=dict)
    # File name → rows per call.
    sizes: Mapping[str, int] = field(default_factory=dict)

    @property
    def file_results(self) -> DataFrame:
        """The results per file, with the calls of all runs and the mode the file was last processed in."""
        results = summarizing.file_results(self.outcomes, self.unreadable)
        calls = self.ledger.groupBy("source_file").agg(F.sum("calls").alias("_calls"))
        results = results.join(calls, "source_file", "left").withColumn("calls", F.coalesce("_calls", "calls")).drop("_calls")
        # As many rows as there are files.
        sizes = self.outcomes.sparkSession.createDataFrame(list(self.sizes.items()), "source_file string, batch_size int")
        mode = F.when(F.col("batch_size") == 1, "simple").when(F.col("batch_size") > 1, "optimized")
        return results.join(sizes, "source_file", "left").withColumn("mode", mode)

    @property
    def run_results(self) -> DataFrame:
        """For each run: rows it dealt with, calls, seconds, rows per second and per call."""
        dealt = self.ledger.groupBy("run").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("status").isin(summarizing.PROCESSED)).alias("processed_rows"),
            F.sum("calls").alias("calls"),
        )
        return self.clock.join(dealt, "run", "left").select(
            "run",
            "started",
            "seconds",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "processed_rows", "calls")],
            summarizing.rows_per_second(F.coalesce("processed_rows", F.lit(0)), F.col("seconds")).alias("rows_per_second"),
            P.ratio(F.coalesce("processed_rows", F.lit(0)), F.col("calls")).alias("rows_per_call"),
        )

    @property
    def totals(self) -> DataFrame:
        """The totals over all files, with the seconds of all runs."""
        seconds = self.clock.agg(F.coalesce(F.sum("seconds"), F.lit(0.0))).first()[0]
        totals = summarizing.folder_totals(self.file_results).withColumn("seconds", F.lit(seconds))
        return totals.withColumn("rows_per_second", summarizing.rows_per_second(F.col("processed_rows"), F.col("seconds")))


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_folder(spark: SparkSession, source: str) -> bool:
    """True for a folder of files; a table that Spark wrote as ``<name>.csv/`` is a file."""
    path, files = _files(spark, source)
    return files.getFileStatus(path).isDirectory() and not source.rstrip("/").endswith(".csv")


def committed_runs(spark: SparkSession, output: str) -> list[int]:
    """The runs whose write was committed; what a killed run left is passed over."""
    path, files = _files(spark, f"{output}/outcomes")
    if not files.exists(path):
        return []
    found = [(re.fullmatch(r"run=(\d+)", f.getPath().getName()), f.getPath()) for f in files.listStatus(path)]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(m[1]) for m, p in found if m and files.exists(marker(p, "_SUCCESS")))


def ledger(spark: SparkSession, output: str) -> DataFrame | None:
    """All outcomes of committed runs with their ``run``; None before the first one."""
    runs = committed_runs(spark, output)
    if not runs:
        return None
    folders = [f"{output}/outcomes/run={n}" for n in runs]
    return spark.read.option("basePath", f"{output}/outcomes").parquet(*folders)


def settled(outcomes: DataFrame, retry_failed: bool = True) -> DataFrame:
    """The outcomes that a later run leaves as they are."""
    final = summarizing.PROCESSED if retry_failed else [*summarizing.PROCESSED, "failed"]
    return outcomes.filter(F.col("status").isin(final))


def latest(outcomes: DataFrame) -> DataFrame:
    """The last outcome of each row.

    A processed row is never tried again, so only the others, few as a rule, are ranked
    and compared with later runs.
    """
    done = outcomes.filter(F.col("status").isin(summarizing.PROCESSED))
    newest = W.partitionBy(*ROW).orderBy(F.desc("run"))
    rest = outcomes.filter(~F.col("status").isin(summarizing.PROCESSED))
    rest = rest.withColumn("_newest", F.row_number().over(newest)).filter("_newest = 1").drop("_newest")
    return done.unionByName(rest.join(done.select(*ROW), ROW, "left_anti").select(*done.columns))


def _tables(spark, source, pattern, schemas, multi_line, unreadable) -> tuple[dict[str, DataFrame], dict[str, str], str]:
    """Table and file name per entity, and the folder they are in."""
    if is_folder(spark, source):
        files = folder_files(list_files(spark, source, pattern))
        tables = read_files(spark, files, True, schemas, multi_line, unreadable)
        return tables, {key: files[key][0] for key in tables}, source
    name = source.rstrip("/").rsplit("/", 1)[-1]
    key = name.rsplit(".", 1)[0]
    schema = (schemas or {}).get(key)
    return {key: read_typed(spark, source, schema, multi_line)}, {key: name}, source.rstrip("/").rsplit("/", 1)[0]


def batch_sizes(
    spark: SparkSession, tables: Mapping[str, DataFrame], names: Mapping[str, str], folder: str, mode: str, batch_size: int | None
) -> dict[str, int]:
    """Rows per call for every table: one in simple mode, by rows and file size in auto mode."""
    if mode == "simple":
        return dict.fromkeys(tables, 1)
    if mode != "auto":
        return dict.fromkeys(tables, batch_size or P.DEFAULT_BATCH)
    listed = spark.createDataFrame(list(names.items()), "source_type string, source_file string")
    counts = profiling.profiles(tables).join(listed, "source_type").select("source_file", "rows")
    chosen = {r["source_file"]: r for r in file_modes(spark, folder, "*", counts).collect()}
    return {
        key: 1 if chosen[name]["mode"] == "simple" else batch_size or chosen[name]["batch_size"] for key, name in names.items()
    }


def suggestion(spark: SparkSession, source: str, pattern: str = "*.csv") -> DataFrame:
    """``source_type, rows, suggestion`` for a file or every file of a folder."""
    tables, _, _ = _tables(spark, source, pattern, None, None, {})
    return profiling.profiles(tables).select("source_type", "rows", P.suggested_mode(F.col("rows")).alias("suggestion"))


def process_to(
    spark: SparkSession,
    source: str,
    output: str,
    *,
    pattern: str = "*.csv",
    mode: str = "auto",
    batch_size: int | None = None,
    output_mode: str = "separate",
    describer: Describer | None = None,
    on_error: str = "split",
    header_mapping: Mapping[str, str] | None = None,
    schemas: Mapping[str, T.StructType] | None = None,
    multi_line: bool | None = None,
    rows_per_commit: int | None = None,
    retry_failed: bool = True,
) -> Job:
    """Process what is new under ``source`` and write records, failed rows and a summary.

    ``mode``: ``simple`` (one row per call), ``optimized`` (``batch_size`` rows), ``auto``
    (chosen per file) or ``folder`` (as optimized). ``rows_per_commit`` commits the ledger
    after so many rows of each file, which bounds what a killed run loses; the files are
    read once and kept by commit until the session ends. ``output_mode``: ``separate`` envelopes per source, or one
    ``consolidated`` table of records with their source.
    """
    if mode not in MODES or output_mode not in OUTPUT_MODES:
        raise ValueError(f"unknown mode {mode!r} or output mode {output_mode!r}")
    unreadable: dict[str, str] = {}
    tables, names, parent = _tables(spark, source, pattern, schemas, multi_line, unreadable)
    if not tables:
        raise FileNotFoundError(f"no readable {pattern} in {source} {unreadable or ''}")
    sizes = batch_sizes(spark, tables, names, parent, mode, batch_size)
    if header_mapping:
        tables = {key: rename_headers(t, header_mapping) for key, t in tables.items()}
    # The stretches of one call do not overlap, so only what earlier calls did has to be left out.
    earlier = ledger(spark, output)
    by_commit = _by_commit(tables, rows_per_commit, describer) if rows_per_commit else None
    lengths = dict.fromkeys(tables, 0) | _lengths(by_commit) if rows_per_commit else {}
    stopped: set[str] = set()
    number = max(committed_runs(spark, output), default=-1)
    for first, last in _stretches(lengths, rows_per_commit):
        active = [key for key in tables if names[key] not in stopped and first <= max(1, lengths.get(key, 1))]
        if last is None:
            parts = [process_table(_open(tables[key], earlier, retry_failed), sizes[key], describer, on_error) for key in active]
        else:
            rows = by_commit.filter(F.col("_commit") == (first - 1) // rows_per_commit).drop("_commit")
            rows, tasks = _open(rows, earlier, retry_failed), _tasks(spark, len(active) * rows_per_commit)
            parts = []
            # Files of one size go through the describer together.
            for size in sorted({sizes[key] for key in active}):
                alike = rows.filter(F.col("_key").isin([key for key in active if sizes[key] == size])).drop("_key")
                parts.append(process_table(alike, size, describer, on_error, None, tasks, True))
        if not parts:
            break
        number, started, clock = number + 1, datetime.now(UTC), time.monotonic()
        folder = f"{output}/outcomes/run={number}"
        outcomes = union_records(parts)
        outcomes.write.mode("overwrite").parquet(folder)
        took = F.lit(started).alias("started"), F.lit(time.monotonic() - clock).alias("seconds")
        spark.range(0, 1, 1, 1).select(*took).write.mode("overwrite").parquet(f"{output}/clock/run={number}")
        if on_error == "stop" and last is not None:
            # A batch of each file at most, as those after it are pending; later rows wait for the next call.
            failed = spark.read.schema(outcomes.schema).parquet(folder).filter(F.col("status") == "failed")
            stopped |= {r["source_file"] for r in failed.select("source_file").collect()}
    job = read_job(spark, output, unreadable, {names[key]: size for key, size in sizes.items()})
    write_outputs(job, output_mode)
    return job


def _open(rows: DataFrame, earlier: DataFrame | None, retry_failed: bool) -> DataFrame:
    """The rows that no earlier call has settled."""
    if earlier is None:
        return rows
    # The rows on the left: a hot file's rows are split, and a short ledger is sent whole.
    return rows.join(settled(earlier, retry_failed).select(*ROW), ROW, "left_anti").select(*rows.columns)


def _by_commit(tables: Mapping[str, DataFrame], rows_per_commit: int, describer: Describer | None) -> DataFrame:
    """The records of all ``tables`` with their ``_key``, stored by the commit that they are part of.

    A commit reads its own rows only, and plans one scan.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = fresh_folder(spark, "commits")
    records = union_records([build_records(t).withColumn("_key", F.lit(key)) for key, t in tables.items()])
    if describer is not None:
        # Made anew from what the describer says.
        records = records.withColumns(dict.fromkeys(("semantic_statement", "combined_text"), F.lit(None).cast("string")))
    at = F.col("row_number") - 1
    placed = records.withColumn("_commit", F.floor(at / rows_per_commit))
    # A commit of few rows is in one file, and one of many rows in several.
    dealt = placed.repartition("_commit", F.floor(at / FILE_ROWS))
    dealt.write.partitionBy("_commit").parquet(folder)
    return spark.read.schema(placed.schema).parquet(folder)


def _tasks(spark: SparkSession, rows: int) -> int:
    """Tasks for a commit of so many rows: all cores, and more if there are many rows."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(spark.sparkContext.defaultParallelism, math.ceil(rows / FILE_ROWS)))


def _lengths(by_commit: DataFrame) -> dict[str, int]:
    """The last row number of every table that has rows, a number per file."""
    return {r["_key"]: r["n"] for r in by_commit.groupBy("_key").agg(F.max("row_number").alias("n")).collect()}


def _stretches(lengths: Mapping[str, int], rows_per_commit: int | None) -> list[tuple[int, int | None]]:
    """Ranges of row numbers that are committed one after the other."""
    if rows_per_commit is None:
        return [(1, None)]
    most = max(1, *lengths.values())
    return [(at + 1, at + rows_per_commit) for at in range(0, most, rows_per_commit)]


def read_job(
    spark: SparkSession, output: str, unreadable: Mapping[str, str] | None = None, sizes: Mapping[str, int] | None = None
) -> Job:
    """The state of an output folder: its committed runs and the latest outcome of every row."""
    outcomes, runs = ledger(spark, output), committed_runs(spark, output)
    if outcomes is None:
        raise FileNotFoundError(f"no committed run in {output}")
    numbers = spark.createDataFrame([(n,) for n in runs], "run int")
    path, files = _files(spark, f"{output}/clock")
    clock = spark.createDataFrame([], f"{CLOCK}, run int")
    if files.exists(path):
        clock = spark.read.schema(f"{CLOCK}, run int").parquet(f"{output}/clock")
    return Job(output, runs, outcomes, latest(outcomes), numbers.join(clock, "run", "left"), dict(unreadable or {}), dict(sizes or {}))


def write_outputs(job: Job, output_mode: str = "separate") -> None:
    """Records, failed rows, results per run and the summary of the latest outcomes, in place of earlier ones."""
    # Every output is made from the latest outcomes: they are found once and stored.
    job = replace(job, outcomes=written(job.outcomes, "outcomes"))
    done = job.outcomes.filter(F.col("status").isin(summarizing.PROCESSED))
    lost = job.outcomes.filter(F.col("status") == "failed")
    if output_mode == "separate":
        size = F.create_map(*[F.lit(x) for pair in job.sizes.items() for x in pair])[F.col("source_file")]
        E.write_envelopes(E.envelopes(job.outcomes, size, stored=True), f"{job.output}/processed", "overwrite")
    else:
        fields = [*ROW, "source_type", "json_data", "semantic_statement", "combined_text"]
        E.write_consolidated(done.select(*fields), f"{job.output}/consolidated", "overwrite")
    failed = lost.select(*ROW, "error_type", "error_message", "retry_count", F.col("json_data").alias("row_data"))
    E.write_json(failed, f"{job.output}/failed", "overwrite")
    E.write_json(job.run_results, f"{job.output}/summary/runs", "overwrite")
    E.write_summary(job.file_results, job.totals, f"{job.output}/summary", "overwrite")
