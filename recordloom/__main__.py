"""Command line: ``spark-submit`` this module or run ``python -m recordloom <command>``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recordloom.constants import DEFAULT_ALPHA, DEFAULT_K
from recordloom.operators.describing import POLICIES
from recordloom.operators.embedding import hashing_encoder
from recordloom.plans import job, processing, search_index
from recordloom.sinks import vectors
from recordloom.sources.delimited import read_folder

ENCODERS = hashing_encoder(256, "semantic"), hashing_encoder(128, "structured")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="recordloom", description="Folders of tables to searchable hybrid records.")
    commands = top.add_subparsers(dest="command", required=True)

    process = commands.add_parser("process", help="records, failed rows and a summary of a file or folder; resumes an earlier run")
    process.add_argument("source")
    process.add_argument("output")
    process.add_argument("--mode", choices=job.MODES, default="auto")
    process.add_argument("--output-mode", choices=job.OUTPUT_MODES, default="separate")
    process.add_argument("--batch-size", type=int)
    process.add_argument("--pattern", default="*.csv")
    process.add_argument("--on-error", choices=POLICIES, default="split")
    process.add_argument("--rows-per-commit", type=int)
    process.add_argument("--keep-failed", action="store_true", help="do not try failed rows again")

    analyze = commands.add_parser("analyze", help="profile, batch plan and suggested mode of every file of a folder")
    analyze.add_argument("source")

    index = commands.add_parser("index", help="vectors and metadata of the records of an output folder")
    index.add_argument("output")
    index.add_argument("index")

    search = commands.add_parser("search", help="hybrid search in a stored index")
    search.add_argument("index")
    search.add_argument("text", nargs="+")
    search.add_argument("--alpha", type=float, default=DEFAULT_ALPHA)
    search.add_argument("-k", type=int, default=DEFAULT_K)
    search.add_argument("--fusion", choices=("rank", "id"), default="rank")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("recordloom").getOrCreate()
    if given.command == "process":
        done = job.process_to(
            spark,
            given.source,
            given.output,
            pattern=given.pattern,
            mode=given.mode,
            batch_size=given.batch_size,
            output_mode=given.output_mode,
            on_error=given.on_error,
            rows_per_commit=given.rows_per_commit,
            retry_failed=not given.keep_failed,
        )
        done.file_results.orderBy("source_file").show(100, truncate=60)
        done.totals.show(truncate=False)
    elif given.command == "analyze":
        plan, totals = processing.analyze(read_folder(spark, given.source))
        plan.orderBy(F.desc("batch_size"), "source_type").show(100, truncate=False)
        totals.show(truncate=False)
        job.suggestion(spark, given.source).orderBy("source_type").show(100, truncate=False)
    elif given.command == "index":
        records = job.read_job(spark, given.output).outcomes.filter(F.col("semantic_statement").isNotNull())
        vectors.write_vectors(search_index.build_index(records, *ENCODERS), given.index)
        vectors.vector_statistics(vectors.read_vectors(spark, given.index)).show()
    else:
        queries = search_index.query_table(spark, [(text, given.alpha) for text in given.text])
        stored = vectors.read_vectors(spark, given.index)
        search_index.search(stored, queries, *ENCODERS, given.k, given.fusion).orderBy("query_id", "rank").show(100, truncate=60)


if __name__ == "__main__":
    main()
