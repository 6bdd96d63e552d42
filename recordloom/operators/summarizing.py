"""Run summaries over row outcomes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions import planning as P
from recordloom.operators.numbering import running_total
from recordloom.operators.skew import lookup_join
from recordloom.session import written

# --- fixed values: statuses that count as processed ---
PROCESSED = ["ok", "fallback", "error_record"]


def is_valid_statement(statement: Column) -> Column:
    return (statement != "") & ~statement.startswith("Error")


def file_results(outcomes: DataFrame, unreadable: Mapping[str, str] | None = None) -> DataFrame:
    """Per file: rows, processed, failed, calls, success and the last error.

    Files of ``unreadable`` (name → message) are failed ones without rows.
    """
    processed = F.col("status").isin(PROCESSED)
    results = outcomes.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(processed).alias("processed_rows"),
        F.count_if(F.col("status") == "failed").alias("failed_rows"),
        F.sum("calls").alias("calls"),
        F.max("error_message").alias("error_message"),
    ).withColumns(
        {
            "success_rate": P.percent(F.col("processed_rows"), F.col("total_rows")),
            "success": F.col("failed_rows") == 0,
        }
    )
    if not unreadable:
        return results
    schema = "source_file string, total_rows bigint, processed_rows bigint, failed_rows bigint, calls bigint, error_message string"
    lost = outcomes.sparkSession.createDataFrame([(f, 0, 0, 0, 0, m) for f, m in unreadable.items()], schema)
    lost = lost.withColumns({"success_rate": F.lit(0.0), "success": F.lit(False)})
    return results.unionByName(lost)


def folder_totals(results: DataFrame) -> DataFrame:
    """Totals of a run over its per-file results."""
    rows, done, calls = F.sum("total_rows"), F.sum("processed_rows"), F.sum("calls")
    return results.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if("success").alias("successful_files"),
        F.count_if(~F.col("success")).alias("failed_files"),
        rows.alias("total_rows"),
        done.alias("processed_rows"),
        calls.alias("total_calls"),
        P.percent(done, rows).alias("success_rate"),
        P.ratio(done, calls).alias("rows_per_call"),
    )


def rows_per_second(rows: Column, seconds: Column) -> Column:
    return F.round(P.ratio(rows, seconds), 1)


def progress(outcomes: DataFrame) -> DataFrame:
    """Cumulative rows processed after each batch and the share of the file they make up.

    The counts per batch are stored: three steps read them, and behind them may be
    an expensive describer.
    """
    batches = outcomes.groupBy("source_file", "batch_id").agg(
        F.count(F.lit(1)).alias("batch_rows"), F.count_if(F.col("status").isin(PROCESSED)).alias("batch_processed")
    )
    batches = written(batches, "batches")
    running = running_total(batches, "batch_processed", "batch_id", ["source_file"], "processed_so_far")
    totals = batches.groupBy("source_file").agg(F.sum("batch_rows").alias("total_rows"))
    return lookup_join(running, totals, ["source_file"], "inner").withColumn(
        "percent", P.percent(F.col("processed_so_far"), F.col("total_rows"))
    )


def type_counts(records: DataFrame, column: str = "type") -> DataFrame:
    """Records per type with the total under ``(all)``."""
    counts = records.groupBy(column).agg(F.count(F.lit(1)).alias("records"))
    total = counts.agg(F.sum("records").alias("records")).select(F.lit("(all)").alias(column), "records")
    return counts.unionByName(total)


def token_totals(texts: DataFrame, semantic: str, structured: str) -> DataFrame:
    """Estimated tokens and cost of both embedding streams."""
    sums = texts.agg(
        F.coalesce(F.sum(P.token_estimate(F.col(semantic))), F.lit(0)).alias("semantic_tokens"),
        F.coalesce(F.sum(P.token_estimate(F.col(structured))), F.lit(0)).alias("structured_tokens"),
    )
    semantic_usd = P.semantic_cost(F.col("semantic_tokens"))
    structured_usd = P.structured_cost(F.col("structured_tokens"))
    return sums.select(
        "*",
        semantic_usd.alias("semantic_cost"),
        structured_usd.alias("structured_cost"),
        (semantic_usd + structured_usd).alias("total_cost"),
    )


def mode_comparison(plain: DataFrame, batched: DataFrame) -> DataFrame:
    """Speed-up and call reduction between two one-row ``(calls, seconds)`` summaries."""
    tagged = plain.select(F.lit("plain").alias("mode"), "calls", "seconds").unionByName(
        batched.select(F.lit("batched").alias("mode"), "calls", "seconds")
    )
    pick = lambda mode, column: F.max(F.when(F.col("mode") == mode, F.col(column)))
    seconds = pick("batched", "seconds")
    return tagged.agg(
        F.when(seconds > 0, pick("plain", "seconds") / seconds).otherwise(F.lit(1.0)).alias("speedup"),
        ((1 - pick("batched", "calls") / pick("plain", "calls")) * 100).alias("call_reduction"),
    )
