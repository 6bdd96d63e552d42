"""Prompts, responses, describer policies and run summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.catalog.registry import query
from recordloom.catalog.tables import (
    COLUMNS,
    ORDER_KEYS,
    PATCHY_COLUMNS,
    PATCHY_SQL,
    patchy_orders,
    sql_json,
    sql_statement,
    sql_structured,
    table,
)
from recordloom.functions import planning as P
from recordloom.functions import text as X
from recordloom.operators import describing as D
from recordloom.operators import numbering as N
from recordloom.operators import records as O
from recordloom.operators import summarizing as S

BATCH = 20
LIMIT = 495000
ORDERS = COLUMNS["orders"]
STATEMENT, STRUCTURED = sql_statement(ORDERS), sql_structured(ORDERS)

_ROWS_SQL = f"""numbered AS (
  SELECT row_number() OVER (ORDER BY o_orderkey) AS row_number, * FROM orders),
batched AS (
  SELECT *, CAST(floor((row_number - 1) / {BATCH}.0) AS BIGINT) AS batch_id, o_totalprice > {LIMIT} AS bad,
         {STATEMENT} AS statement, {STRUCTURED} AS structured FROM numbered),
judged AS (
  SELECT *, bool_or(bad) OVER (PARTITION BY batch_id) AS bad_batch FROM batched),
stopping AS (
  SELECT *, (SELECT min(batch_id) FROM judged WHERE bad) AS stop_at FROM judged)"""


def picky_describer(rows):
    """The template describer, refusing a batch with a total over the limit."""
    for row in rows:
        if float(row["o_totalprice"]) > LIMIT:
            raise ValueError("total over the limit")
    return D.template_describer(rows)


def order_records(spark, sf):
    return O.build_records(table(spark, sf, "orders")).drop("semantic_statement", "combined_text")


def _shown(outcomes):
    return outcomes.select(
        "row_number", "batch_id", "status", "semantic_statement", "combined_text", "error_type", "error_message"
    )


def _outcome_sql(status: str, statement: str, combined: str, failed: str, where: str = "") -> str:
    return f"""WITH {_ROWS_SQL} SELECT row_number, batch_id, {status} AS status, {statement} AS semantic_statement,
         {combined} AS combined_text, CASE WHEN {failed} THEN 'ValueError' END AS error_type,
         CASE WHEN {failed} THEN 'total over the limit' END AS error_message FROM stopping {where}"""


def _describe_one(row):
    return D.template_describer([row])[0]


@query(
    f"""WITH {PATCHY_SQL} SELECT row_number, {sql_statement(PATCHY_COLUMNS)} AS semantic_statement FROM patchy"""
)
def single_describer(spark, sf):
    rows = O.build_records(patchy_orders(spark, sf), PATCHY_COLUMNS)
    return rows.select("row_number", D.described_singly(F.col("json_data"), _describe_one).alias("semantic_statement"))


@query(
    _outcome_sql(
        "CASE WHEN bad THEN 'failed' ELSE 'ok' END",
        "CASE WHEN NOT bad THEN statement END",
        "CASE WHEN NOT bad THEN statement || ' | ' || structured END",
        "bad",
    )
)
def split_policy(spark, sf):
    return _shown(D.describe(order_records(spark, sf), picky_describer, BATCH, "split"))


@query(
    _outcome_sql(
        "CASE WHEN bad_batch THEN 'failed' ELSE 'ok' END",
        "CASE WHEN NOT bad_batch THEN statement END",
        "CASE WHEN NOT bad_batch THEN statement || ' | ' || structured END",
        "bad_batch",
    )
)
def drop_policy(spark, sf):
    return _shown(D.describe(order_records(spark, sf), picky_describer, BATCH, "drop"))


_KEPT = "(stop_at IS NULL OR batch_id < stop_at)"


@query(
    _outcome_sql(
        f"CASE WHEN {_KEPT} THEN 'ok' WHEN batch_id = stop_at THEN 'failed' ELSE 'pending' END",
        f"CASE WHEN {_KEPT} THEN statement END",
        f"CASE WHEN {_KEPT} THEN statement || ' | ' || structured END",
        "batch_id = stop_at",
    )
)
def stop_policy(spark, sf):
    return _shown(D.describe(order_records(spark, sf), picky_describer, BATCH, "stop"))


@query(
    _outcome_sql(
        "CASE WHEN bad_batch THEN 'fallback' ELSE 'ok' END",
        "CASE WHEN bad_batch THEN 'Data for orders row ' || row_number ELSE statement END",
        "CASE WHEN bad_batch THEN structured ELSE statement || ' | ' || structured END",
        "bad_batch",
    )
)
def fallback_policy(spark, sf):
    return _shown(D.describe(order_records(spark, sf), picky_describer, BATCH, "fallback"))


@query(
    _outcome_sql(
        "CASE WHEN bad THEN 'error_record' ELSE 'ok' END",
        "CASE WHEN bad THEN 'Error: total over the limit' ELSE statement END",
        f"CASE WHEN bad THEN {sql_json(ORDERS)} ELSE statement || ' | ' || structured END",
        "bad",
    )
)
def error_record_policy(spark, sf):
    return _shown(D.describe(order_records(spark, sf), picky_describer, BATCH, "error_record"))


@query(
    f"""WITH {_ROWS_SQL} SELECT 'orders.parquet' AS source_file, row_number, 'ValueError' AS error_type,
         'total over the limit' AS error_message, {sql_json(ORDERS)} AS row_data FROM stopping WHERE bad"""
)
def failed_rows(spark, sf):
    lost = D.failures(D.describe(order_records(spark, sf), picky_describer, BATCH, "split"))
    return lost.select(
        "source_file", "row_number", "error_type", "error_message", X.json_text(F.col("row_data")).alias("row_data")
    )


@query(
    f"""WITH {_ROWS_SQL} SELECT row_number, CASE WHEN bad THEN 'failed' ELSE 'ok' END AS status,
         CASE WHEN NOT bad THEN statement END AS semantic_statement FROM stopping"""
)
def retried_rows(spark, sf):
    dropped = D.describe(order_records(spark, sf), picky_describer, BATCH, "drop")
    return D.retried(dropped, picky_describer).select("row_number", "status", "semantic_statement")


@query(
    f"""WITH {_ROWS_SQL} SELECT 'orders.parquet' AS source_file, count(*) AS total_rows,
         count(*) FILTER (WHERE NOT bad_batch) AS processed_rows, count(*) FILTER (WHERE bad_batch) AS failed_rows,
         count(DISTINCT batch_id) AS calls, max(CASE WHEN bad_batch THEN 'total over the limit' END) AS error_message,
         round(count(*) FILTER (WHERE NOT bad_batch) / count(*) * 100, 6) AS success_rate,
         NOT bool_or(bad_batch) AS success FROM stopping"""
)
def file_summary(spark, sf):
    outcomes = D.describe(order_records(spark, sf), picky_describer, BATCH, "drop")
    return S.file_results(outcomes).withColumn("success_rate", F.round("success_rate", 6))


@query(
    f"""WITH {_ROWS_SQL}, batches AS (
         SELECT batch_id, count(*) AS batch_rows, count(*) FILTER (WHERE NOT bad_batch) AS batch_processed
         FROM stopping GROUP BY batch_id)
       SELECT 'orders.parquet' AS source_file, batch_id, batch_rows, batch_processed,
         CAST(sum(batch_processed) OVER (ORDER BY batch_id) AS BIGINT) AS processed_so_far,
         CAST(sum(batch_rows) OVER () AS BIGINT) AS total_rows,
         round(sum(batch_processed) OVER (ORDER BY batch_id) / sum(batch_rows) OVER () * 100, 6) AS percent FROM batches"""
)
def running_progress(spark, sf):
    outcomes = D.describe(order_records(spark, sf), picky_describer, BATCH, "drop")
    return S.progress(outcomes).withColumn("percent", F.round("percent", 6))


_HEAD, _TAIL = "Describe:\n", "\nEnd.\n"


@query(
    f"""WITH {PATCHY_SQL}, blocks AS (
         SELECT CAST(floor((row_number - 1) / {BATCH}.0) AS BIGINT) AS batch_id, row_number,
                {sql_json(PATCHY_COLUMNS)} AS row_json FROM patchy)
       SELECT 'orders.parquet' AS source_file, batch_id, count(*) AS batch_rows,
         'Describe:' || chr(10) || string_agg(chr(10) || '--- Row ' || ((row_number - 1) % {BATCH} + 1) || ' ---'
           || chr(10) || row_json, '' ORDER BY row_number) || chr(10) || 'End.' || chr(10) AS prompt
       FROM blocks GROUP BY batch_id"""
)
def batch_prompts(spark, sf):
    return D.batch_prompts(O.build_records(patchy_orders(spark, sf), PATCHY_COLUMNS), BATCH, _HEAD, _TAIL)


_TURNS = 8


def _turns(spark, sf):
    return table(spark, sf, "conversations").withColumn("source_file", F.lit("conversations"))


def _responses(spark, sf, listed: bool = False):
    """One JSON response per batch of turns, as an answering service would give.

    A turn's text is the description of its row; system turns answer with a blank,
    and the keyed form leaves out assistant turns of a single line.
    """
    row = F.col("row_number")
    turns = _turns(spark, sf).withColumn("batch_id", N.batch_id(row, _TURNS))
    said = F.struct(F.when(F.col("role") == "system", "").otherwise(F.col("text")).alias("description"))
    if listed:
        in_order = F.array_sort(F.collect_list(F.struct("row_number", said.alias("answer"))))
        body = F.to_json(F.struct(F.transform(in_order, lambda m: m["answer"]).alias("results")))
    else:
        turns = turns.filter((F.col("role") != "assistant") | F.col("text").contains("\n"))
        key = F.concat(F.lit("row_"), (row - F.col("batch_id") * _TURNS).cast("string"))
        body = F.to_json(F.map_from_entries(F.collect_list(F.struct(key, said))))
    return turns.groupBy("source_file", "batch_id").agg(body.alias("response"))


_PLACED_SQL = f"""rows AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS row_number, * FROM conversations),
  placed AS (SELECT *, CAST(floor((row_number - 1) / {_TURNS}.0) AS BIGINT) AS batch_id,
             CAST((row_number - 1) % {_TURNS} + 1 AS INTEGER) AS position,
             CASE WHEN role = 'system' THEN '' ELSE text END AS description,
             role = 'assistant' AND NOT contains(text, chr(10)) AS omitted FROM rows)"""


@query(
    f"""WITH {_PLACED_SQL} SELECT 'conversations' AS source_file, batch_id, position, description FROM placed WHERE NOT omitted"""
)
def parse_responses(spark, sf):
    return D.parse_responses(_responses(spark, sf))


@query(f"WITH {_PLACED_SQL} SELECT 'conversations' AS source_file, batch_id, position, description FROM placed")
def parse_result_lists(spark, sf):
    return D.parse_result_lists(_responses(spark, sf, listed=True))


@query(
    f"""WITH {_PLACED_SQL} SELECT row_number, batch_id, position, CASE WHEN NOT omitted THEN description END AS description,
         CASE WHEN NOT omitted AND description <> '' THEN 'ok' ELSE 'failed' END AS status,
         CASE WHEN omitted OR description = '' THEN 'no description for row ' || row_number END AS error_message FROM placed"""
)
def positional_join(spark, sf):
    joined = D.attach_descriptions(_turns(spark, sf), D.parse_responses(_responses(spark, sf)), _TURNS)
    return joined.select("row_number", "batch_id", "position", "description", "status", "error_message")


@query(
    f"""WITH {_PLACED_SQL} SELECT 'conversations' AS source_file, batch_id, count(*) AS batch_rows,
         count(*) FILTER (WHERE NOT omitted AND description <> '') AS described_rows,
         bool_and(NOT omitted AND description <> '') AS complete FROM placed GROUP BY batch_id"""
)
def batch_completeness(spark, sf):
    parsed = D.parse_responses(_responses(spark, sf))
    return D.batch_completeness(D.attach_descriptions(_turns(spark, sf), parsed, _TURNS))


# --------------------------------------------------------------- whole-folder summaries

_RUN_TABLES = list(ORDER_KEYS)
_RUN_BATCH = 20


def template_run(spark, sf):
    from recordloom.plans.processing import process_tables

    return process_tables({n: table(spark, sf, n) for n in _RUN_TABLES}, _RUN_BATCH)


_FILES_SQL = "files AS (" + "\nUNION ALL\n".join(
    f"SELECT '{n}.parquet' AS source_file, count(*) AS total_rows, "
    f"CAST(ceil(count(*) / {_RUN_BATCH}.0) AS BIGINT) AS calls FROM {n}"
    for n in _RUN_TABLES
) + ")"


@query(
    f"""WITH {_FILES_SQL} SELECT source_file, total_rows, total_rows AS processed_rows, CAST(0 AS BIGINT) AS failed_rows,
         calls, CAST(NULL AS VARCHAR) AS error_message, CASE WHEN total_rows > 0 THEN 100.0::DOUBLE ELSE 0 END AS success_rate,
         true AS success FROM files"""
)
def file_results(spark, sf):
    return template_run(spark, sf).file_results


@query(
    f"""WITH {_FILES_SQL} SELECT count(*) AS total_files, count(*) AS successful_files, CAST(0 AS BIGINT) AS failed_files,
         CAST(sum(total_rows) AS BIGINT) AS total_rows, CAST(sum(total_rows) AS BIGINT) AS processed_rows,
         CAST(sum(calls) AS BIGINT) AS total_calls, 100.0::DOUBLE AS success_rate,
         round(sum(total_rows) / sum(calls), 6) AS rows_per_call FROM files"""
)
def folder_totals(spark, sf):
    return template_run(spark, sf).totals.withColumn("rows_per_call", F.round("rows_per_call", 6))


@query(
    f"""WITH {_FILES_SQL} SELECT source_file, total_rows, calls,
         round(total_rows / calls, 1) AS rows_per_call, round(total_rows / (calls * 1.5), 1) AS rows_per_second FROM files"""
)
def throughput(spark, sf):
    seconds = F.col("calls") * 1.5
    return template_run(spark, sf).file_results.select(
        "source_file",
        "total_rows",
        "calls",
        F.round(P.ratio(F.col("processed_rows"), F.col("calls")), 1).alias("rows_per_call"),
        S.rows_per_second(F.col("processed_rows"), seconds).alias("rows_per_second"),
    )


@query(
    f"""WITH {_FILES_SQL} SELECT round(sum(total_rows) * 1.0 / (sum(calls) * 1.5), 6) AS speedup,
         round((1 - sum(calls) / sum(total_rows)) * 100, 6) AS call_reduction FROM files"""
)
def mode_comparison(spark, sf):
    totals = template_run(spark, sf).totals
    plain = totals.select(F.col("total_rows").alias("calls"), (F.col("total_rows") * 1.0).alias("seconds"))
    batched = totals.select(F.col("total_calls").alias("calls"), (F.col("total_calls") * 1.5).alias("seconds"))
    return S.mode_comparison(plain, batched).select(
        F.round("speedup", 6).alias("speedup"), F.round("call_reduction", 6).alias("call_reduction")
    )


@query(
    "\nUNION ALL\n".join(
        f"""SELECT '{n}.parquet' AS source_file, CAST(floor((row_number - 1) / {_RUN_BATCH}.0) AS BIGINT) AS batch_id,
         min(row_number) AS first_row, max(row_number) AS last_row, count(*) AS batch_rows
         FROM (SELECT row_number() OVER (ORDER BY {ORDER_KEYS[n]}) AS row_number FROM {n}) GROUP BY 1, 2"""
        for n in _RUN_TABLES
    )
)
def batch_ranges(spark, sf):
    rows = O.union_records([table(spark, sf, n).select("source_file", "row_number") for n in _RUN_TABLES])
    return N.batch_ranges(rows, _RUN_BATCH)
