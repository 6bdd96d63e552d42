"""Resumable runs over folders that Spark writes from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.catalog.outcomes import LIMIT
from recordloom.catalog.registry import query
from recordloom.catalog.sources import _entity_sql, _records_sql, csv_folder
from recordloom.catalog.tables import ENTITIES, sql_json, sql_statement, sql_structured
from recordloom.operators.describing import template_describer
from recordloom.plans import job
from recordloom.session import fresh_folder

BATCH, COMMIT = 20, 5000


def _refusing(rows):
    """The template describer, refusing a batch with an order over the limit."""
    if any(float(r.get("Cost") or 0) > LIMIT for r in rows):
        raise ValueError("total over the limit")
    return template_describer(rows)


_BAD = f"source_type = 'Work_Orders' AND json_extract_string(json_data, 'Cost')::DOUBLE > {LIMIT}"
_PLACED = f"""{_records_sql()}, placed AS (
  SELECT *, {_BAD} AS bad, CAST(floor((row_number - 1) / {BATCH}.0) AS BIGINT) AS batch_id FROM entities),
stops AS (SELECT source_file, min(batch_id) AS stop_at FROM placed WHERE bad GROUP BY 1),
judged AS (SELECT * FROM placed LEFT JOIN stops USING (source_file))"""


@query(
    f"""WITH {_PLACED} SELECT source_file, row_number, batch_id < coalesce(stop_at, batch_id + 1) AS before_stop, 'ok' AS status,
         semantic_statement, combined_text FROM judged"""
)
def job_resumed(spark, sf):
    """A run that its describer suspends at the first refused batch of a file, and one that takes up the rest."""
    folder, output = csv_folder(spark, sf), fresh_folder(spark, "job")
    first = job.process_to(
        spark, folder, output, mode="optimized", batch_size=BATCH, describer=_refusing, on_error="stop", rows_per_commit=COMMIT
    )
    suspended = first.runs[-1]
    rows = job.process_to(spark, folder, output, mode="optimized", batch_size=BATCH, describer=template_describer).outcomes
    return rows.select(
        "source_file",
        "row_number",
        (F.col("run") <= suspended).alias("before_stop"),
        "status",
        "semantic_statement",
        "combined_text",
    )


@query(
    f"""WITH {_PLACED}, files AS (
         SELECT source_file, count(*) AS total_rows, count(*) FILTER (WHERE NOT bad) AS processed_rows,
           count(*) FILTER (WHERE bad) AS failed_rows FROM placed GROUP BY 1)
       SELECT source_file, total_rows, processed_rows, failed_rows, failed_rows = 0 AS success, failed_rows AS listed_failures,
         processed_rows AS listed_records FROM files"""
)
def job_outputs(spark, sf):
    """Envelopes, failed rows and the summary of a run whose failed rows a second call keeps as they are."""
    from recordloom.sinks.envelopes import read_processed

    folder, output = csv_folder(spark, sf), fresh_folder(spark, "job")
    settings = {"mode": "optimized", "batch_size": BATCH, "describer": _refusing}
    job.process_to(spark, folder, output, **settings)
    job.process_to(spark, folder, output, **settings, retry_failed=False)
    files = spark.read.json(f"{output}/summary/files")
    lost = spark.read.schema("source_file string").json(f"{output}/failed").groupBy("source_file").agg(F.count(F.lit(1)).alias("lost"))
    records = read_processed(spark, f"{output}/processed").groupBy("source_type").agg(F.count(F.lit(1)).alias("listed_records"))
    found = files.withColumn("source_type", F.regexp_replace("source_file", r"\.csv$", "")).join(records, "source_type", "left")
    return found.join(lost, "source_file", "left").select(
        "source_file",
        "total_rows",
        "processed_rows",
        "failed_rows",
        "success",
        F.coalesce("lost", F.lit(0)).alias("listed_failures"),
        F.coalesce("listed_records", F.lit(0)).alias("listed_records"),
    )


_RENAMED = {"Material_ID": "identifier", "Material_Name": "item", "Unit_Price": "cost"}
_HEADERS = [_RENAMED.get(h, h) for h in ENTITIES["Materials"][1].values()]


@query(
    f"""SELECT 'Materials.csv' AS source_file, row_number, {sql_json(_HEADERS)} AS json_data,
         {sql_statement(_HEADERS)} || ' | ' || {sql_structured(_HEADERS)} AS combined_text
       FROM (SELECT {', '.join(f'{h} AS {_RENAMED.get(h, h)}' for h in ENTITIES['Materials'][1].values())}, row_number
             FROM ({_entity_sql('Materials')}))"""
)
def job_header_mapping(spark, sf):
    """One file in auto mode under other headers, as one consolidated table."""
    from recordloom.functions.text import json_text

    output = fresh_folder(spark, "job")
    source = f"{csv_folder(spark, sf)}/Materials.csv"
    job.process_to(spark, source, output, output_mode="consolidated", header_mapping=_RENAMED)
    rows = spark.read.parquet(f"{output}/consolidated")
    return rows.select("source_file", "row_number", json_text(F.col("json_data")).alias("json_data"), "combined_text")


@query(
    "\nUNION ALL\n".join(
        f"""SELECT '{k}' AS source_type, count(*) AS rows, CASE WHEN count(*) <= 10 THEN 'simple - Small file (<10 rows)'
              WHEN count(*) <= 50 THEN 'optimized (batch_size=5) - Medium file'
              WHEN count(*) <= 200 THEN 'optimized (batch_size=10) - Large file'
              ELSE 'optimized (batch_size=20) - Very large file' END AS suggestion FROM {ENTITIES[k][0]}"""
        for k in ENTITIES
    )
)
def job_suggestion(spark, sf):
    return job.suggestion(spark, csv_folder(spark, sf))
