"""Prompts, responses and the pluggable row describer with its failure policies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import text as X
from recordloom.operators.numbering import batch_id
from recordloom.session import written

Describer = Callable[[list[dict]], list[str]]

POLICIES = ("split", "drop", "stop", "fallback", "error_record")
OUTCOME = T.StructType(
    [
        T.StructField("statement", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("calls", T.IntegerType()),
    ]
)

DEFAULT_HEADER = "Describe every data row below in one natural sentence that names all its values.\n"
DEFAULT_TRAILER = '\n\nAnswer with one JSON object: {"row_1": {"description": "..."}, "row_2": ...}\n'


# ---------------------------------------------------------------------- prompts


def batch_prompts(
    records: DataFrame, batch_size: int, header: str = DEFAULT_HEADER, trailer: str = DEFAULT_TRAILER
) -> DataFrame:
    """One prompt per batch: header, a numbered block per row, trailer.

    A group is one batch of at most ``batch_size`` rows, so even a file with most
    of the data spreads over its many batches.
    """
    row_json = X.json_text(F.col("json_data"))
    member = F.struct("row_number", row_json.alias("row_json"))
    blocks = F.transform(
        F.sort_array(F.collect_list(member)),
        lambda m, i: F.concat(F.lit("\n--- Row "), (i + 1).cast("string"), F.lit(" ---\n"), m["row_json"]),
    )
    return (
        records.withColumn("batch_id", batch_id(F.col("row_number"), batch_size))
        .groupBy("source_file", "batch_id")
        .agg(
            F.count(F.lit(1)).alias("batch_rows"),
            F.concat(F.lit(header), F.array_join(blocks, ""), F.lit(trailer)).alias("prompt"),
        )
    )


def single_prompt(data: Column, header: str = DEFAULT_HEADER, trailer: str = DEFAULT_TRAILER) -> Column:
    return F.concat(F.lit(header), F.lit("\n"), X.json_text(data), F.lit(trailer))


def parse_responses(responses: DataFrame, field: str = "description") -> DataFrame:
    """``(source_file, batch_id, position, description)`` from JSON responses keyed ``row_1``, ``row_2``, …"""
    answers = F.from_json("response", f"map<string,struct<{field}:string>>")
    return responses.select("source_file", "batch_id", F.explode(answers).alias("key", "answer")).select(
        "source_file",
        "batch_id",
        F.regexp_extract("key", "^row_([0-9]+)$", 1).try_cast("int").alias("position"),
        F.col(f"answer.{field}").alias("description"),
    )


def parse_result_lists(responses: DataFrame, field: str = "description") -> DataFrame:
    """The other response form: an object with a ``results`` array in row order."""
    answers = F.from_json("response", f"struct<results:array<struct<{field}:string>>>")["results"]
    return responses.select("source_file", "batch_id", F.posexplode(answers).alias("index", "answer")).select(
        "source_file", "batch_id", (F.col("index") + 1).alias("position"), F.col(f"answer.{field}").alias("description")
    )


def attach_descriptions(records: DataFrame, parsed: DataFrame, batch_size: int) -> DataFrame:
    """Each row with the description at its position in its batch; a missing or blank one is a failure."""
    placed = records.withColumn("batch_id", batch_id(F.col("row_number"), batch_size)).withColumn(
        "position", (F.col("row_number") - F.col("batch_id") * batch_size).cast("int")
    )
    joined = placed.join(parsed, ["source_file", "batch_id", "position"], "left")
    usable = F.col("description").isNotNull() & (F.col("description") != "")
    return joined.withColumn("status", F.when(usable, F.lit("ok")).otherwise(F.lit("failed"))).withColumn(
        "error_message",
        F.when(~usable | usable.isNull(), F.concat(F.lit("no description for row "), F.col("row_number").cast("string"))),
    )


def batch_completeness(attached: DataFrame) -> DataFrame:
    """Rows sent and descriptions returned per batch."""
    sent, got = F.count(F.lit(1)), F.count_if(F.col("status") == "ok")
    return attached.groupBy("source_file", "batch_id").agg(
        sent.alias("batch_rows"), got.alias("described_rows"), (sent == got).alias("complete")
    )


# -------------------------------------------------------------------- describer


def template_describer(rows: list[dict]) -> list[str]:
    """The default describer as a Python callable, for tests of the plug-in slot."""
    out = []
    for row in rows:
        parts = [f"{k} is {v}" for k, v in row.items() if v not in (None, "", "null")]
        out.append(f"Record with {', '.join(parts[:3])}..." if parts else "Record")
    return out


def described_singly(data: Column, describe_row: Callable[[dict], str]) -> Column:
    """A row describer without batches: one call per row, Arrow batches in between."""

    @F.pandas_udf("string")
    def call(rows: pd.Series) -> pd.Series:
        return rows.map(lambda row: describe_row(dict(row)), na_action="ignore")

    return call(data)


def describe(
    records: DataFrame,
    describer: Describer,
    batch_size: int,
    on_error: str = "split",
    attempts: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Call ``describer`` on batches of rows and record what became of every row.

    Adds ``batch_id`` and the columns of ``OUTCOME``. Policies for a batch whose
    call raises, returns too few results or a blank one:

    * ``split`` – halve it down to single rows, so only rows that fail alone fail;
    * ``drop`` – all its rows fail;
    * ``stop`` – its rows fail and later batches of the file are left ``pending``;
    * ``fallback`` – its rows get the raw-record statement;
    * ``error_record`` – its rows are tried singly, failures keep an error statement.

    Rows are exchanged once, by batch, so that a batch meets in one task; a large
    file spreads over its batches. ``partitions`` (the session's shuffle partitions
    by default) is kept as given, because calls, not bytes, are what costs here.
    Failures are values, never failed tasks.
    """
    if on_error not in POLICIES:
        raise ValueError(f"unknown policy {on_error!r}")
    if partitions is None:
        partitions = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    described = _run(records, describer, batch_size, on_error, attempts, partitions)
    if on_error == "stop":
        # The outcome feeds both the first failure and the rows: store it, call once.
        described = _stopped(written(described, "described"))
    finished = _finished(described, on_error)
    placed = [c for c in records.columns if c in finished.columns]
    return finished.select(*placed, *[c for c in finished.columns if c not in placed])


def _run(records, describer, batch_size, on_error, attempts, partitions) -> DataFrame:
    keyed = records.withColumn("batch_id", batch_id(F.col("row_number"), batch_size))
    # The texts are made anew from the outcome, so earlier ones need not be built nor travel.
    keyed = keyed.drop("semantic_statement", "combined_text")
    gathered = keyed.repartition(partitions, "source_file", "batch_id").sortWithinPartitions(
        "source_file", "batch_id", "row_number"
    )
    schema = T.StructType(gathered.schema.fields + OUTCOME.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for arrived in batches:
            table = pa.Table.from_batches([arrived])
            if waiting is not None:
                table = pa.concat_tables([waiting, table])
            edges = _group_edges(table)
            if len(edges) > 2:
                yield from _outcomes(table.slice(0, edges[-2]), edges[:-1], describer, on_error, attempts)
            waiting = table.slice(edges[-2]) if table.num_rows else None
        if waiting is not None and waiting.num_rows:
            yield from _outcomes(waiting, [0, waiting.num_rows], describer, on_error, attempts)

    return gathered.mapInArrow(work, schema)


def _group_edges(table: pa.Table) -> list[int]:
    """Offsets at which the (file, batch) key changes, with both ends."""
    n = table.num_rows
    if n < 2:
        return [0, n]
    moved = None
    for name in ("source_file", "batch_id"):
        column = table[name].combine_chunks()
        differs = pc.not_equal(column.slice(1), column.slice(0, n - 1))
        moved = differs if moved is None else pc.or_(moved, differs)
    return [0, *(np.flatnonzero(moved.to_numpy(zero_copy_only=False)) + 1).tolist(), n]


def _outcomes(table: pa.Table, edges: list[int], describer, on_error, attempts) -> Iterator[pa.RecordBatch]:
    rows = _dicts(table["json_data"].combine_chunks())
    results = []
    for start, end in zip(edges, edges[1:]):
        results += _settle(rows[start:end], describer, on_error, attempts)
    for name, column, kind in zip(
        OUTCOME.fieldNames(),
        zip(*results),
        [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32()],
    ):
        table = table.append_column(name, pa.array(column, kind))
    yield from table.combine_chunks().to_batches()


def _dicts(maps: pa.MapArray) -> list[dict]:
    """Every row of a text map as a dictionary, an empty one for null. Keys and values are converted in one go."""
    if not len(maps):
        return []
    offsets = maps.offsets.to_numpy()
    first, last = int(offsets[0]), int(offsets[-1])
    keys = maps.keys.slice(first, last - first).to_numpy(zero_copy_only=False).tolist()
    values = maps.items.slice(first, last - first).to_numpy(zero_copy_only=False).tolist()
    at = (offsets - first).tolist()
    rows = [dict(zip(keys[a:b], values[a:b])) for a, b in zip(at, at[1:])]
    if maps.null_count:
        return [row if valid else {} for row, valid in zip(rows, maps.is_valid().to_pylist())]
    return rows


def _settle(rows: list[dict], describer, on_error: str, attempts: int, earlier: int = 0) -> list[tuple]:
    """Outcome tuples of one batch; the calls made are booked on its first row."""
    error = None
    for tried in range(1, attempts + 1):
        try:
            texts = list(describer(rows))
            if len(texts) != len(rows):
                raise ValueError(f"{len(texts)} results for {len(rows)} rows")
            if not all(texts):
                raise ValueError("blank description")
            return _booked([(t, "ok", None, None, earlier + tried - 1, 0) for t in texts], tried)
        except Exception as e:  # noqa: BLE001 - the describer is user code
            error = e
    retries = earlier + attempts
    if len(rows) > 1 and on_error in ("split", "error_record"):
        middle = len(rows) // 2 if on_error == "split" else 1
        parts = [rows[:middle], rows[middle:]] if on_error == "split" else [[r] for r in rows]
        settled = [o for part in parts for o in _settle(part, describer, on_error, attempts, retries)]
        return _booked(settled, attempts)
    status = {"fallback": "fallback", "error_record": "error_record"}.get(on_error, "failed")
    failed = (None, status, type(error).__name__, str(error), retries, 0)
    return _booked([failed] * len(rows), attempts)


def _booked(outcomes: list[tuple], calls: int) -> list[tuple]:
    first = outcomes[0]
    return [(*first[:5], first[5] + calls), *outcomes[1:]]


def _stopped(described: DataFrame) -> DataFrame:
    failures = described.filter(F.col("status") == "failed")
    first = failures.groupBy("source_file").agg(F.min("batch_id").alias("_stop"))
    # One row per file at most: sent whole, so that the rows of a large file stay spread.
    joined = described.join(F.broadcast(first), "source_file", "left")
    later = F.col("batch_id") > F.col("_stop")
    never_tried = {c: F.when(~F.coalesce(later, F.lit(False)), F.col(c)) for c in ("statement", "error_type", "error_message")}
    zeroed = {c: F.when(later, F.lit(0)).otherwise(F.col(c)) for c in ("calls", "retry_count")}
    status = F.when(later, F.lit("pending")).otherwise(F.col("status"))
    return joined.withColumns({**never_tried, **zeroed, "status": status}).drop("_stop")


def _finished(described: DataFrame, on_error: str) -> DataFrame:
    """Final statement and combined text for every outcome."""
    structured = X.structured_text_of_map(F.col("json_data"))
    stem = F.regexp_replace("source_file", r"\.[^.]*$", "")
    status = F.col("status")
    statement = (
        F.when(status == "ok", F.col("statement"))
        .when(status == "fallback", X.fallback_statement(stem, F.col("row_number")))
        .when(status == "error_record", X.error_statement(F.col("error_message")))
    )
    combined = (
        F.when(status == "ok", X.combined_text(F.col("statement"), structured))
        .when(status == "fallback", structured)
        .when(status == "error_record", X.json_text(F.col("json_data")))
    )
    return (
        described.withColumn("combined_text", combined)
        .withColumn("semantic_statement", statement)
        .drop("statement")
    )


def failures(described: DataFrame) -> DataFrame:
    """The failed-row side output."""
    return described.filter(F.col("status") == "failed").select(
        "source_file",
        "row_number",
        "error_type",
        "error_message",
        "retry_count",
        F.col("json_data").alias("row_data"),
    )


def retried(described: DataFrame, describer: Describer, attempts: int = 1) -> DataFrame:
    """A second pass over failed rows, one at a time; every row stays in the result exactly once.

    The first pass is stored, because it is read for its successes and its failures.
    """
    described = written(described, "first-pass")
    outcome = [c for c in OUTCOME.fieldNames() if c != "statement"]
    again = described.filter(F.col("status") == "failed").drop(*outcome, "batch_id", "semantic_statement", "combined_text")
    second = describe(again, describer, 1, "split", attempts)
    return described.filter(F.col("status") != "failed").unionByName(second.select(*described.columns))
