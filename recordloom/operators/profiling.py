"""Table profiles and batch plans: one aggregate per table, rules on top of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.constants import SAMPLE_ROWS
from recordloom.functions import planning as P
from recordloom.functions import text as X
from recordloom.operators.records import cell_columns


KINDS = ["source_type", "columns", "text_columns", "numeric_columns"]


def _cell_facts(table: DataFrame, name: str, columns: Sequence[str]) -> tuple[DataFrame, tuple]:
    """Narrow per-row facts of one table, and its column counts."""
    types = {f.name: f.dataType.typeName() for f in table.schema.fields}
    nulls = " + ".join(["0", *[f"int({X.column_sql(c)} IS NULL)" for c in columns]])
    texts = X.field_texts(table, columns).values()
    chars = " + ".join(["0", *[f"coalesce(length({t}), 0)" for t in texts]])
    counts = (
        name,
        len(columns),
        sum(types[c] == "string" for c in columns),
        sum(types[c] in ("long", "integer", "short", "double", "float") for c in columns),
    )
    sampled = f"row_number <= {SAMPLE_ROWS}"
    rows = table.select(
        *[F.lit(v).alias(k) for k, v in zip(KINDS, counts)],
        F.lit(1).alias("_rows"),
        F.expr(nulls).alias("_nulls"),
        F.expr(f"if({sampled}, {chars}, NULL)").alias("_chars"),
    )
    return rows, counts


def profiles(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per numbered table: size, nulls, characters of its first rows, column kinds.

    Character counts look at the first ``SAMPLE_ROWS`` rows, which is the rule;
    rows and nulls are counted over whole tables. All tables share one scan stage
    and one exchange, to which every task sends one partial row per table.
    """
    facts = [_cell_facts(t, n, cell_columns(t)) for n, t in tables.items()]
    spark = facts[0][0].sparkSession
    # A table without rows still gets its profile.
    present = spark.createDataFrame(
        [(*counts, 0, 0, None) for _, counts in facts],
        "source_type string, columns int, text_columns int, numeric_columns int, _rows int, _nulls int, _chars int",
    )
    sampled = F.col("_chars").isNotNull()
    sums = (
        reduce(lambda a, b: a.unionByName(b), [present, *[rows for rows, _ in facts]])
        .groupBy(*KINDS)
        .agg(
            F.sum("_rows").alias("rows"),
            F.sum("_nulls").alias("null_cells"),
            F.count_if(sampled).alias("_sample"),
            F.coalesce(F.sum(F.when(sampled, F.col("_nulls"))), F.lit(0)).alias("_sample_nulls"),
            F.coalesce(F.sum("_chars"), F.lit(0)).alias("_sample_chars"),
            F.coalesce(F.max("_chars"), F.lit(0)).alias("max_chars"),
        )
    )
    sample_cells = F.col("_sample") * F.col("columns")
    return sums.select(
        "source_type",
        "rows",
        "columns",
        "text_columns",
        "numeric_columns",
        "null_cells",
        P.percent(F.col("null_cells"), F.col("rows") * F.col("columns")).alias("null_percent"),
        P.ratio(F.col("_sample_chars"), F.col("_sample")).alias("avg_chars"),
        "max_chars",
        F.when(sample_cells > 0, 1 - F.col("_sample_nulls") / sample_cells).otherwise(F.lit(0.5)).alias("density"),
    )


def profile(table: DataFrame, name: str) -> DataFrame:
    return profiles({name: table})


def batch_plan(profile_rows: DataFrame) -> DataFrame:
    """Both batch-size rules, calls and token load for each profiled table."""
    row_tokens = P.tokens_per_row(F.col("avg_chars"))
    sized = profile_rows.select(
        "*",
        row_tokens.alias("tokens_per_row"),
        P.batch_size_by_tokens(F.col("rows"), F.col("avg_chars"), F.col("density")).alias("batch_size"),
        P.batch_size_by_chars(F.col("avg_chars")).alias("batch_size_chars"),
    )
    batch_tokens = P.tokens_per_batch(F.col("avg_chars"), F.col("batch_size"))
    return sized.select(
        "*",
        P.calls_needed(F.col("rows"), F.col("batch_size")).alias("calls"),
        batch_tokens.alias("tokens_per_batch"),
        P.batch_token_flag(batch_tokens).alias("token_flag"),
        P.load_warning(F.col("tokens_per_row"), F.col("batch_size")).alias("load"),
        P.suggested_mode(F.col("rows")).alias("suggested_mode"),
    )


def plan_totals(plan: DataFrame) -> DataFrame:
    """Totals over all planned tables and what batching saves."""
    rows, calls = F.sum("rows"), F.sum("calls")
    return plan.agg(
        F.count(F.lit(1)).alias("files"),
        rows.alias("total_rows"),
        calls.alias("total_calls"),
        P.ratio(F.sum(F.col("batch_size") * F.col("rows")), rows).alias("avg_batch_size"),
        P.ratio(rows, calls).alias("rows_per_call"),
        P.percent(rows - calls, rows).alias("reduction_percent"),
    )
