"""Profiles, batch sizes, plans and costs."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.catalog.registry import query
from recordloom.catalog.tables import (
    COLUMNS,
    ENTITIES,
    ORDER_KEYS,
    PATCHY_COLUMNS,
    PATCHY_SQL,
    entity_records,
    patchy_orders,
    sql_entities,
    table,
)
from recordloom.functions import planning as P
from recordloom.functions import text as X
from recordloom.operators import profiling as G
from recordloom.operators import summarizing as S

# --- fixed values: which benchmark columns are text ---
TEXT = {
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"],
    "pages": ["url", "html"],
    "benchmark": ["text"],
    "labels": [],
    "conversations": ["role", "text"],
    "patchy": ["o_orderstatus", "o_orderpriority"],
}
TIMES = {"orders": 1, "events": 1}


def _profile_sql(name: str, columns, source: str, order: str) -> str:
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in columns)
    chars = " + ".join(f"coalesce(length(CAST({c} AS VARCHAR)), 0)" for c in columns)
    n, text = len(columns), len(TEXT[name])
    numeric = n - text - TIMES.get(name, 0)
    return f"""SELECT '{name}' AS source_type, rows, {n} AS columns, {text} AS text_columns, {numeric} AS numeric_columns,
      null_cells, null_cells * 100.0::DOUBLE / (rows * {n}) AS null_percent, sample_chars / sample_rows AS avg_chars, max_chars,
      1 - sample_nulls / (sample_rows * {n}) AS density
      FROM (SELECT count(*) AS rows, CAST(sum({nulls}) AS BIGINT) AS null_cells,
              least(count(*), 5)::DOUBLE AS sample_rows, (sum({nulls}) FILTER (WHERE rn <= 5))::DOUBLE AS sample_nulls,
              (sum({chars}) FILTER (WHERE rn <= 5))::DOUBLE AS sample_chars, max({chars}) FILTER (WHERE rn <= 5) AS max_chars
            FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM {source}))"""


_PROFILES_SQL = (
    f"{PATCHY_SQL}, profiles AS ("
    + "\nUNION ALL\n".join(
        [_profile_sql(n, c, n, ORDER_KEYS[n]) for n, c in COLUMNS.items()]
        + [_profile_sql("patchy", PATCHY_COLUMNS, "patchy", "o_orderkey")]
    )
    + ")"
)

_TOKENS = "(avg_chars / 4 + 50)"
_STEP = f"CASE WHEN {_TOKENS} < 50 THEN 25 WHEN {_TOKENS} < 100 THEN 20 WHEN {_TOKENS} < 200 THEN 15 WHEN {_TOKENS} < 400 THEN 10 ELSE 5 END"
_PLANS_SQL = (
    _PROFILES_SQL
    + f""", stepped AS (SELECT *, CASE WHEN rows < 10 THEN least({_STEP}, rows) WHEN rows < 50 THEN least({_STEP}, 10) ELSE {_STEP} END AS fitted
        FROM profiles),
      sized AS (SELECT *, CAST(greatest(1, least(30, trunc(fitted * CASE WHEN density < 0.3 THEN 1.5 WHEN density > 0.8 THEN 0.8 ELSE 1.0 END))) AS INTEGER)
        AS batch_size FROM stepped),
      plans AS (SELECT *, CAST(ceil(rows / batch_size) AS BIGINT) AS calls FROM sized)"""
)


def tables(spark, sf):
    found = {n: table(spark, sf, n) for n in COLUMNS}
    found["patchy"] = patchy_orders(spark, sf)
    return found


def profiles(spark, sf):
    return G.profiles(tables(spark, sf))


def plans(spark, sf):
    return G.batch_plan(profiles(spark, sf))


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    f"""WITH {_PROFILES_SQL} SELECT source_type, rows, columns, text_columns, numeric_columns, null_cells,
         round(null_percent, 6) AS null_percent, round(avg_chars, 6) AS avg_chars, max_chars, round(density, 6) AS density
       FROM profiles"""
)
def table_profile(spark, sf):
    return _rounded(profiles(spark, sf), "null_percent", "avg_chars", "density")


@query(f"WITH {_PROFILES_SQL} SELECT source_type, round(density, 6) AS density, density < 0.3 AS sparse, density > 0.8 AS dense FROM profiles")
def data_density(spark, sf):
    density = F.col("density")
    return profiles(spark, sf).select(
        "source_type", F.round(density, 6).alias("density"), (density < 0.3).alias("sparse"), (density > 0.8).alias("dense")
    )


@query(
    f"""WITH {_PLANS_SQL} SELECT source_type, rows, round({_TOKENS}, 6) AS tokens_per_row, batch_size,
         round(avg_chars * batch_size / 4 + batch_size * 50, 6) AS tokens_per_batch,
         CASE WHEN avg_chars * batch_size / 4 + batch_size * 50 < 2500 THEN 'Good' ELSE 'High' END AS token_flag,
         CASE WHEN {_TOKENS} * batch_size > 3000 THEN 'high token usage' WHEN batch_size = 1 THEN 'single row batches'
              ELSE 'appropriate' END AS load FROM plans"""
)
def batch_size_by_tokens(spark, sf):
    chosen = plans(spark, sf).select(
        "source_type", "rows", "tokens_per_row", "batch_size", "tokens_per_batch", "token_flag", "load"
    )
    return _rounded(chosen, "tokens_per_row", "tokens_per_batch")


@query(
    f"""WITH {_PROFILES_SQL} SELECT source_type, CASE WHEN avg_chars < 100 THEN 20 WHEN avg_chars < 300 THEN 15
         WHEN avg_chars < 500 THEN 10 ELSE 5 END AS batch_size_chars FROM profiles"""
)
def batch_size_by_chars(spark, sf):
    return plans(spark, sf).select("source_type", "batch_size_chars")


@query(
    f"""WITH {_PROFILES_SQL} SELECT source_type, rows, CASE WHEN rows <= 10 THEN 'simple - Small file (<10 rows)'
         WHEN rows <= 50 THEN 'optimized (batch_size=5) - Medium file'
         WHEN rows <= 200 THEN 'optimized (batch_size=10) - Large file'
         ELSE 'optimized (batch_size=20) - Very large file' END AS suggested_mode FROM profiles"""
)
def suggested_mode(spark, sf):
    return plans(spark, sf).select("source_type", "rows", "suggested_mode")


@query(
    f"""WITH {_PROFILES_SQL}, sized AS (SELECT *, round(rows * avg_chars / 1048576, 6) AS size_mb FROM profiles),
         modes AS (SELECT *, CASE WHEN rows <= 10 OR size_mb < 0.5 THEN 'simple' ELSE 'optimized' END AS mode FROM sized)
       SELECT source_type, rows, size_mb, mode, CAST(CASE WHEN mode = 'optimized' AND rows > 100 THEN least(20, rows // 10)
         ELSE 10 END AS INTEGER) AS batch_size FROM modes"""
)
def detected_mode(spark, sf):
    size = F.round(F.col("rows") * F.col("avg_chars") / 1048576, 6)
    sized = profiles(spark, sf).select("source_type", "rows", size.alias("size_mb"))
    mode = P.detected_mode(F.lit(False), F.lit(True), F.col("rows"), F.col("size_mb"))
    return sized.withColumn("mode", mode).withColumn(
        "batch_size", P.detected_batch_size(F.col("mode"), F.col("rows"))
    )


@query(
    f"""WITH {_PLANS_SQL} SELECT source_type, rows, batch_size, calls, CAST(rows // batch_size + 1 AS BIGINT) AS calls_plus_one
       FROM plans"""
)
def batch_plan(spark, sf):
    over = F.floor(F.col("rows") / F.col("batch_size")) + 1
    return plans(spark, sf).select("source_type", "rows", "batch_size", "calls", over.alias("calls_plus_one"))


@query(
    f"""WITH {_PLANS_SQL} SELECT count(*) AS files, CAST(sum(rows) AS BIGINT) AS total_rows, CAST(sum(calls) AS BIGINT) AS total_calls,
         round(sum(batch_size * rows) / sum(rows), 6) AS avg_batch_size, round(sum(rows) / sum(calls), 6) AS rows_per_call,
         round((sum(rows) - sum(calls)) / sum(rows) * 100, 6) AS reduction_percent FROM plans"""
)
def plan_totals(spark, sf):
    return _rounded(G.plan_totals(plans(spark, sf)), "avg_batch_size", "rows_per_call", "reduction_percent")


@query(f"WITH {_PLANS_SQL} SELECT source_type, batch_size, rows, calls FROM plans ORDER BY batch_size, source_type")
def plan_report(spark, sf):
    chosen = plans(spark, sf).select("source_type", "batch_size", "rows", "calls")
    return chosen.orderBy("batch_size", "source_type")


@query(
    f"""WITH {sql_entities()}, tokens AS (SELECT CAST(sum(floor(length(semantic_statement) / 4)) AS BIGINT) AS semantic_tokens,
         CAST(sum(floor(length(structured_text) / 4)) AS BIGINT) AS structured_tokens FROM entities)
       SELECT semantic_tokens, structured_tokens, round(semantic_tokens / 1000000 * 0.13::DOUBLE, 9) AS semantic_cost,
         round(structured_tokens / 1000000 * 0.02::DOUBLE, 9) AS structured_cost,
         round(semantic_tokens / 1000000 * 0.13::DOUBLE + structured_tokens / 1000000 * 0.02::DOUBLE, 9) AS total_cost FROM tokens"""
)
def token_costs(spark, sf):
    texts = entity_records(spark, sf).select(
        "semantic_statement", X.structured_text_of_map(F.col("json_data")).alias("structured")
    )
    totals = S.token_totals(texts, "semantic_statement", "structured")
    return totals.withColumns({c: F.round(c, 9) for c in ("semantic_cost", "structured_cost", "total_cost")})


@query(
    f"""WITH {sql_entities()} SELECT source_type AS type, count(*) AS records FROM entities GROUP BY 1
       UNION ALL SELECT '(all)', count(*) FROM entities"""
)
def type_counts(spark, sf):
    return S.type_counts(entity_records(spark, sf).select(F.col("source_type").alias("type")))


@query(
    "\nUNION ALL\n".join(
        f"SELECT '{kind}' AS source_type, '{header}' AS header, count({column}) AS present FROM {name}"
        for kind, (name, headers) in ENTITIES.items()
        for column, header in headers.items()
    )
)
def key_presence(spark, sf):
    keys = entity_records(spark, sf).select("source_type", F.explode("json_data").alias("header", "value"))
    return keys.groupBy("source_type", "header").agg(F.count("value").alias("present"))
