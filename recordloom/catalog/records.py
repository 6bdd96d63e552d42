"""Scalar functions, record building, filters and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.catalog.registry import query
from recordloom.catalog.tables import (
    COLUMNS,
    ENTITIES,
    ORDER_KEYS,
    PATCHY_COLUMNS,
    PATCHY_SQL,
    entity,
    entity_records,
    patchy_orders,
    plain,
    sql_entities,
    sql_json,
    sql_statement,
    sql_structured,
    table,
)
from recordloom.functions import planning as P
from recordloom.functions import records as R
from recordloom.functions import text as X
from recordloom.operators import records as O
from recordloom.operators.describing import single_prompt
from recordloom.operators.summarizing import is_valid_statement

PART = COLUMNS["part"]
ORDERS = COLUMNS["orders"]


@query(f"SELECT row_number() OVER (ORDER BY o_orderkey) AS row_number, o_orderkey FROM orders")
def row_numbers(spark, sf):
    return table(spark, sf, "orders").select("row_number", "o_orderkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount,
         CASE WHEN l_discount > 0 THEN l_quantity / l_discount END AS units_per_discount,
         nullif(l_returnflag, 'N') AS returnflag
       FROM lineitem"""
)
def null_cleaning(spark, sf):
    lines = plain(spark, sf, "lineitem")
    made_nan = F.when(F.col("l_discount") > 0, F.col("l_quantity") / F.col("l_discount")).otherwise(F.lit(float("nan")))
    token = F.when(F.col("l_returnflag") == "N", "N/A").otherwise(F.col("l_returnflag"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_discount",
        X.nan_to_null(made_nan).alias("units_per_discount"),
        X.tokens_to_null(token).alias("returnflag"),
    )


@query(
    """SELECT p_partkey, CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
         ELSE CAST(p_retailprice AS VARCHAR) END AS price_text FROM part"""
)
def integral_floats(spark, sf):
    return plain(spark, sf, "part").select("p_partkey", F.expr(X.integral_text("p_retailprice")).alias("price_text"))


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_extendedprice * 1000 AS VARCHAR) AS large,
         CAST(l_discount / 1000 AS VARCHAR) AS small, CAST(l_extendedprice * 1e13 AS VARCHAR) AS huge,
         CAST(l_tax AS VARCHAR) AS tax FROM lineitem"""
)
def number_texts(spark, sf):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    numbers = plain(spark, sf, "lineitem").select(
        *keys, (price * 1000).alias("large"), (discount / 1000).alias("small"), (price * 1e13).alias("huge"),
        F.col("l_tax").alias("tax"),
    )
    return numbers.select(*keys, *[F.expr(X.float_text(n)).alias(n) for n in ("large", "small", "huge", "tax")])


@query(
    """SELECT c_custkey AS Equipment_ID, c_name AS Equipment_Name, c_nationkey AS FL_ID,
         c_acctbal AS Nameplate_Power_kW, c_mktsegment AS Criticality FROM customer"""
)
def header_mapping(spark, sf):
    return O.rename_headers(plain(spark, sf, "customer"), ENTITIES["Equipment"][1])


@query(f"WITH {PATCHY_SQL} SELECT row_number, {sql_json(PATCHY_COLUMNS)} AS json_data FROM patchy")
def row_json(spark, sf):
    rows = patchy_orders(spark, sf)
    return rows.select("row_number", X.json_text(X.json_map(X.field_texts(rows, PATCHY_COLUMNS))).alias("json_data"))


@query(
    f"""SELECT row_number() OVER (ORDER BY o_orderkey) AS row_number,
         {sql_structured(ORDERS)} AS structured_text FROM orders"""
)
def structured_text(spark, sf):
    rows = table(spark, sf, "orders")
    return rows.select("row_number", X.structured_text(X.field_texts(rows, ORDERS)).alias("structured_text"))


@query(
    f"""WITH {PATCHY_SQL} SELECT row_number, {sql_structured(PATCHY_COLUMNS)} AS null_skipping,
         {sql_structured(PATCHY_COLUMNS, 'empty')} AS empty_skipping,
         {sql_structured(PATCHY_COLUMNS, 'none')} AS no_skipping FROM patchy"""
)
def structured_text_skip_rules(spark, sf):
    rows = patchy_orders(spark, sf)
    fields = X.field_texts(rows, PATCHY_COLUMNS)
    return rows.select(
        "row_number",
        X.structured_text(fields).alias("null_skipping"),
        X.structured_text(fields, "empty").alias("empty_skipping"),
        X.structured_text(fields, "none").alias("no_skipping"),
    )


@query(
    f"""WITH {PATCHY_SQL} SELECT row_number,
         {sql_statement(PATCHY_COLUMNS)} || ' | ' || {sql_structured(PATCHY_COLUMNS)} AS combined_text FROM patchy"""
)
def combined_text(spark, sf):
    return O.build_records(patchy_orders(spark, sf), PATCHY_COLUMNS).select("row_number", "combined_text")


@query(
    f"""WITH {PATCHY_SQL} SELECT row_number, {sql_statement(PATCHY_COLUMNS)} AS statement,
         {sql_statement(['o_orderstatus', 'o_orderpriority'])} AS sparse_statement FROM patchy"""
)
def template_statement(spark, sf):
    rows = patchy_orders(spark, sf)
    return rows.select(
        "row_number",
        X.template_statement(X.field_texts(rows, PATCHY_COLUMNS)).alias("statement"),
        X.template_statement(X.field_texts(rows, ["o_orderstatus", "o_orderpriority"])).alias("sparse_statement"),
    )


@query(
    f"""WITH {PATCHY_SQL} SELECT row_number, 'Data for orders row ' || row_number AS semantic_statement,
         {sql_structured(PATCHY_COLUMNS, 'empty')} AS combined_text FROM patchy"""
)
def fallback_statement(spark, sf):
    rows = patchy_orders(spark, sf)
    return rows.select(
        "row_number",
        X.fallback_statement(F.col("source_type"), F.col("row_number")).alias("semantic_statement"),
        X.structured_text(X.field_texts(rows, PATCHY_COLUMNS), "empty").alias("combined_text"),
    )


@query(
    f"""WITH {PATCHY_SQL} SELECT row_number,
         CASE WHEN o_totalprice IS NULL THEN 'Error: no total for order ' || o_orderkey
              ELSE {sql_statement(PATCHY_COLUMNS)} END AS semantic_statement FROM patchy"""
)
def error_statement(spark, sf):
    rows = O.build_records(patchy_orders(spark, sf), PATCHY_COLUMNS)
    data = F.col("json_data")
    message = F.concat(F.lit("no total for order "), F.element_at(data, "o_orderkey"))
    lost = F.element_at(data, "o_totalprice").isNull()
    return rows.select(
        "row_number",
        F.when(lost, X.error_statement(message)).otherwise(F.col("semantic_statement")).alias("semantic_statement"),
    )


_ID_SQL = f"""WITH {sql_entities()} SELECT source_type, row_number,
         CASE WHEN source_type = 'Equipment' THEN json_extract_string(json_data, 'Equipment_ID')
              WHEN source_type = 'Functional_Locations' THEN json_extract_string(json_data, 'FL_ID')
              WHEN source_type = 'Materials' THEN {{part}} || json_extract_string(json_data, 'Material_ID')
              ELSE {{rest}} END AS id FROM entities"""


@query(_ID_SQL.format(part="'unknown_'", rest="'row_' || row_number"))
def record_ids(spark, sf):
    rows = entity_records(spark, sf)
    return rows.select(
        "source_type", "row_number", R.record_id(F.col("json_data"), R.row_label(F.col("row_number"))).alias("id")
    )


@query(_ID_SQL.format(part="''", rest="'row_' || row_number"))
def record_ids_bare_part(spark, sf):
    rows = entity_records(spark, sf)
    chosen = R.record_id(F.col("json_data"), R.row_label(F.col("row_number")), unknown_owner=None)
    return rows.select("source_type", "row_number", chosen.alias("id"))


@query(
    _ID_SQL.format(
        part="'UNK_'", rest="'record_' || (row_number() OVER (ORDER BY source_file, row_number) - 1)"
    )
)
def record_ids_by_ordinal(spark, sf):
    rows = O.with_ordinal(entity_records(spark, sf))
    chosen = R.record_id(F.col("json_data"), R.ordinal_label(F.col("ordinal")), unknown_owner="UNK")
    return rows.select("source_type", "row_number", chosen.alias("id"))


@query(
    f"""WITH {sql_entities()} SELECT source_type, row_number,
         CASE WHEN source_type IN ('Equipment', 'Work_Orders') THEN json_extract_string(json_data, 'Criticality')
              ELSE 'N/A' END AS criticality FROM entities"""
)
def default_field(spark, sf):
    return entity_records(spark, sf).select(
        "source_type", "row_number", R.map_default(F.col("json_data"), "Criticality").alias("criticality")
    )


@query(
    """SELECT 'region.parquet' AS source_file, 'region' AS source_type, count(*) AS records FROM region
       UNION ALL SELECT 'nation.parquet', 'nation', count(*) FROM nation
       UNION ALL SELECT 'supplier.parquet', 'supplier', count(*) FROM supplier"""
)
def lineage_columns(spark, sf):
    parts = [table(spark, sf, n).select("source_file") for n in ("region", "nation", "supplier")]
    kind = R.source_type_of(F.regexp_replace("source_file", r"\.parquet$", "_processed.json"))
    return O.union_records(parts).groupBy("source_file", kind.alias("source_type")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    f"""WITH {sql_entities()} SELECT
         CASE WHEN source_type = 'Equipment' THEN json_extract_string(json_data, 'Equipment_ID')
              WHEN source_type = 'Functional_Locations' THEN json_extract_string(json_data, 'FL_ID')
              WHEN source_type = 'Materials' THEN 'unknown_' || json_extract_string(json_data, 'Material_ID')
              ELSE 'row_' || row_number END AS id, source_type AS type, source_file, row_number,
         CASE WHEN source_type IN ('Equipment', 'Work_Orders') THEN json_extract_string(json_data, 'Criticality')
              ELSE 'N/A' END AS criticality, json_data FROM entities"""
)
def metadata_projection(spark, sf):
    rows = O.with_metadata(entity_records(spark, sf)).drop("semantic_statement")
    return rows.withColumn("json_data", X.json_text(F.col("json_data")))


@query("SELECT doc_id, CAST(floor(length(text) / 4) AS BIGINT) AS tokens FROM documents")
def token_estimates(spark, sf):
    return plain(spark, sf, "documents").select("doc_id", P.token_estimate(F.col("text")).alias("tokens"))


@query("SELECT conv_id, turn, substr(text, 1, 100) || '...' AS shown FROM conversations")
def shortened_statement(spark, sf):
    return plain(spark, sf, "conversations").select("conv_id", "turn", X.shortened(F.col("text")).alias("shown"))


@query(
    f"""WITH {PATCHY_SQL} SELECT row_number, 'Describe this row: ' || chr(10) || {sql_json(PATCHY_COLUMNS)} || chr(10)
         || 'End.' AS prompt FROM patchy"""
)
def single_prompts(spark, sf):
    rows = O.build_records(patchy_orders(spark, sf), PATCHY_COLUMNS)
    return rows.select("row_number", single_prompt(F.col("json_data"), "Describe this row: ", "\nEnd.").alias("prompt"))


@query(
    """SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'material' WHEN p_type = 'PROMO' THEN 'vendor' END AS kind
       FROM part"""
)
def id_prefix_kinds(spark, sf):
    prefix = F.when(F.col("p_type").isin("SMALL", "LARGE"), "MAT-").when(F.col("p_type") == "PROMO", "V-").otherwise("PO-")
    return plain(spark, sf, "part").select(
        "p_partkey", R.id_kind(F.concat(prefix, F.col("p_partkey").cast("string"))).alias("kind")
    )


_DISPLAY_SQL = f"""WITH {sql_entities()} SELECT source_type, row_number,
         CASE source_type
           WHEN 'Equipment' THEN 'Name: ' || json_extract_string(json_data, 'Equipment_Name')
             || ' | Manufacturer: N/A | Model: N/A | Power: ' || json_extract_string(json_data, 'Nameplate_Power_kW') || ' kW'
             || ' | Location: ' || json_extract_string(json_data, 'FL_ID')
           WHEN 'Functional_Locations' THEN 'Name: ' || json_extract_string(json_data, 'FL_Name')
             || ' | Site: ' || json_extract_string(json_data, 'Site_Area') || ' | Parent: N/A'
           ELSE '' END AS shown FROM entities
       UNION ALL SELECT 'Equipment_Material', o_orderkey, 'Equipment: ' || o_custkey || ' | Material: ' || o_orderstatus
         || ' | Quantity: N/A | Notes: ' || o_orderpriority FROM orders"""


@query(_DISPLAY_SQL)
def display_fields(spark, sf):
    from recordloom.functions.display import display_text

    orders = plain(spark, sf, "orders")
    links = F.create_map(
        F.lit("Equipment_ID"),
        F.col("o_custkey").cast("string"),
        F.lit("Material_ID"),
        F.col("o_orderstatus"),
        F.lit("Notes"),
        F.col("o_orderpriority"),
    )
    linked = orders.select(
        F.lit("Equipment_Material").alias("source_type"), F.col("o_orderkey").alias("row_number"), links.alias("json_data")
    )
    rows = entity_records(spark, sf).select("source_type", "row_number", "json_data").unionByName(linked)
    return rows.select(
        "source_type", "row_number", display_text(F.col("source_type"), F.col("json_data")).alias("shown")
    )


@query(
    f"""WITH {sql_entities()} SELECT source_type, source_file, row_number, json_data, semantic_statement,
         semantic_statement || ' | ' || structured_text AS combined_text FROM entities"""
)
def record_union(spark, sf):
    return entity_records(spark, sf).withColumn("json_data", X.json_text(F.col("json_data")))


@query(
    f"""WITH {sql_entities()} SELECT row_number, json_data FROM entities WHERE source_type = 'Equipment'"""
)
def type_filter(spark, sf):
    rows = entity_records(spark, sf).filter(F.col("source_type") == "Equipment")
    return rows.select("row_number", X.json_text(F.col("json_data")).alias("json_data"))


@query(
    f"""WITH {PATCHY_SQL} SELECT row_number, CAST(json_merge_patch('{{}}', json_object(
         'o_orderkey', CAST(o_orderkey AS VARCHAR), 'o_orderstatus', o_orderstatus,
         'o_totalprice', CAST(o_totalprice AS VARCHAR),
         'o_orderpriority', nullif(nullif(o_orderpriority, ''), 'null'))) AS VARCHAR) AS usable FROM patchy"""
)
def null_literal_filter(spark, sf):
    rows = O.build_records(patchy_orders(spark, sf), PATCHY_COLUMNS)
    usable = F.map_filter("json_data", lambda k, v: (v != "") & (v != "null"))
    return rows.select("row_number", X.json_text(usable).alias("usable"))


@query(
    f"""WITH {PATCHY_SQL} SELECT count(*) AS records, count(*) FILTER (WHERE o_totalprice IS NOT NULL) AS valid,
         count(*) FILTER (WHERE o_totalprice IS NULL) AS invalid FROM patchy"""
)
def valid_statements(spark, sf):
    checked = error_statement(spark, sf).select(is_valid_statement(F.col("semantic_statement")).alias("valid"))
    return checked.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if("valid").alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
    )


@query(
    """SELECT vec_id, label, CASE WHEN label >= 4 THEN 'x' END AS tag, row_number() OVER (ORDER BY vec_id) AS row_number
       FROM embeddings QUALIFY row_number <= 5"""
)
def head_sample(spark, sf):
    from recordloom.sources.delimited import preview

    return preview(table(spark, sf, "embeddings")).select(
        "vec_id", "label", F.when(F.col("label") >= 4, "x").alias("tag"), "row_number"
    )


@query(
    """SELECT page_id, array_to_string(string_split(url, '/')[1:3], '/') AS start FROM pages"""
)
def first_elements(spark, sf):
    return plain(spark, sf, "pages").select(
        "page_id", F.array_join(F.slice(F.split("url", "/"), 1, 3), "/").alias("start")
    )


@query(
    f"""WITH {sql_entities()} SELECT source_type, source_file, row_number, semantic_statement FROM entities
        WHERE source_type = 'Equipment' AND row_number > 700
        UNION ALL SELECT source_type, source_file, row_number, 'kept' FROM entities
        WHERE source_type = 'Equipment' AND row_number <= 700"""
)
def resume_offset(spark, sf):
    rows = O.build_records(entity(spark, sf, "Equipment")).select(
        "source_type", "source_file", "row_number", "semantic_statement"
    )
    prior = rows.filter(F.col("row_number") <= 700).withColumn("semantic_statement", F.lit("kept"))
    return O.resumed(rows, 700, prior)


@query(
    """SELECT row_number, o_orderkey FROM (SELECT row_number() OVER (ORDER BY o_orderkey) AS row_number, * FROM orders)
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def remaining_rows(spark, sf):
    rows = table(spark, sf, "orders").select("row_number", "o_orderkey")
    done = plain(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return O.remaining(rows, done, ["o_orderkey"])


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) AS row_number, event_type FROM events ORDER BY row_number")
def row_order_restored(spark, sf):
    """Rows brought back into file order after work that shuffled them."""
    shuffled = table(spark, sf, "events").select("event_id", "row_number", "event_type").repartition("event_type")
    return shuffled.orderBy("row_number")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_links(spark, sf):
    from recordloom.operators.mapping import links

    return links(plain(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


def _numbered_sql(name: str) -> str:
    return f"row_number() OVER (ORDER BY {ORDER_KEYS[name]})"


_ALL_SQL = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS source_type, {_numbered_sql(n)} AS row_number, "
    f"md5({sql_statement(c)} || ' | ' || {sql_structured(c)}) AS text_md5 FROM {n}"
    for n, c in COLUMNS.items()
)


@query(_ALL_SQL)
def all_table_records(spark, sf):
    rows = O.union_records([O.build_records(table(spark, sf, n)) for n in COLUMNS])
    return rows.select("source_type", "row_number", F.md5("combined_text").alias("text_md5"))
