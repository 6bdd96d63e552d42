"""The benchmark tables under the names and headers of the record domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.constants import FIELD_SEPARATOR
from recordloom.operators.records import build_records, rename_headers, union_records
from recordloom.sources.columnar import read_table

# --- fixed values: columns of the text-bearing benchmark tables, in file order ---
COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
ORDER_KEYS = {t: c[0] for t, c in COLUMNS.items()} | {
    "conversations": "conv_id, turn",
    # Lines lie in no order that SQL could number them by, and vectors have no one text.
    "lineitem": "l_orderkey, l_linenumber",
    "embeddings": "vec_id",
}

# --- fixed values: entity type → (table, header of each column) ---
ENTITIES = {
    "Equipment": (
        "customer",
        {
            "c_custkey": "Equipment_ID",
            "c_name": "Equipment_Name",
            "c_nationkey": "FL_ID",
            "c_acctbal": "Nameplate_Power_kW",
            "c_mktsegment": "Criticality",
        },
    ),
    "Functional_Locations": (
        "nation",
        {"n_nationkey": "FL_ID", "n_name": "FL_Name", "n_regionkey": "Site_Area"},
    ),
    "Materials": (
        "part",
        {
            "p_partkey": "Material_ID",
            "p_name": "Material_Name",
            "p_brand": "Manufacturer",
            "p_type": "Class",
            "p_size": "Min_Level",
            "p_retailprice": "Unit_Price",
        },
    ),
    "Vendors": (
        "supplier",
        {"s_suppkey": "Vendor_ID", "s_name": "Vendor_Name", "s_nationkey": "Region", "s_acctbal": "Balance"},
    ),
    "Work_Orders": (
        "orders",
        {
            "o_orderkey": "WO_ID",
            "o_custkey": "Owner",
            "o_orderstatus": "Status",
            "o_totalprice": "Cost",
            "o_orderdate": "Start_Date",
            "o_orderpriority": "Criticality",
        },
    ),
}


_READ: dict[tuple[str, str, str, bool | None], DataFrame] = {}


def _read(spark: SparkSession, folder: str, name: str, numbered: bool | None) -> DataFrame:
    """The benchmark files do not change, so their schemas are looked up once per session."""
    key = (spark.sparkContext.applicationId, folder, name, numbered)
    if key not in _READ:
        path = f"{folder}/{name}.parquet"
        _READ[key] = spark.read.parquet(path) if numbered is None else read_table(spark, path, name, numbered)
    return _READ[key]


def table(spark: SparkSession, folder: str, name: str, numbered: bool = True) -> DataFrame:
    return _read(spark, folder, name, numbered)


def plain(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _read(spark, folder, name, None)


def patchy_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with missing, blank and literal-``null`` cells made from their own values."""
    orders = table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "null")
        .otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"),
        "source_file",
        "source_type",
        "row_number",
    )


PATCHY_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
PATCHY_SQL = """patchy AS (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS o_totalprice,
         CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '4-NOT SPECIFIED' THEN 'null'
              ELSE o_orderpriority END AS o_orderpriority,
         'orders.parquet' AS source_file,
         row_number() OVER (ORDER BY o_orderkey) AS row_number
  FROM orders)"""


def entity(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """A benchmark table under the headers of its entity type."""
    name, headers = ENTITIES[kind]
    renamed = rename_headers(table(spark, folder, name), headers)
    return renamed.withColumn("source_type", F.lit(kind)).withColumn("source_file", F.lit(f"{kind}.csv"))


def entity_records(spark: SparkSession, folder: str) -> DataFrame:
    return union_records([build_records(entity(spark, folder, k)) for k in ENTITIES])


# ------------------------------------------------------------------ SQL counterparts


def sql_structured(columns, skip: str = "null", alias=None) -> str:
    """Structured text of columns, or of ``{column: header}`` in ``alias``."""
    pairs = []
    for c in columns:
        text = f"CAST({c} AS VARCHAR)"
        if skip == "empty":
            text = f"nullif({text}, '')"
        if skip == "none":
            text = f"coalesce({text}, 'None')"
        pairs.append(f"'{(alias or {}).get(c, c)}: ' || {text}")
    return f"concat_ws('{FIELD_SEPARATOR}', {', '.join(pairs)})"


def sql_statement(columns, alias=None) -> str:
    """Template statement of columns."""
    phrases = ", ".join(
        f"CASE WHEN CAST({c} AS VARCHAR) <> '' AND CAST({c} AS VARCHAR) <> 'null' "
        f"THEN '{(alias or {}).get(c, c)} is ' || CAST({c} AS VARCHAR) END"
        for c in columns
    )
    usable = f"list_filter([{phrases}], lambda p: p IS NOT NULL)"
    return (
        f"CASE WHEN len({usable}) > 0 THEN 'Record with ' || array_to_string({usable}[1:3], ', ') || '...' "
        "ELSE 'Record' END"
    )


def sql_json(columns, alias=None) -> str:
    """Text-valued JSON object of columns."""
    pairs = ", ".join(f"'{(alias or {}).get(c, c)}', CAST({c} AS VARCHAR)" for c in columns)
    return f"CAST(json_object({pairs}) AS VARCHAR)"


def sql_entities(select: str = "") -> str:
    """``WITH``-ready CTE ``entities`` of all entity records."""
    parts = []
    for kind, (name, headers) in ENTITIES.items():
        cols = list(headers)
        statement, text = sql_statement(cols, headers), sql_structured(cols, alias=headers)
        parts.append(
            f"SELECT '{kind}' AS source_type, '{kind}.csv' AS source_file, "
            f"row_number() OVER (ORDER BY {ORDER_KEYS[name]}) AS row_number, "
            f"{sql_json(cols, headers)} AS json_data, {statement} AS semantic_statement, {text} AS structured_text "
            f"FROM {name}"
        )
    return "entities AS (\n" + "\nUNION ALL\n".join(parts) + ")"
