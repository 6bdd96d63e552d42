"""Run registered queries and their SQL side by side: ``python tests/oracle_check.py <folder> [names]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def normal(value):
    if value is None:
        return "∅"
    if isinstance(value, float):
        return "∅" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def compare(columns, spark_rows, sql_columns, sql_rows) -> str | None:
    if sorted(columns) != sorted(sql_columns):
        return f"columns {sorted(columns)} != {sorted(sql_columns)}"
    order = sorted(columns)
    a_at, b_at = [columns.index(c) for c in order], [sql_columns.index(c) for c in order]
    a = sorted(tuple(normal(r[i]) for i in a_at) for r in spark_rows)
    b = sorted(tuple(normal(r[i]) for i in b_at) for r in sql_rows)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return "\n   " + str(dict(zip(order, x)))[:600] + "\n   " + str(dict(zip(order, y)))[:600]
    return None


def kinds(spark_types, sql_types, columns, sql_columns):
    """Columns whose type family differs between the two sides."""
    family = lambda t: (
        "float" if t.lower() in ("double", "float") else "int" if "int" in t.lower() else "text" if t.lower() in ("string", "varchar") else t.lower()
    )
    sql = dict(zip(sql_columns, sql_types))
    return [(c, t, sql[c]) for c, t in zip(columns, spark_types) if c in sql and family(t) != family(sql[c])]


def check(spark, con, name, folder, queries, oracles):
    start = time.time()
    df = queries[name](spark, folder)
    rows = df.collect()
    took = time.time() - start
    if name not in oracles:
        return took, len(rows), None, True
    cur = con.execute(oracles[name])
    sql_columns = [d[0] for d in cur.description]
    sql_types = [str(d[1]) for d in cur.description]
    problem = compare(df.columns, rows, sql_columns, cur.fetchall())
    if problem is None:
        odd = kinds([t for _, t in df.dtypes], sql_types, df.columns, sql_columns)
        if odd:
            problem = f"types {odd}"
    return took, len(rows), problem, False


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in wanted or qs:
        try:
            took, n, problem, bare = check(spark, con, name, folder, qs, sqls)
            state = "rows" if bare else "ok" if problem is None else "DIFF"
        except Exception as e:  # noqa: BLE001
            took, n, problem, state = 0, 0, str(e)[:900], "FAIL"
        bad += state in ("DIFF", "FAIL")
        print(f"{state:5} {name:32} {n:8} rows {took:6.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
