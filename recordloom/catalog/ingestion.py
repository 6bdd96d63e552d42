"""Incremental ingestion of the event table."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.catalog.registry import query
from recordloom.catalog.tables import COLUMNS, plain, sql_statement, sql_structured
from recordloom.operators.records import build_records
from recordloom.operators.skew import lookup_join
from recordloom.session import fresh_folder
from recordloom.streaming.incremental import ingest, ingested

EVENTS = COLUMNS["events"]
# The name of a table's files in the inbox.
PART_NAME = r"(\w+)-\d+\.csv"


def _judged(batch):
    """Records of a micro-batch; events of type error with a high value fail."""
    records = build_records(batch, EVENTS)
    data = F.col("json_data")
    lost = (F.element_at(data, "event_type") == "error") & (F.element_at(data, "value").cast("double") > 10)
    return records.withColumn("status", F.when(lost, "failed").otherwise("ok")).drop("json_data")


def _ingest(spark, sf):
    folder = fresh_folder(spark, "ingest")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    ingest(spark, sf, schema, _judged, f"{folder}/out", f"{folder}/progress", "parquet", "events.parquet")
    return f"{folder}/out"


@query(
    f"""SELECT 'events.parquet' AS source_file, row_number() OVER (ORDER BY event_id) AS row_number,
         {sql_statement(EVENTS)} AS semantic_statement, {sql_statement(EVENTS)} || ' | ' || {sql_structured(EVENTS)} AS combined_text,
         CASE WHEN event_type = 'error' AND value > 10 THEN 'failed' ELSE 'ok' END AS status FROM events"""
)
def incremental_ingest(spark, sf):
    output = _ingest(spark, sf)
    rows = ingested(spark, output).unionByName(ingested(spark, output, "failed"))
    return rows.select("source_file", "row_number", "semantic_statement", "combined_text", "status")


@query(
    """SELECT CASE WHEN event_type = 'error' AND value > 10 THEN 'failed' ELSE 'ok' END AS status, count(*) AS records
       FROM events GROUP BY 1"""
)
def incremental_split(spark, sf):
    output = _ingest(spark, sf)
    parts = [ingested(spark, output, kind).groupBy("status").agg(F.count(F.lit(1)).alias("records")) for kind in ("ok", "failed")]
    return parts[0].unionByName(parts[1])


@query(
    """WITH rows AS (
         SELECT 'customer.csv' AS source_file, row_number() OVER (ORDER BY c_custkey) AS row_number, c_custkey AS number,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS note FROM customer
         UNION ALL SELECT 'conversations.csv', row_number() OVER (ORDER BY conv_id, turn), conv_id, text FROM conversations
         UNION ALL SELECT 'more.csv', row_number() OVER (ORDER BY s_suppkey), s_suppkey, s_name FROM supplier)
       SELECT *, CASE WHEN source_file = 'more.csv' THEN 1 ELSE 0 END AS run FROM rows
       UNION ALL SELECT 'broken.csv', 0, 0, NULL, 0"""
)
def incremental_csv(spark, sf):
    """Tables in many files each, one file without a header, taken in by two runs, the second of which adds a table.

    Spark writes a file per partition, in the order of the rows; numbers per file become
    numbers per table by the sizes of the files before.
    """
    base = fresh_folder(spark, "inbox")
    rows = {
        "customer": plain(spark, sf, "customer").select(
            "c_custkey",
            F.col("c_custkey").alias("number"),
            F.when(F.col("c_mktsegment") == "BUILDING", "N/A").otherwise(F.col("c_mktsegment")).alias("note"),
        ),
        "conversations": plain(spark, sf, "conversations").select(
            "conv_id", "turn", F.col("conv_id").alias("number"), F.col("text").alias("note")
        ),
        "more": plain(spark, sf, "supplier").select("s_suppkey", F.col("s_suppkey").alias("number"), F.col("s_name").alias("note")),
    }
    runs = (["customer", "conversations"], ["more"])
    for number, names in enumerate(runs):
        for name in names:
            keys = [c for c in rows[name].columns if c not in ("number", "note")]
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            staged = f"{base}/staged/{name}"
            ordered = rows[name].repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop(*keys)
            ordered.write.options(header=True, escape='"', quote='"').csv(staged)
            place_parts(spark, staged, f"{base}/inbox", name)
        if not number:
            place_blank(spark, f"{base}/inbox/broken.csv")
        ingest(
            spark,
            f"{base}/inbox",
            None,
            lambda table, run=number: table.withColumn("status", F.lit("ok")).withColumn("run", F.lit(run)),
            f"{base}/out",
            f"{base}/progress",
            entity_pattern=PART_NAME,
        )
    done = ingested(spark, f"{base}/out").withColumn("entity", F.regexp_extract("source_file", PART_NAME, 1))
    # One row per file.
    sizes = done.groupBy("entity", "source_file").agg(F.count(F.lit(1)).alias("rows"))
    before = W.partitionBy("entity").orderBy("source_file").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("source_file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    done = lookup_join(done, starts, ["source_file"], "inner").select(
        F.concat("entity", F.lit(".csv")).alias("source_file"),
        (F.col("start") + F.col("row_number")).alias("row_number"),
        F.col("number").cast("bigint"),
        "note",
        "run",
    )
    lost = ingested(spark, f"{base}/out", "unreadable").select(
        "source_file",
        F.lit(0).cast("bigint").alias("row_number"),
        F.lit(0).cast("bigint").alias("number"),
        F.lit(None).cast("string").alias("note"),
        F.lit(0).alias("run"),
    )
    return done.unionByName(lost)


def place_parts(spark, written: str, folder: str, name: str) -> None:
    """The part files of a written table as ``<name>-<number>.csv``, in their order."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(written), hadoop.Path(folder)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    found = {f.getPath().getName(): f.getPath() for f in files.listStatus(source)}
    for k, part in enumerate(sorted(n for n in found if n.startswith("part-"))):
        files.rename(found[part], hadoop.Path(target, f"{name}-{k:05}.csv"))


def place_blank(spark, path: str) -> None:
    """A file of one empty line."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    out = files.create(target)
    out.write(10)
    out.close()
