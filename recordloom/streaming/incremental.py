"""New files of a folder into record tables, each exactly once, surviving restarts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.records import file_name_of, source_type_of
from recordloom.sources.delimited import folder_files, read_files

Build = Callable[[DataFrame], DataFrame]


def ingest(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | Mapping[str, T.StructType] | None,
    build: Build,
    output: str,
    checkpoint: str,
    file_format: str = "csv",
    pattern: str = "*.csv",
    max_files_per_trigger: int = 1000,
    multi_line: bool | None = None,
    entity_pattern: str | None = None,
) -> None:
    """Process the files that arrived since the last call, then stop.

    ``build`` maps a table of new rows (cells, ``source_file``, ``source_type``,
    ``row_number``) to rows with a ``status`` column. Rows go to ``<output>/ok`` and
    ``<output>/failed`` under their micro-batch number, which is overwritten when a
    batch is replayed, so a restart neither loses nor doubles a row.

    Delimited files are only found by the stream and read by the reader of batch runs,
    so types, missing-value tokens and line breaks inside quotes come out alike.
    ``schema`` may then be one schema per entity (file stem) or None; ``build`` sees one
    entity at a time. Many files of one entity are best named alike: those that match
    ``entity_pattern`` are read together. Files that cannot be read go to ``<output>/unreadable``.
    """
    stream = spark.readStream.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files_per_trigger)
    if file_format == "parquet":
        found = stream.format("parquet").schema(schema).load(folder).select(
            "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_index")
        )
    else:
        listing = "path string, modificationTime timestamp, length bigint, content binary"
        found = stream.format("binaryFile").schema(listing).load(folder).select("path")

    def write(rows: DataFrame, number: int) -> None:
        rows.persist()
        try:
            for kind, wanted in (("ok", F.col("status") != "failed"), ("failed", F.col("status") == "failed")):
                rows.filter(wanted).write.mode("overwrite").parquet(f"{output}/{kind}/batch={number}")
        finally:
            rows.unpersist()

    def write_parquet(batch: DataFrame, number: int) -> None:
        name = file_name_of(F.col("_path"))
        numbered = batch.withColumn("row_number", F.col("_index") + 1).withColumn("source_file", name)
        write(build(numbered.withColumn("source_type", source_type_of(name)).drop("_path", "_index")), number)

    def write_delimited(batch: DataFrame, number: int) -> None:
        # At most max_files_per_trigger paths.
        files = folder_files(batch.select("path", file_name_of(F.col("path")).alias("file_name")), entity_pattern)
        schemas = schema if isinstance(schema, Mapping) else {key: schema for key in files}
        errors: dict[str, str] = {}
        tables = read_files(spark, files, True, schemas, multi_line, errors)
        if errors:
            lost = spark.createDataFrame(sorted(errors.items()), "source_file string, error_message string")
            lost.write.mode("overwrite").parquet(f"{output}/unreadable/batch={number}")
        if tables:
            built = [build(table.drop("source_dir")) for table in tables.values()]
            write(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), built), number)

    query = (
        found.writeStream.foreachBatch(write_parquet if file_format == "parquet" else write_delimited)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingested(spark: SparkSession, output: str, kind: str = "ok") -> DataFrame:
    """Everything ingested so far."""
    return spark.read.parquet(f"{output}/{kind}")


def unprocessed_files(files: DataFrame, manifest: DataFrame, key: str = "source_file") -> DataFrame:
    """Batch form of the same idea: files without an entry in the manifest of earlier runs."""
    return files.join(manifest.select(key).distinct(), key, "left_anti")
