"""What the operators share: table access, stored intermediates, dealing rows by id."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spark's own bounds, 10,000 rows and 64 MB, are held in memory several times over by the JVM and each Python worker.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, deleted when the session ends.

    Only a local session may leave the setting unset; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/recordloom"
    folder = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bounded_batches(spark: SparkSession) -> None:
    """Batches for Python of ``BATCH_BYTES``, unless the session has a bound of its own."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)


def by_arrow(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[list[tuple]]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function that yields lists of row tuples."""
    from pyspark.sql.pandas.types import to_arrow_schema

    _bounded_batches(df.sparkSession)
    target = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in rows(batches):
            columns = zip(*out, strict=True) if out else [[] for _ in target]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, target, strict=True)], schema=target
            )

    return df.mapInArrow(run, schema)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[dict[str, list]]:
    """The batches in slices of few rows, as Python lists, so that long texts don't add up."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows).to_pydict()


def with_range(df: DataFrame, column: str, n: int, name: str = "range") -> DataFrame:
    """Adds the number (0 to n) of the range of ``column`` that a row lies in; nulls are in the last.

    The bounds are quantiles, so the ranges hold about as many rows each; equal values share one.
    """
    cuts = sorted(set(df.approxQuantile(column, [i / n for i in range(1, n)], 1 / (8 * n)))) if n > 1 else []
    value = f"{name}_value"
    valued = df.withColumn(value, F.col(column).cast("double"))
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        valued = Bucketizer(splits=splits, inputCol=value, outputCol=name, handleInvalid="keep").transform(valued)
    else:
        valued = valued.withColumn(name, F.when(F.col(value).isNotNull(), 0))
    return valued.drop(value).withColumn(name, F.coalesce(F.col(name), F.lit(len(cuts) + 1)).cast("int"))


def utf8(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))
