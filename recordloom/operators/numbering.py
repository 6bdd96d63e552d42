"""Row numbers, batches and running totals without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Splits per broadcast offset table: about 100 bytes each, so 100 MB at the bound.
MAX_BROADCAST_SPLITS = 1_000_000


def with_scan_position(scan: DataFrame) -> DataFrame:
    """Tag each row of a file scan with its file, split and position.

    Call this directly on the scan: nothing may filter rows before the position
    is taken.
    """
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"),
    )


def numbered_by_split(
    positioned: DataFrame, file: str = "_path", max_splits: int | None = None
) -> DataFrame:
    """1-based ``row_number`` per ``file``, in file order, for a scan of splittable files.

    ``file`` may name several physical files, which then count on in name order.
    Each split is counted once (a column-pruned pass that shuffles one row per
    split); the running count of the earlier splits shifts every row's position.
    Rows themselves are never shuffled while the offsets, one row per split, are
    few enough to broadcast.
    """
    splits = positioned.groupBy(*{file: 0, "_path": 0}, "_block").agg(
        F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = W.partitionBy(file).orderBy("_path", "_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = splits.select(
        "_path", "_block", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    if max_splits is not None and max_splits <= MAX_BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    return (
        positioned.join(offsets, ["_path", "_block"])
        .withColumn("row_number", F.col("_position") + F.col("_shift"))
        .drop("_block", "_position", "_shift")
    )


def batch_id(row_number: Column, batch_size: Column | int) -> Column:
    """0-based number of the fixed-size batch a row falls into."""
    return F.floor((row_number - 1) / batch_size)


def batch_ranges(records: DataFrame, batch_size: int, group: Sequence[str] = ("source_file",)) -> DataFrame:
    """First row, last row and size of every batch."""
    return (
        records.withColumn("batch_id", batch_id(F.col("row_number"), batch_size))
        .groupBy(*group, "batch_id")
        .agg(
            F.min("row_number").alias("first_row"),
            F.max("row_number").alias("last_row"),
            F.count(F.lit(1)).alias("batch_rows"),
        )
    )


def running_total(
    df: DataFrame, value: str, order: str, group: Sequence[str], result: str, block_rows: int = 100_000
) -> DataFrame:
    """Inclusive running sum of ``value`` along the integer column ``order`` in each group.

    The order is cut into blocks of ``block_rows`` consecutive numbers. Sums per
    block are cumulated over one row per block, and each block is finished by a
    window of its own, so a group holding most rows still spreads over many tasks.
    """
    blocked = df.withColumn("_stretch", F.floor(F.col(order) / block_rows))
    sums = blocked.groupBy(*group, "_stretch").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*group).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*group, "_stretch", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*group, "_stretch").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        blocked.join(starts, [*group, "_stretch"])
        .withColumn(result, F.col("_start") + F.sum(value).over(inside))
        .drop("_stretch", "_start")
    )
