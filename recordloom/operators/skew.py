"""Nested lists that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Items of one list; longer lists are cut into chunks.
MAX_ITEMS = 10_000


def lookup_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Many-to-one join of ``facts`` with a ``lookup``.

    The facts are on the left, where adaptive execution splits the rows of a hot key;
    it also sends a lookup whole where the lookup turns out to be small.
    """
    return facts.join(lookup, list(on), how)


def item_chunk(item: Column, chunks: Column) -> Column:
    """Which of ``chunks`` lists an item lies in, by the MD5 of its text: ``chunk_sql`` says the same in SQL."""
    digits = F.substring(F.md5(item.cast("string")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), chunks)


def chunk_sql(item: str, size: str, max_items: int) -> str:
    return (
        f"CAST(('0x' || substr(md5(CAST({item} AS VARCHAR)), 1, 8)) AS BIGINT) "
        f"% greatest(1, CAST(ceil({size} / {float(max_items)}) AS BIGINT))"
    )


def nested_lists(
    rows: DataFrame,
    keys: Sequence[str],
    item: Column,
    result: str,
    dealt_by: Column,
    max_items: int | None = None,
    everyone: DataFrame | None = None,
    only_listed: bool = True,
) -> DataFrame:
    """One sorted list of ``item`` per key, cut into chunks where a key has more than ``max_items``.

    Ordinary keys give a single row with ``chunk`` 0. A longer list is dealt by the hash
    of ``dealt_by`` over ``ceil(size / max_items)`` rows of about that length, so no task
    and no row holds an unbounded group, and all items stay in the result. ``chunk`` is
    part of the result's key: whoever wants totals per key counts the flat rows.

    ``everyone``, unique by key, adds its other columns to the result and an empty
    list for keys without items, all in the same exchange; keys it does not list
    are dropped if ``only_listed``. An item-less key has ``chunk`` 0, and so has each
    listed key whose chunk 0 happens to be empty.
    """
    keys, most = list(keys), max_items or MAX_ITEMS
    oversized = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .filter(F.col("_size") > most)
        .select(*keys, F.ceil(F.col("_size") / most).alias("_chunks"))
    )
    items = lookup_join(rows, oversized, keys).select(
        *keys,
        item_chunk(dealt_by, F.coalesce("_chunks", F.lit(1)).cast("bigint")).alias("chunk"),
        item.alias("_item"),
    )
    gathered = F.sort_array(F.collect_list("_item")).alias(result)
    if everyone is None:
        return items.groupBy(*keys, "chunk").agg(gathered)
    # Listed keys join the exchange as rows without an item, one for each of their chunks.
    extra = [c for c in everyone.columns if c not in keys]
    last = F.coalesce("_chunks", F.lit(1)).cast("bigint") - 1
    listed = lookup_join(everyone, oversized, keys).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    marked = listed.drop("_chunks").withColumn("_listed", F.lit(True))
    grouped = (
        items.unionByName(marked, allowMissingColumns=True)
        .groupBy(*keys, "chunk")
        .agg(gathered, *[F.max(c).alias(c) for c in extra], F.max("_listed").alias("_listed"))
    )
    if only_listed:
        grouped = grouped.filter("_listed")
    return grouped.drop("_listed")
