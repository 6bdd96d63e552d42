"""Blocked Bloom filters: a key has four bits in one block of 64."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE, SIX_BITS = np.uint64(1), np.uint64(63)
SHIFTS = (0, 6, 12, 18)
# Blocks of a filter of fixed size, as a power of two: 8 MB.
LEVEL = 20


def bits_of(keys: np.ndarray) -> np.ndarray:
    """The four bits of a key within its block; the block is that of the upper half."""
    out = np.zeros(len(keys), np.uint64)
    for shift in SHIFTS:
        out |= ONE << ((keys >> np.uint64(shift)) & SIX_BITS)
    return out


def blocks_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def key_of(column: str) -> Column:
    return F.xxhash64(column)


def fixed_filter(rows: DataFrame, column: str) -> np.ndarray:
    """The blocks of a filter over ``key_of`` a column, of the same size for any number of rows.

    The bits are brought together by an aggregate, so the driver gets a row per block at
    most. With more rows than some ten million it lets more and more keys pass.
    """
    masks = " | ".join(f"shiftleft(1L, cast(shiftright(key, {s}) & 63 as int))" for s in SHIFTS)
    block = F.shiftrightunsigned("key", 64 - LEVEL).alias("block")
    set_bits = rows.select(key_of(column).alias("key")).select(block, F.expr(masks).alias("mask"))
    found = set_bits.groupBy("block").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << LEVEL, np.uint64)
    out[found["block"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def passed(blocks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True for all keys that the filter holds and for few others."""
    bits = bits_of(keys)
    return (blocks[blocks_of(keys, len(blocks))] & bits) == bits
