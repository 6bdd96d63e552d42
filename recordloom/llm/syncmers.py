"""Operator 5: document fingerprints of closed syncmers.

A run of ``K`` characters is a closed syncmer if its smallest inner run of ``S`` characters
(by hash; the leftmost or rightmost of equal ones) is its first or its last. Whether a run
is one depends on nothing around it, so an edit moves no anchor outside the edited place.
A fingerprint lists the smallest hashes of the anchors, each with the place where it first
occurs: all of them up to ``SIZE``, beyond that ``SIZE`` and one more for every ``STEP``
anchors, so that a long text has an anchor every few hundred characters. Two fingerprints
are compared by the smallest hashes that both lists are sure to cover; common anchors count
along the longest chain in which their places rise in both texts, so that text put in or
taken out between them costs nothing else. The share of common anchors, as an estimate of
twice the common part over both texts, is the likeness.

Null texts are empty; two texts without characters have likeness 1, and one of them has
likeness 0 with any other. A text of fewer than ``K`` characters has one anchor, itself.
The next document is the one with the next larger doc_id; equal doc_ids follow in the order
of their texts and null ones come last. A single document is its own next. Extra columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordloom.llm.common import by_arrow, partitions, small_batches, table, utf8, with_range

K, S, SIZE, STEP = 14, 6, 32, 64
FURTHEST = 0xFFFFFF


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def run_hashes(points: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` numbers, from those of runs of half the length."""
    base = 0x9E3779B97F4A7C15
    power, width = points, 1
    out, done = None, 0
    while True:
        if length & width:
            if out is None:
                out, done = power, width
            else:
                scale = np.uint64(pow(base, width, 1 << 64))
                n = len(points) - done - width + 1
                out, done = out[:n] * scale + power[done : done + n], done + width
        if 2 * width > length:
            return mix(out)
        scale = np.uint64(pow(base, width, 1 << 64))
        power, width = power[: len(power) - width] * scale + power[width:], 2 * width


def window_minima(values: np.ndarray, length: int) -> np.ndarray:
    out, width = values, 1
    while 2 * width <= length:
        out, width = np.minimum(out[:-width], out[width:]), 2 * width
    rest = length - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the closed syncmers of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(points) < K:
        return run_hashes(points, len(points))[:1], np.zeros(1, np.int64)
    inner = run_hashes(points, S)
    least = window_minima(inner, K - S + 1)
    places = np.flatnonzero((inner[: len(least)] == least) | (inner[K - S :] == least))
    return run_hashes(points, K)[places], places


def fingerprint(text: str) -> str:
    """Sixteen hexadecimal digits per anchor: ten of its hash, six of its place; ascending."""
    hashes, places = anchors(text)
    hashes, first = np.unique(hashes >> np.uint64(24), return_index=True)
    size = SIZE + max(0, len(hashes) - SIZE) // STEP
    places = np.minimum(places[first[:size]], FURTHEST)
    return "".join(f"{h:010x}{p:06x}" for h, p in zip(hashes[:size].tolist(), places.tolist(), strict=True))


def _listed(print_: str) -> dict[str, int]:
    return {print_[i : i + 10]: int(print_[i + 10 : i + 16], 16) for i in range(0, len(print_), 16)}


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    one, two = _listed(a), _listed(b)
    if not one or not two:
        return 0.0
    # A list of fewer than SIZE anchors has them all.
    covered = min((len(x) for x in (one, two) if len(x) >= SIZE), default=len(one) + len(two))
    smallest = sorted(one.keys() | two.keys())[:covered]
    share = chain([(one[h], two[h]) for h in smallest if h in one and h in two]) / len(smallest)
    return 2 * share / (1 + share)


def chain(places: list[tuple[int, int]]) -> int:
    """The most pairs of places that rise in both texts."""
    ends: list[int] = []
    for _, place in sorted(places, key=lambda p: (p[0], -p[1])):
        at = bisect_left(ends, place)
        ends[at : at + 1] = [place]
    return len(ends)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the first as many characters of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def in_order(docs: DataFrame, n: int) -> DataFrame:
    """Rows (range, closing, doc_id, text) in ascending order within each task.

    A range of doc_ids is in one task, followed by a ``closing`` copy of the first row of the
    next range (of the first range after the last). Texts are exchanged once.
    """
    rows = with_range(docs.select("doc_id", utf8(F.col("text")).alias("text")), "doc_id", n)
    least = rows.groupBy("range").agg(F.min("doc_id").alias("first_id"))
    # One small row per range; ranges are as many as the caller asked for.
    heads = rows.join(F.broadcast(least.withColumnRenamed("range", "r")), F.col("range") == F.col("r"))
    heads = heads.where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    heads = heads.groupBy("range", "doc_id").agg(F.min("text").alias("text"))
    order = Window.orderBy("range")
    last = F.max("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select(F.coalesce(F.lag("range").over(order), last).alias("range"), "doc_id", "text")
    both = rows.select("range", F.lit(0).alias("closing"), "doc_id", "text").unionByName(
        heads.select("range", F.lit(1).alias("closing"), "doc_id", "text")
    )
    return both.repartition(n, "range").sortWithinPartitions(
        "range", "closing", F.col("doc_id").asc_nulls_last(), "text"
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint against those of its edited text and of the next document."""

    def run(batches) -> Iterator[list[tuple]]:
        held = None
        for batch in small_batches(batches):
            out = []
            for doc_id, text, closing in zip(batch["doc_id"], batch["text"], batch["closing"], strict=True):
                own = fingerprint(text)
                if held is not None:
                    before_id, before, before_print = held
                    changed = edited(before, text)
                    print_ = fingerprint(changed)
                    out.append(
                        (
                            before_id,
                            len(before),
                            hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                            before_print,
                            print_,
                            likeness(before_print, print_),
                            likeness(before_print, own),
                        )
                    )
                held = None if closing else (doc_id, text, own)
            yield out

    return by_arrow(in_order(docs, partitions(docs.sparkSession)), run, SCHEMA)


def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))
