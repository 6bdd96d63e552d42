"""Operator 7: SimHash near-dedup with a grid join over segment bit counts.

A fingerprint's segments of two bits are mapped to their bit counts. Two fingerprints that
differ in d bits have counts at a Manhattan distance of at most d, so the join over counts
loses no link. The counts form a grid with one cell side per group of segments: of six
groups, three are untouched if at most three bits differ, so links are found among the
fingerprints that agree on the counts of some three groups (twenty choices). Within a cell
the Manhattan distance is a lower bound that spares most pairs; the others are verified by
the differing bits. Equal fingerprints are one row from the start, and of a cell only the
links of a spanning forest leave the task, so that a group of copies costs rows in
proportion to its size. Cells past ``CELL`` rows are dealt to several tasks as pairs of
blocks. Components come from the links by repeated star contraction.

Near copies by sets (``deduplicated``) come from the same join over the counts, verified
by the sets of shingles. What differs in more bits and yet is similar follows exactly: the
cells are shingles, of a set of n the first ones in a common order, so many that sets of the
similarity are sure to share one. Wide prints only sort out what can't be similar; the rest
is decided by the sets themselves. Cells whose texts the first join has linked are left out.

Null and empty texts have the fingerprint zero and link like any other. Repeated rows and
ties share a component, whose id is its smallest doc_id; rows with a null doc_id get a
component id only through others. Extra columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordloom.llm.common import by_arrow, partitions, small_batches, stored, table, utf8

SEED = 42
CELL = 2048
WIDE = 4
# Sets below it are compared by parities. Bytes of sets that one side of a task holds.
SMALL, SET_BYTES = 300, 16_000_000
# Counters of how frequent shingles are, how many of them are in one row, and shingles that are counted at once.
COUNTERS, BLOCK, PENDING = 1 << 20, 1 << 14, 1 << 20
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Six groups of two-bit segments: 12, 10, 10, 12, 10 and 10 bits.
GROUPS = ((0, 12), (12, 22), (22, 32), (32, 44), (44, 54), (54, 64))
TRIPLES = tuple(combinations(range(6), 3))
PAIRS = np.uint64(0x5555555555555555)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each run of ``words`` words, repeats included; of all words if there are fewer."""
    found = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(b" ".join(found), SEED)], np.uint64)
    parts = zip(*(found[i:] for i in range(words)), strict=False)
    return np.fromiter((digest(b" ".join(p), SEED) for p in parts), np.uint64, len(found) - words + 1)


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65_536):
        part = hashes[start : start + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def mixed(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Other 64-bit hashes of the same shingles."""
    x = hashes + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and ``fp``, the fingerprint's bits as a long."""

    def run(batches) -> Iterator[list[tuple]]:
        for batch in small_batches(batches):
            yield [
                (d, signed(majority(shingle_hashes(t, words))))
                for d, t in zip(batch["doc_id"], batch["text"], strict=True)
            ]

    return by_arrow(docs.select("doc_id", utf8(F.col("text")).alias("text")), run, "doc_id long, fp long")


def counts(fps: np.ndarray) -> np.ndarray:
    """The bit counts of the 32 two-bit segments, two bits each in one 64-bit word."""
    return (fps & PAIRS) + ((fps >> np.uint64(1)) & PAIRS)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of counts, segment by segment; counts are 0, 1 or 2."""
    twos = np.uint64(0xAAAAAAAAAAAAAAAA)
    low = (a ^ b) & PAIRS
    high = (a ^ b) & twos
    # 0 and 2 differ in the high bit only and are 2 apart; 1 and 2 differ in both bits and are 1 apart.
    return (np.bitwise_count(low) + 2 * np.bitwise_count(high & ~(low << np.uint64(1)))).astype(np.int64)


def cells(fps: np.ndarray) -> np.ndarray:
    """A row of grid cells for each fingerprint: one for each choice of three groups of counts."""
    words = counts(fps)
    out = np.empty((len(fps), len(TRIPLES)), np.uint64)
    for k, triple in enumerate(TRIPLES):
        mask = 0
        for g in triple:
            low, high = GROUPS[g]
            mask |= ((1 << (high - low)) - 1) << low
        out[:, k] = mixed(words & np.uint64(mask), k + 1)
    return out


class Forest:
    """Union-find over the ids that one task meets."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up, root = self.up, x
        while (above := up.get(root, root)) != root:
            root = above
        while (above := up.get(x, x)) != root:
            up[x], x = root, above
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _cell_links(ids: np.ndarray, prints: np.ndarray, sides: np.ndarray, near: Callable, forest: Forest) -> list[tuple]:
    """Links of one cell: of all pairs (sides all 0), or of those between side 1 and side 2."""
    out = []
    left = np.flatnonzero(sides < 2)
    right = np.flatnonzero(sides != 1)
    for i in left:
        others = right[right > i] if sides[i] == 0 else right
        if not len(others):
            continue
        hits = others[near(prints[i], prints[others])]
        for j in hits:
            if forest.join(int(ids[i]), int(ids[j])):
                out.append((int(ids[i]), int(ids[j])))
    return out


def _dealt(rows: DataFrame, load: Column) -> DataFrame:
    """Rows (cell, id, print, a, b, side) in the order of (cell, a, b); cells of a ``load`` past 1 as pairs of blocks."""
    # Stored, so that the planner sees whether the large cells are few enough to broadcast.
    sizes = stored(rows.groupBy("cell").agg(F.ceil(load).cast("int").alias("blocks")).where("blocks > 1"))
    dealt = rows.join(sizes, "cell", "left")
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # A row of a large cell goes to the pairs of blocks that its own block is part of.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(F.col("mine"), other).alias("a"),
            F.greatest(F.col("mine"), other).alias("b"),
            F.when(F.col("mine") == other, 0).when(F.col("mine") < other, 1).otherwise(2).alias("side"),
        ),
    )
    one = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("side")))
    dealt = dealt.withColumn("mine", mine).select(
        "cell", "id", "print", F.inline(F.when(F.col("blocks").isNull(), one).otherwise(pairs))
    )
    return dealt.repartition(partitions(rows.sparkSession), "cell", "a", "b").sortWithinPartitions("cell", "a", "b")


def _loose_links(ids: np.ndarray, prints: np.ndarray, sides: np.ndarray, near: Callable, forest: Forest) -> list[tuple]:
    """As ``_cell_links``, but without comparing what the cell has linked already."""
    out = []
    label = np.arange(len(ids))
    left, right = np.flatnonzero(sides < 2), np.flatnonzero(sides != 1)
    for i in left:
        others = right[right > i] if sides[i] == 0 else right
        others = others[label[others] != label[i]]
        if not len(others):
            continue
        hits = others[near(prints[i], prints[others])]
        for j in hits:
            if forest.join(int(ids[i]), int(ids[j])):
                out.append((int(ids[i]), int(ids[j])))
        label[np.isin(label, label[hits])] = label[i]
    return out


def linked(
    rows: DataFrame, near: Callable[[np.ndarray, np.ndarray], np.ndarray], links: Callable = _cell_links
) -> DataFrame:
    """Links (a, b) of a spanning forest of the ids that share a cell and are ``near``.

    ``rows``: cell long, id long, print binary (unsigned 64-bit words). ``near`` compares the
    words of one row with those of many.
    """
    ordered = _dealt(rows, F.count(F.lit(1)) / CELL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        forest, rest = Forest(), None

        def groups(key, ids, prints, sides, last: bool):
            nonlocal rest
            ends = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
            bounds = [0, *ends.tolist(), len(ids)]
            if not last:  # the last group may go on in the next batch
                cut = bounds.pop()
                cut = bounds[-1]
                rest = key[cut:], ids[cut:], prints[cut:], sides[cut:]
            out, sizes_ = [], np.diff(bounds)
            starts = np.array(bounds[:-1], np.int64)
            two = starts[sizes_ == 2]
            if len(two):
                two = two[near(prints[two], prints[two + 1])]
                two = two[(sides[two] == 0) | (sides[two] != sides[two + 1])]
                for i in two:
                    a, b = int(ids[i]), int(ids[i + 1])
                    if forest.join(a, b):
                        out.append((a, b))
            for k in np.flatnonzero(sizes_ > 2):
                part = slice(bounds[k], bounds[k + 1])
                out.extend(links(ids[part], prints[part], sides[part], near, forest))
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(batch.column(2).to_pylist())
            prints = np.frombuffer(raw, np.uint64).reshape(batch.num_rows, -1)
            key = np.stack([batch.column(k).to_numpy() for k in (0, 3, 4)], axis=1)
            got = key, batch.column(1).to_numpy(), prints, batch.column(5).to_numpy()
            if rest is not None and len(rest[1]):
                got = tuple(np.concatenate(x) for x in zip(rest, got, strict=True))
            yield groups(*got, False)
        if rest is not None and len(rest[1]):
            yield groups(*rest, True)

    return by_arrow(ordered, run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for ids of the links (a, b) that have a smaller one.

    Large and small star steps alternate until every link leads to its component's smallest
    id; each round is stored, so a lost executor costs one round at most.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select("u", F.col("m").alias("v")).union(
            small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = stored(small.distinct())
        # Done when each id has one link and no id is both an end and a start.
        tops = edges.select(F.col("v").alias("u")).distinct()
        open_ = edges.join(tops, "u", "left_semi")
        if open_.isEmpty() and edges.groupBy("u").count().where("count > 1").isEmpty():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def within(radius: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Verifies at most ``radius`` differing bits; the distance of counts comes first."""

    def near(one: np.ndarray, many: np.ndarray) -> np.ndarray:
        one = np.broadcast_to(one, many.shape)
        out = manhattan(counts(one), counts(many)).sum(axis=1) <= radius
        maybe = np.flatnonzero(out)
        out[maybe] = np.bitwise_count(one[maybe] ^ many[maybe]).sum(axis=1, dtype=np.int64) <= radius
        return out

    return near


def near_groups(prints: DataFrame, radius: int = 3) -> DataFrame:
    """doc_id, fp and ``component_id`` of stored fingerprints; ``radius`` is 3 at most."""
    if radius > 3:
        raise ValueError("three of six groups are only sure to agree within three bits")
    distinct = stored(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            k = len(TRIPLES)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cells(fps).view(np.int64).reshape(-1)),
                    pa.array(np.repeat(batch.column(1).to_numpy(), k)),
                    pa.array([x for f in fps for x in [f.tobytes()] * k], pa.binary()),
                ],
                names=["cell", "id", "print"],
            )

    rows = distinct.select("fp", "id").mapInArrow(run, "cell long, id long, print binary")
    found = components(linked(rows, within(radius)))
    ids = distinct.join(found, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return prints.join(ids, "fp", "left")


def loose(similarity: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """True for all sets whose Jaccard similarity is reached, and for few others, by their wide prints.

    Sets of a and b shingles with that similarity share s / (1 + s) * (a + b) of them. The
    parities of two sets differ in at most as many bits as there are shingles in only one of
    them. The SimHashes of large sets, where parities fill up, differ by the angle; the slack
    is eight standard deviations and a part for ties.
    """
    bits = 64 * WIDE

    def near(one: np.ndarray, many: np.ndarray) -> np.ndarray:
        one = np.broadcast_to(one, many.shape)
        a, b = one[:, -1].astype(float), many[:, -1].astype(float)
        out = np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-6
        small = np.maximum(a, b) < SMALL
        maybe = np.flatnonzero(out & small)
        most = (1 - similarity) / (1 + similarity) * (a + b)[maybe] + 1e-6
        parity = slice(0, WIDE)
        out[maybe] = np.bitwise_count(one[maybe, parity] ^ many[maybe, parity]).sum(axis=1, dtype=np.int64) <= most
        maybe = np.flatnonzero(out & ~small)
        a, b = a[maybe], b[maybe]
        cosine = similarity / (1 + similarity) * (a + b) / np.sqrt(np.maximum(a * b, 1))
        share = np.minimum(np.arccos(np.minimum(cosine, 1)) / math.pi + 0.03, 0.5)
        most = bits * share + 8 * np.sqrt(bits * share * (1 - share))
        angle = slice(WIDE, 2 * WIDE)
        out[maybe] = np.bitwise_count(one[maybe, angle] ^ many[maybe, angle]).sum(axis=1, dtype=np.int64) <= most
        return out

    return near


def wide_print(hashes: np.ndarray, similarity: float) -> np.ndarray:
    """``WIDE`` words of the parities of a set's shingles by bucket, as many of its SimHash, and its size.

    A set too large or too small for a comparison that reads one of them has zeros there.
    """
    n = len(hashes)
    out = np.zeros(2 * WIDE + 1, np.uint64)
    if n < SMALL:
        odd = np.bincount((mixed(hashes, 500) % np.uint64(64 * WIDE)).astype(np.int64), minlength=64 * WIDE) & 1
        out[:WIDE] = np.packbits(odd.astype(np.uint8)).view(np.uint64)
    if n >= math.floor(similarity * SMALL) - 1:
        out[WIDE : 2 * WIDE] = [majority(mixed(hashes, k)) for k in range(WIDE)]
    out[-1] = n
    return out


def _set_links(ids: list[int], sets: list[np.ndarray], sides: np.ndarray, similarity: float, forest: Forest) -> list[tuple]:
    """Links of sets that reach the Jaccard similarity: all pairs (sides all 0), or side 1 with side 2."""
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(flat.max() + 1, bool)
    label = np.arange(len(ids))
    left, right = np.flatnonzero(sides < 2), np.flatnonzero(sides != 1)
    out = []
    for i in left:
        others = right[right > i] if sides[i] == 0 else right
        reach = np.minimum(sizes[others], sizes[i]) >= similarity * np.maximum(sizes[others], sizes[i]) - 1e-6
        others = others[reach & (label[others] != label[i])]
        if not len(others):
            continue
        mine = flat[ends[i] - sizes[i] : ends[i]]
        marked[mine] = True
        if 8 * len(others) < len(ids):
            common = np.array([np.count_nonzero(marked[flat[ends[j] - sizes[j] : ends[j]]]) for j in others])
        else:
            common = np.add.reduceat(marked[flat], ends - sizes, dtype=np.int64)[others]
        marked[mine] = False
        hits = others[common / (sizes[i] + sizes[others] - common) >= similarity]
        for j in hits:
            if forest.join(int(ids[i]), int(ids[j])):
                out.append((int(ids[i]), int(ids[j])))
        label[np.isin(label, label[hits])] = label[i]
    return out


def set_links(rows: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of a spanning forest of the ids that share a cell and whose sets reach the similarity.

    ``rows``: cell long, id long, print binary (the distinct shingles' hashes, none empty).
    """
    load = F.greatest(F.count(F.lit(1)) / CELL, F.sum(F.length("print")) / SET_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        forest, at = Forest(), None
        ids: list[int] = []
        sets: list[np.ndarray] = []
        sides: list[int] = []
        for batch in batches:
            out = []
            columns = [batch.column(k).to_pylist() for k in (0, 3, 4, 1, 2, 5)]
            for *key, id_, raw, side in zip(*columns, strict=True):
                if key != at:
                    if len(ids) > 1:
                        out.extend(_set_links(ids, sets, np.array(sides), similarity, forest))
                    at, ids, sets, sides = key, [], [], []
                ids.append(id_)
                sets.append(np.frombuffer(raw, np.uint64))
                sides.append(side)
            yield out
        if len(ids) > 1:
            yield _set_links(ids, sets, np.array(sides), similarity, forest)

    return by_arrow(_dealt(rows, load), run, "a long, b long")


def frequent(docs: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all rows of ``docs``, each once per row, fall on each of ``COUNTERS`` counters.

    They only set the order of shingles, so that a passage of many texts makes few cells.
    """

    def run(batches) -> Iterator[list[tuple]]:
        counters, pending, n = np.zeros(COUNTERS, np.int64), [], 0
        for batch in small_batches(batches, 64):
            for text in batch["text"]:
                pending.append(counter_of(np.unique(shingle_hashes(text, words))))
                n += len(pending[-1])
            if n >= PENDING:
                counters += np.bincount(np.concatenate(pending), minlength=COUNTERS)
                pending, n = [], 0
        if n:
            counters += np.bincount(np.concatenate(pending), minlength=COUNTERS)
        blocks = counters.reshape(-1, BLOCK)
        yield [(k, blocks[k].tobytes()) for k in np.flatnonzero(blocks.any(axis=1)).tolist()]

    def added(rows: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.int64)
        for raw in rows["counts"]:
            total += np.frombuffer(raw.as_buffer(), np.int64)
        return pa.table({"block": rows["block"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "block long, counts binary"
    parts = by_arrow(docs.select(utf8(F.col("text")).alias("text")), run, schema)
    out = np.zeros((COUNTERS // BLOCK, BLOCK), np.int64)
    for row in parts.groupBy("block").applyInArrow(added, schema).collect():
        out[row["block"]] = np.frombuffer(row["counts"], np.int64)
    return out.reshape(-1)


def counter_of(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes, 600) % np.uint64(COUNTERS)).astype(np.int64)


def wide_cells(
    hashes: np.ndarray, similarity: float, known: tuple[np.ndarray, np.ndarray] | None = None
) -> np.ndarray:
    """Grid cells of a set of shingles: its first ones in an order that holds for all sets.

    Sets of that similarity share at least ``similarity`` of the larger one, so a set's shingles
    without its last ``ceil(similarity * n) - 1`` hold the first one they share. Those that
    ``known`` has as frequent come last; apart from that the order is that of another hash.
    """
    n = len(hashes)
    rank = np.zeros(n, np.int64)
    if known is not None and len(known[0]):
        at = np.minimum(np.searchsorted(known[0], hashes), len(known[0]) - 1)
        rank = np.where(known[0][at] == hashes, known[1][at], 0)
    order = np.lexsort((mixed(hashes, 1000), rank))
    return hashes[order[: n - math.ceil(similarity * n - 1e-6) + 1]]


def wide_prints(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Other columns of ``docs``, ``id`` (a hash of the set of shingles), ``fp`` (the fingerprint), ``print`` and ``cells``."""
    others = [c for c in docs.columns if c != "text"]
    counters = docs.sparkSession.sparkContext.broadcast(frequent(docs, words))

    def run(batches) -> Iterator[list[tuple]]:
        for batch in small_batches(batches, 64):
            out = []
            for *mine, text in zip(*(batch[c] for c in [*others, "text"]), strict=True):
                found = shingle_hashes(text, words)
                hashes = np.unique(found)
                id_ = signed(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                known = hashes, counters.value[counter_of(hashes)]
                cells_ = wide_cells(hashes, similarity, known) if len(hashes) else np.zeros(0, np.uint64)
                wide = wide_print(hashes, similarity).tobytes()
                out.append((*mine, id_, signed(majority(found)), wide, cells_.view(np.int64).tolist()))
            yield out

    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text")
    schema += ", id long, fp long, print binary, cells array<long>"
    return by_arrow(docs.select(*others, utf8(F.col("text")).alias("text")), run, schema)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """Other columns of ``docs`` and ``print``, the hashes of the distinct shingles."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches) -> Iterator[list[tuple]]:
        for batch in small_batches(batches, 64):
            yield [
                (*mine, np.unique(shingle_hashes(text, words)).tobytes())
                for *mine, text in zip(*(batch[c] for c in [*others, "text"]), strict=True)
            ]

    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text")
    return by_arrow(docs.select(*others, utf8(F.col("text")).alias("text")), run, f"{schema}, print binary")


def deduplicated(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of ``docs`` for each group of near copies, the one with the smallest doc_id.

    Near copies share ``similarity`` of their distinct shingles. Fingerprints within three bits
    are found by the grid join, and their sets of shingles compared. For the others loose links
    lead to groups that hold all near copies of their members; the sets are then compared within
    the groups. Of repeated rows one stays. A null doc_id is the largest.
    """
    key = [
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("__k1"),
        F.xxhash64("doc_id", utf8(F.col("text"))).alias("__k2"),
    ]
    keyed = docs.select(*key, "text")
    least = F.min(F.struct("__k1", "__k2")).alias("least")
    prints = wide_prints(keyed, words, similarity).groupBy("id")
    prints = prints.agg(least, F.min("fp").alias("fp"), F.first("print").alias("print"), F.first("cells").alias("cells"))
    one = stored(prints)

    def verified(members: DataFrame) -> DataFrame:
        """Links of the ids that share a ``cell`` by their sets of shingles."""
        wanted = one.join(members, "id").select("id", "cell", "least.__k1", "least.__k2")
        texts = keyed.join(wanted, ["__k1", "__k2"]).select("cell", "id", "text")
        return stored(set_links(stored(shingle_sets(texts, words)), similarity))

    near = near_groups(one.where(F.size("cells") > 0).select(F.col("id").alias("doc_id"), "fp"))
    near = stored(near.select(F.col("doc_id").alias("id"), F.col("component_id").alias("cell")))
    several = near.groupBy("cell").count().where("count > 1")
    close = verified(near.join(several, "cell", "left_semi"))
    cells_ = one.select(F.explode("cells").alias("cell"), "id").join(components(close), "id", "left")
    cells_ = cells_.select("cell", "id", F.coalesce("component", "id").alias("group"))
    # Most shingles are in one text only, or in texts that are linked already; prints go along with the others.
    shared = cells_.groupBy("cell").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    shared = stored(shared.where("low < high").select("cell"))
    rows = cells_.join(shared, "cell").join(one.select("id", "print"), "id").select("cell", "id", "print")
    loosely = components(linked(rows, loose(similarity), _loose_links))
    members = loosely.union(loosely.select(F.col("component").alias("id"), "component").distinct())
    found = components(close.union(verified(members.select("id", F.col("component").alias("cell")))))
    groups = one.join(found, "id", "left").groupBy(F.coalesce("component", "id").alias("component"))
    kept = groups.agg(F.min("least").alias("least")).select("least.__k1", "least.__k2")
    others = [c for c, t in docs.dtypes if c not in ("doc_id", "text") and "map<" not in t and "variant" not in t]
    same = Window.partitionBy("__k1", "__k2").orderBy(*others, F.lit(0))
    chosen = docs.select("*", *key).join(kept, ["__k1", "__k2"])
    chosen = chosen.withColumn("__nth", F.row_number().over(same)).where("__nth = 1")
    return chosen.select(*docs.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stored(fingerprints(table(spark, sf_dir, "documents"), 3))
    return near_groups(prints, 3).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
