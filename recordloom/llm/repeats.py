"""Operator 1: removal of repeated substrings by a distributed, prefix-aware suffix sort.

Every byte covered by a string of ``span`` bytes that also starts anywhere else goes. Not
all suffixes are sorted: each window of ``span`` bytes names as its anchor the run of
``core`` bytes with the smallest hash in it, so equal windows have the same anchor at the
same place. The windows of one anchor are neighbours and make up one *stretch* of text.

1. Anchors are counted by hash. A stretch whose anchor occurs once holds no repeated window
   and is sent nowhere.
2. Each task sorts the other stretches by anchor hash, the text from the anchor on, and the
   text before it. The sorted run goes out front-coded (length shared with the string
   before it, and the rest), cut into ranges of anchor hashes. Equal stretches of a run are
   settled at once and go out as one, so a range holds a stretch once per run at most.
3. The runs of a range are merged by a loser tree that keeps, for each run's next string,
   the length shared with the string put out last; strings are only compared beyond it.
   Equal stretches are neighbours in the merged order: all their windows are repeated.
4. Stretches with the same anchor that aren't equal are neighbours, too. They lie where a
   repeat begins or ends; their windows are compared by their hashes. For an anchor past
   ``HOT`` places, whose stretches are spread over several ranges, each range settles its
   own and a join over its different windows does the rest.

Texts are UTF-8 bytes, null texts are empty; matches don't cross rows. Repeated rows repeat
one another, so that nothing is left of rows of ``span`` bytes or more. Rows with a null
doc_id are handled like others. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import by_arrow, partitions, small_batches, stored, table, utf8
from recordloom.llm.syncmers import run_hashes, window_minima

SPAN, CORE = 200, 40
PART = 1 << 20
RUN = 1 << 16
RANGE = 1 << 16
HOT = 4096
ANCHORS = "hash long, k1 long, k2 long, core_at int, low int, high int"
PLACES = "k1 long, k2 long, begin int, finish int"


def anchors(raw: np.ndarray, span: int, core: int) -> tuple[np.ndarray, ...]:
    """For each anchor of a text: hash, its place, first and last start of its windows."""
    parts = []
    total = len(raw) - span + 1
    for start in range(0, total, PART - span):
        stop = min(total, start + PART - span)
        hashes = run_hashes(raw[start : stop + span - 1].astype(np.uint64), core)
        # The leftmost of equal hashes: their low bits are the place.
        keys = hashes >> np.uint64(20) << np.uint64(20) | np.arange(len(hashes), dtype=np.uint64)
        at = (window_minima(keys, span - core + 1) & np.uint64(PART - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:], [len(at)]]) - 1
        parts.append((hashes[at[first]].view(np.int64), at[first] + start, first + start, last + start))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def keyed(docs: DataFrame) -> DataFrame:
    """Adds what names a row: two longs of its id and text; repeated rows share them."""
    text = utf8(F.col("text"))
    return docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(0)).alias("k1"),
        F.xxhash64("doc_id", text).alias("k2"),
        F.encode(text, "UTF-8").alias("raw"),
    )


def with_anchors(rows: DataFrame, span: int, core: int) -> DataFrame:
    def run(batches) -> Iterator[list[tuple]]:
        for batch in small_batches(batches, 64):
            out = []
            for k1, k2, raw in zip(batch["k1"], batch["k2"], batch["raw"], strict=True):
                if len(raw) >= span:
                    found = anchors(np.frombuffer(raw, np.uint8), span, core)
                    out.extend((h, k1, k2, a, b, c) for h, a, b, c in zip(*(x.tolist() for x in found), strict=True))
            yield out

    return by_arrow(rows.select("k1", "k2", "raw"), run, ANCHORS)


def shared(a: bytes, b: bytes, known: int) -> int:
    """How many first bytes two strings share; ``known`` are known to be equal."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_coded(keys: list[bytes]) -> bytes:
    """Sorted strings as (shared with the one before, length of the rest) and the rests, compressed."""
    heads, rests, before = [], [], b""
    for key in keys:
        n = shared(before, key, 0)
        heads.append((n, len(key) - n))
        rests.append(key[n:])
        before = key
    flat = np.array(heads, "<u4").reshape(-1, 2)
    body = struct.pack("<I", len(keys)) + flat.tobytes() + b"".join(rests)
    return zstandard.ZstdCompressor(level=3).compress(body)


def decoded(payload: bytes) -> Iterator[tuple[bytes, int]]:
    """(string, length shared with the one before) of a run, in order."""
    body = zstandard.ZstdDecompressor().decompress(payload)
    (count,) = struct.unpack_from("<I", body)
    heads = np.frombuffer(body, "<u4", 2 * count, 4).reshape(-1, 2).tolist()
    at, key = 4 + 8 * count, b""
    for n, rest in heads:
        key = key[:n] + body[at : at + rest]
        at += rest
        yield key, n


class LoserTree:
    """Merges sorted runs of (string, length shared with the one before in its run).

    A node keeps the loser of its match and the length the loser shares with that match's
    winner. Along a leaf's path every length is therefore one shared with the string put
    out last: the longer length wins unseen, and equal ones are compared beyond it.
    """

    def __init__(self, runs: list[Iterator[tuple[bytes, int]]]) -> None:
        self.runs = runs
        self.size = max(1, len(runs))
        self.next: list[bytes | None] = [None] * self.size
        self.known = [0] * self.size
        for i, run in enumerate(runs):
            self._advance(i, run)
        self.losers = [-1] * self.size
        for i in range(self.size):
            self._enter(i)

    def _advance(self, i: int, run: Iterator[tuple[bytes, int]]) -> None:
        self.next[i], self.known[i] = next(run, (None, -1))

    def _wins(self, a: int, b: int) -> bool:
        """Whether a's string comes first; sets the length that the loser shares with the winner."""
        x, y = self.next[a], self.next[b]
        if x is None or y is None:
            return y is None
        p, q = self.known[a], self.known[b]
        if p != q:
            return p > q
        n = shared(x, y, p)
        first = len(x) <= len(y) if n == min(len(x), len(y)) else x[n] < y[n]
        self.known[b if first else a] = n
        return first

    def _enter(self, i: int) -> None:
        """A first match at each node; nodes without a loser yet keep who comes by."""
        node = (i + self.size) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = i
                return
            if not self._wins(i, other):
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple[bytes, int, int]]:
        """(string, length shared with the one before, run) in order."""
        losers, size = self.losers, self.size
        while (key := self.next[i := losers[0]]) is not None:
            yield key, self.known[i], i
            self._advance(i, self.runs[i])
            node = (i + size) // 2
            while node > 0:
                other = losers[node]
                if not self._wins(i, other):
                    losers[node], i = i, other
                node //= 2
            losers[0] = i


def stretch_key(core_hash: int, raw: bytes, core_at: int, low: int, high: int, span: int) -> bytes:
    """Anchor hash, text from the anchor on, text before it, and where the two meet."""
    after = raw[core_at : high + span]
    return struct.pack(">q", core_hash) + after + raw[low:core_at] + struct.pack(">I", len(after))


def window_hashes(key: bytes, span: int) -> np.ndarray:
    """A hash of each window of a stretch, in the order of the text."""
    (after,) = struct.unpack(">I", key[-4:])
    text = key[8 + after : -4] + key[8 : 8 + after]
    return run_hashes(np.frombuffer(text, np.uint8).astype(np.uint64), span).view(np.int64)


RUN_ROWS = (
    "range int, payload binary, hot array<boolean>, single array<boolean>, "
    "k1s array<long>, k2s array<long>, lows array<int>, places array<struct<k1:long,k2:long,begin:int,finish:int>>"
)


def sorted_runs(rows: DataFrame, ranges: int, span: int) -> DataFrame:
    """Front-coded sorted runs of the stretches of ``rows`` (k1, k2, raw, found), a row per range."""

    def run(batches) -> Iterator[list[tuple]]:
        seen: dict[bytes, list[tuple]] = {}
        held = 0

        def settled() -> list[tuple]:
            by_range, done = defaultdict(list), defaultdict(list)
            for key in sorted(seen):
                where = seen[key]
                hot = where[0][4]
                core = struct.unpack_from(">q", key)[0]
                if hot:  # spread by all of the stretch; equal ones still meet
                    core ^= int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big", signed=True)
                of = (core & 0x7FFFFFFFFFFFFFFF) % ranges
                if len(where) > 1:
                    done[of].extend((k1, k2, low, high + span) for k1, k2, low, high, _ in where)
                by_range[of].append((key, hot, len(where) == 1, where[0]))
            out = []
            for of, entries in by_range.items():
                out.append(
                    (
                        of,
                        front_coded([e[0] for e in entries]),
                        [e[1] for e in entries],
                        [e[2] for e in entries],
                        [e[3][0] for e in entries],
                        [e[3][1] for e in entries],
                        [e[3][2] for e in entries],
                        [dict(zip(("k1", "k2", "begin", "finish"), p, strict=True)) for p in done[of]],
                    )
                )
            seen.clear()
            return out

        for batch in small_batches(batches, 64):
            for k1, k2, raw, found in zip(batch["k1"], batch["k2"], batch["raw"], batch["found"], strict=True):
                for a in found:
                    key = stretch_key(a["hash"], raw, a["core_at"], a["low"], a["high"], span)
                    seen.setdefault(key, []).append((k1, k2, a["low"], a["high"], a["count"] > HOT))
                    held += 1
            if held >= RUN:
                held = 0
                yield settled()
        if seen:
            yield settled()

    return by_arrow(rows.select("k1", "k2", "raw", "found"), run, RUN_ROWS)


def repeated_of(stretches: list[tuple], span: int) -> Iterator[tuple]:
    """Places of the repeated windows of unequal stretches of one anchor that occur once each.

    ``stretches``: (string, (k1, k2, low) or None if it is repeated as a whole).
    """
    hashes = [window_hashes(key, span) for key, _ in stretches]
    every, counts = np.unique(np.concatenate(hashes), return_counts=True)
    for (_, where), mine in zip(stretches, hashes, strict=True):
        if where is not None:
            again = counts[np.searchsorted(every, mine)] > 1
            edges = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]]).astype(np.int8)))
            for first, stop in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                yield where[0], where[1], where[2] + first, where[2] + stop - 1 + span


def open_windows(stretches: list[tuple], span: int) -> Iterator[tuple]:
    """Each different window of a range's stretches of a hot anchor, once, for the other ranges.

    A window that occurs once in the range and is not settled brings its place along.
    """
    hashes = [window_hashes(key, span) for key, _ in stretches]
    every, first, counts = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
    starts = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
    owners = np.searchsorted(starts, first, side="right") - 1
    for h, at, n, owner in zip(every.tolist(), first.tolist(), counts.tolist(), owners.tolist(), strict=True):
        where = stretches[owner][1]
        if n > 1 or where is None:
            yield 0, 0, None, None, h
        else:
            begin = where[2] + at - int(starts[owner])
            yield where[0], where[1], begin, begin + span, h


def merged(runs: DataFrame, span: int) -> DataFrame:
    """Places of repeated windows (window null), and windows of hot anchors' stretches (window set).

    The latter are settled within each range first; see ``open_windows``.
    """

    def of_range(rows: list[tuple]) -> Iterator[tuple]:
        tree = LoserTree([decoded(r[1]) for r in rows])
        at = [0] * len(rows)
        group: list[tuple] = []
        equal: list[tuple] = []
        before = b""

        def close_equal() -> Iterator[tuple]:
            if not equal:
                return
            key, hot = equal[0][0], equal[0][1]
            if len(equal) > 1 or not equal[0][2]:
                (after,) = struct.unpack(">I", key[-4:])
                width = len(key) - 12
                for _, _, single, k1, k2, low in equal:
                    if single:
                        yield k1, k2, low, low + width, None
                group.append((key, hot, None))
            else:
                group.append((key, hot, equal[0][3:]))
            equal.clear()

        def close_group() -> Iterator[tuple]:
            stretches = [(key, where) for key, _, where in group]
            if len(group) > 1:
                for place in repeated_of(stretches, span):
                    yield (*place, None)
            if group and group[0][1]:
                yield from open_windows(stretches, span)
            group.clear()

        for key, known, i in tree:
            same = known == len(key) == len(before)
            if not same:
                yield from close_equal()
                if known < 8:
                    yield from close_group()
            row, k = rows[i], at[i]
            at[i] += 1
            equal.append((key, row[2][k], row[3][k], row[4][k], row[5][k], row[6][k]))
            before = key
        yield from close_equal()
        yield from close_group()

    def run(batches) -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for batch in small_batches(batches, 64):
            for row in zip(*(batch[c] for c in COLUMNS), strict=True):
                if held and held[0][0] != row[0]:
                    yield list(of_range(held))
                    held = []
                held.append(row)
        if held:
            yield list(of_range(held))

    n = partitions(runs.sparkSession)
    dealt = runs.select(*COLUMNS).repartition(n, "range").sortWithinPartitions("range")
    return by_arrow(dealt, run, PLACES + ", window long")


COLUMNS = ("range", "payload", "hot", "single", "k1s", "k2s", "lows")


def hot_places(windows: DataFrame) -> DataFrame:
    """Of the windows of hot anchors, those that occur in several ranges."""
    again = windows.groupBy("window").count().where("count > 1").select("window")
    return windows.where("begin is not null").join(again, "window", "left_semi").drop("window")


def repeated_places(docs: DataFrame, span: int = SPAN, core: int = CORE) -> DataFrame:
    """Pieces (k1, k2, begin, finish) of ``keyed`` rows that repeated strings cover."""
    found = with_anchors(docs, span, core)
    again = stored(found.groupBy("hash").count().where("count > 1"))
    total = again.agg(F.sum("count")).first()[0] or 0
    ranges = max(partitions(docs.sparkSession), -(-total // RANGE))
    shared_ = found.join(again, "hash").groupBy("k1", "k2")
    lists = shared_.agg(F.collect_list(F.struct("hash", "core_at", "low", "high", "count")).alias("found"))
    runs = stored(sorted_runs(docs.select("k1", "k2", "raw").join(lists, ["k1", "k2"]), ranges, span))
    places = stored(merged(runs, span))
    local = runs.select(F.inline("places"))
    return (
        local.unionByName(places.where("window is null").drop("window"))
        .unionByName(hot_places(places.where("window is not null")))
        .select("k1", "k2", "begin", "finish")
    )


def removed(docs: DataFrame, span: int = SPAN, core: int = CORE) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (bytes) and spans [begin, finish)."""
    rows = keyed(docs.select("doc_id", "text"))
    places = repeated_places(rows, span, core).groupBy("k1", "k2")
    pieces = places.agg(F.collect_list(F.struct("begin", "finish")).alias("pieces"))

    def cut(batches) -> Iterator[list[tuple]]:
        for batch in small_batches(batches, 64):
            out = []
            for doc_id, raw, mine in zip(batch["doc_id"], batch["raw"], batch["pieces"], strict=True):
                spans: list[list[int]] = []
                for begin, finish in sorted((p["begin"], p["finish"]) for p in mine or ()):
                    if spans and begin <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], finish)
                    else:
                        spans.append([begin, finish])
                kept, at = [], 0
                for begin, finish in spans:
                    kept.append(raw[at:begin])
                    at = finish
                kept.append(raw[at:])
                left = b"".join(kept)
                out.append((doc_id, len(raw), len(raw) - len(left), len(spans), left, spans))
            yield out

    joined = rows.join(pieces, ["k1", "k2"], "left").select("doc_id", "raw", "pieces")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<array<int>>"
    return by_arrow(joined, cut, schema)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
