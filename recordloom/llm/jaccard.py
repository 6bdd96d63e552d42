"""Operator 12: n-gram Jaccard join with token-combination prefixes.

The tokens are 64-bit hashes of a text's distinct shingles. All texts are counted for the
frequent ones with a mergeable summary of bounded size (``HEAVY`` counters a task, each with
its least possible count). In the common order of tokens rare ones come first, then the
frequent ones by count. A set of n tokens that shares ``percent`` of the union with another
set lacks at most d = n - ceil(percent * n / 100) of its tokens there. Its prefix is extended
until d missing tokens can't break all signatures: a rare token is a signature of its own
and costs one miss; frequent tokens are dealt to classes by hash, the signatures are the
pairs within a class, and a class of x of them costs x - 1 misses. The number of classes
follows the size of the set (a power of two, for each that a partner may have), so that the
pairs stay in proportion to the prefix.

Two similar sets share a signature, so no link is lost: of two prefixes one ends first, all
its common tokens are in the other one as well, and as its misses can't break every
signature, one of them is whole. Sets that share a signature are compared by wide prints
that only rule out what can't be similar; the groups which these leave are verified by their
true sets. Cells and groups past a bounded size are dealt to several tasks as pairs of
blocks, and only links of spanning forests leave a task. Equal sets are one from the start.

Null and empty texts and texts without words have no tokens and are linked with nothing.
Rows that share a doc_id are one node; a null doc_id has the component of its set's other
rows, if any. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.bloom import fixed_filter, key_of, passed
from recordloom.llm.common import by_arrow, stored, table, utf8
from recordloom.llm.simhash import _loose_links, components, linked, loose, mixed, set_links, wide_print

SEED = 42
# Counters of the summary of frequent tokens, and the least count of a frequent one.
HEAVY, FREQUENT = 1 << 16, 256
# Tokens that are counted at once.
PENDING = 1 << 20
# Mean tokens of a class of frequent ones in a whole set are four to ten.
PER_CLASS = 4
STEP, ONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(1)
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Bytes of a text that are hashed at once, unless a single word is longer, and rows that are handled at once.
SLICE, ROWS = 1 << 18, 64
# What a byte adds to a word's hash: A-Z count as a-z.
LETTERS = mixed(np.frombuffer(bytes(range(256)).translate(LOWER), np.uint8).astype(np.uint64), 1198)
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))


class Powers:
    """The powers of ``STEP`` and of its inverse, as far as they were asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(SLICE + 1, n)
            cls.up, cls.down = (np.multiply.accumulate(np.where(np.arange(size) > 0, x, ONE)) for x in (STEP, INVERSE))
        return cls.up[:n], cls.down[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that lie one after the other, and the place of each word.

    ``starts``: where each text begins. A word's polynomial hash is the difference of two
    running sums, brought to its own place.
    """
    n = len(data)
    blank = np.append(BLANK[data], True)
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    before = np.concatenate([[True], blank[:-1]])
    first = np.flatnonzero(~blank & (before | edge))
    end = np.flatnonzero(~before & (blank | edge))
    up, down = Powers.of(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(LETTERS[data] * up, out=sums[1:])
    hashes = (sums[end] - sums[first]) * down[first]
    return mixed(hashes + (end - first).astype(np.uint64) * STEP, 1199), first


def shingle_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the runs of ``words`` words."""
    n = len(hashes) - words + 1
    out = hashes[: max(0, n)].copy()
    for k in range(1, words if n > 0 else 0):
        out *= STEP
        out += hashes[k : n + k]
    return mixed(out, 100 + words)


def distinct(hashes: np.ndarray) -> np.ndarray:
    out = np.sort(hashes)
    return out[np.append(True, out[1:] != out[:-1])[: len(out)]]


def long_text(data: np.ndarray) -> np.ndarray:
    """The hashes of all words of one text, sliced between words."""
    out, at = [], 0
    while len(data) - at > SLICE:
        blanks = np.flatnonzero(BLANK[data[at : at + SLICE]])
        cut = at + int(blanks[-1]) + 1 if len(blanks) else at + SLICE
        while cut < len(data) and not BLANK[data[cut - 1]]:
            cut += 1
        out.append(word_hashes(data[at:cut], np.zeros(1, int))[0])
        at = cut
    out.append(word_hashes(data[at:], np.zeros(1, int))[0])
    return np.concatenate(out)


def token_rows(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Hashes of each text's distinct shingles, ascending; of all its words if there are fewer than a shingle has."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, raw = texts.buffers()
    places = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        # As many texts as fit in a slice, or a single one.
        stop = max(row + 1, int(np.searchsorted(places, places[row] + SLICE, "right")) - 1)
        own = data[places[row] : places[stop]]
        if len(own) > SLICE:
            hashes = long_text(own)
            bounds = [0, len(hashes)]
        else:
            starts = places[row : stop + 1] - places[row]
            hashes, first = word_hashes(own, starts)
            bounds = np.searchsorted(first, starts).tolist()
        whole = shingle_hashes(hashes, words)
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield distinct(whole[a : b - words + 1] if b - a >= words else shingle_hashes(hashes[a:b], max(1, b - a)))
        row = stop


def rows_with_tokens(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[Iterator[tuple]]:
    """The other columns of each row and the tokens of the last one, some rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            others = [c.to_pylist() for c in part.columns[:-1]]
            yield zip(*others, token_rows(part.columns[-1], words), strict=True)


class Summary:
    """Tokens and the least number of times they came (Misra and Gries), of any number of tokens."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pending: list[np.ndarray] = []
        self.n = 0

    def add(self, keys: np.ndarray) -> None:
        self.pending.append(keys)
        self.n += len(keys)
        if self.n >= PENDING:
            self.settle()

    def settle(self) -> None:
        if not self.n:
            return
        keys, counts = np.unique(np.concatenate(self.pending), return_counts=True)
        self.pending, self.n = [], 0
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        keys, of = np.unique(keys, return_inverse=True)
        counts = np.bincount(of, counts).astype(np.int64)
        if len(keys) > self.size:
            counts = counts - np.partition(counts, -self.size - 1)[-self.size - 1]
        self.keys, self.counts = keys[counts > 0], counts[counts > 0]


def frequent_tokens(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that are frequent in all of ``docs``, ascending, and their least counts; ``HEAVY`` at most.

    A token that makes up more than a ``HEAVY``-th of all is sure to be among them if it came
    ``FREQUENT`` times more than that. Only the order of tokens depends on it, not the result.
    """

    def run(batches) -> Iterator[list[tuple]]:
        summary = Summary(HEAVY)
        for rows in rows_with_tokens(batches, words):
            for (own,) in rows:
                summary.add(own)
        summary.settle()
        often = summary.counts > 1
        yield list(zip(summary.keys[often].view(np.int64).tolist(), summary.counts[often].tolist(), strict=True))

    counted = by_arrow(docs.select(utf8(F.col("text")).alias("text")), run, "token long, n long")
    counted = counted.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    rows = counted.orderBy(F.desc("n"), "token").limit(HEAVY).collect()
    keys = np.array([r["token"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r["n"] for r in rows], np.int64)[order]


def signatures(own: np.ndarray, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The signatures of a set of tokens (distinct, ascending)."""
    n = len(own)
    if not n:
        return own
    need = -(-percent * n // 100)
    misses = n - need
    count = np.zeros(n, np.int64)
    if len(frequent[0]):
        at = np.minimum(np.searchsorted(frequent[0], own), len(frequent[0]) - 1)
        count = np.where(frequent[0][at] == own, frequent[1][at], 0)
    shuffled = mixed(own, 1200)
    rare = np.flatnonzero(count == 0)
    rare = rare[np.argsort(shuffled[rare])][: misses + 1]
    out = [mixed(own[rare], 1201)]
    rest = misses - len(rare)
    if rest >= 0:
        often = np.flatnonzero(count)
        often = often[np.lexsort((shuffled[often], count[often]))]
        for level in range(need.bit_length() - 1, (100 * n // percent).bit_length()):
            classes = max(1, (1 << level) // PER_CLASS)
            of = mixed(own[often], 1202) % np.uint64(classes)
            # Each token costs a miss except the first one of its class.
            first = np.zeros(len(often), bool)
            first[np.unique(of, return_index=True)[1]] = True
            end = int(np.searchsorted(np.cumsum(~first), rest + 1)) + 1
            prefix, of = own[often[:end]], of[:end]
            order = np.lexsort((prefix, of))
            prefix, of = prefix[order], of[order]
            bounds = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            pairs = [p for a, b in zip(bounds, bounds[1:], strict=False) for p in combinations(range(a, b), 2)]
            if pairs:
                a, b = np.array(pairs).T
                out.append(mixed(mixed(prefix[a], 1203) * STEP + mixed(prefix[b], 1204), 1300 + level))
    return np.unique(np.concatenate(out))


def with_signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n (distinct shingles), digest of the set, print and signatures of each row."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, words))

    def run(batches) -> Iterator[list[tuple]]:
        for rows in rows_with_tokens(batches, words):
            out = []
            for doc_id, own in rows:
                signed = signatures(own, percent, frequent.value).view(np.int64)
                digest = xxhash.xxh3_128_digest(own.tobytes(), SEED)
                out.append((doc_id, len(own), digest, wide_print(own, percent / 100).tobytes(), signed))
            yield out

    texts = docs.select("doc_id", utf8(F.col("text")).alias("text"))
    return by_arrow(texts, run, "doc_id long, n long, digest binary, print binary, cells array<long>")


def token_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """cell, id and print (the set of tokens) of ``members`` (doc_id, id, cell).

    A filter of fixed size over the members' ids keeps nearly all other texts from being shuffled.
    """
    blocks = docs.sparkSession.sparkContext.broadcast(fixed_filter(members, "doc_id"))

    def run(batches) -> Iterator[list[tuple]]:
        wanted = (b.filter(pa.array(passed(blocks.value, b.column(0).to_numpy().view(np.uint64)))) for b in batches)
        for rows in rows_with_tokens(wanted, words):
            yield [(doc_id, own.tobytes()) for _, doc_id, own in rows]

    texts = docs.where("doc_id is not null").select(key_of("doc_id").alias("key"), "doc_id", utf8(F.col("text")).alias("text"))
    return by_arrow(texts, run, "doc_id long, print binary").join(members, "doc_id").select("cell", "id", "print")


def similar_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Two rows are linked if ``percent`` (over 50) of the union of their sets of distinct
    ``words``-word shingles is common to both. ``component_id`` is the smallest doc_id that
    links lead to.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(with_signatures(docs, words, percent))
    one = signed.where("n > 0 and doc_id is not null").groupBy("digest")
    one = stored(one.agg(F.min("doc_id").alias("id"), F.first("print").alias("print"), F.first("cells").alias("cells")))
    cells = one.select(F.explode("cells").alias("cell"), "id")
    # Most tokens are in one set only; prints go along with the others.
    shared = stored(cells.groupBy("cell").count().where("count > 1").select("cell"))
    rows = cells.join(shared, "cell").join(one.select("id", "print"), "id").select("cell", "id", "print")
    groups = components(linked(rows, loose(percent / 100), _loose_links))
    members = groups.union(groups.select(F.col("component").alias("id"), "component").distinct())
    members = members.select(F.col("id").alias("doc_id"), "id", F.col("component").alias("cell"))
    found = components(set_links(stored(token_sets(docs, stored(members), words)), percent / 100))
    classes = one.select("digest", "id").join(found, "id", "left")
    classes = classes.select("digest", F.coalesce("component", "id").alias("class"))
    return signed.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(classes, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("class")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"), words=4, percent=85)


OP12_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
  END AS shingles
  FROM words
),
members AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""
