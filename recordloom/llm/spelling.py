"""Operator 13: spelling variants found by probing edits against Bloom filters.

Two words are near if one inserted, deleted or replaced code point turns one into the other.
Each unordered pair is generated once: a deletion by its longer word, a replacement by the
word whose letter there is rarer, so that a common letter is never replaced. A word's edits
are not spelled out; a polynomial hash gives the key of each in constant time, and numpy
probes the keys of many words at once.

The filters are blocked (one 64-bit block and four bits a word) and sharded by word length;
a length with many words has several slices by key. Shards are packed into passes of at most
``FILTER_BYTES``, which are broadcast one after the other, and a word takes part in the
passes that hold its own or the next smaller length only. What passes a filter is shuffled
to a join with the vocabulary by key, and the distance of the joined words is checked, so
false positives and equal keys of other words disappear.

Null texts have no words; a null doc_id counts as an empty one. Repeated rows count again.
Equal counts go to the smaller word in code-point order. Words of any length are handled: a
length that holds one word only is not probed by it. Extra columns are not read. Empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.bloom import bits_of, blocks_of
from recordloom.llm.common import partitions, stored, table
from recordloom.llm.simhash import mixed

FILTER_BYTES = 64_000_000
# Words of a slice, and bits that a filter has for each.
SLICE_WORDS, BITS = 1 << 13, 24
# Code points whose edits are generated at once.
CHUNK = 1 << 17
LETTERS = "[A-Za-zÀ-ÿ]"
BASE = 0x9E3779B97F4A7C15
INVERSE = np.uint64(pow(BASE, -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)


def final(raw: np.ndarray, length: int) -> np.ndarray:
    """The key of words of ``length`` from their polynomial hash."""
    x = raw + np.uint64(length * 0xA24BAED4963EE407 & 0xFFFFFFFFFFFFFFFF)
    return (x ^ (x >> np.uint64(29))) * MIX


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def code_points(words: list[str], length: int) -> np.ndarray:
    raw = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).reshape(len(words), length)


def letter_hashes(points: np.ndarray) -> np.ndarray:
    return mixed(points.astype(np.uint64), 1300)


def word_keys(words: list[str], length: int) -> np.ndarray:
    return final((letter_hashes(code_points(words, length)) * powers(length)).sum(1), length)


class Shard:
    """The filter of the words of one length, or of those of its slices that a pass holds."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.slices = -(-words // SLICE_WORDS)
        self.blocks = -(-words * BITS // (64 * self.slices)) + 1

    def fill(self, filters: dict[int, np.ndarray], wanted: list[int]) -> None:
        """Lays the filters of the wanted slices one after the other; a slice without words has none."""
        self.starts = np.full(self.slices, -1)
        self.starts[wanted] = np.arange(len(wanted)) * self.blocks
        empty = np.zeros(self.blocks, np.uint64)
        self.bits = np.concatenate([filters.get(k, empty) for k in wanted])

    def hits(self, keys: np.ndarray) -> np.ndarray:
        starts = self.starts[(keys % np.uint64(self.slices)).astype(np.int64)]
        bits = bits_of(keys)
        found = self.bits[np.maximum(starts, 0) + blocks_of(keys, self.blocks)]
        return ((found & bits) == bits) & (starts >= 0)


def edits(points: np.ndarray, letters: np.ndarray, shards: dict[int, Shard]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers and keys of the edits of equally long words that pass the filters of ``shards``.

    ``letters``: all code points, the rarest first.
    """
    n, length = points.shape
    power, hashes = powers(length), letter_hashes(points)
    terms = hashes * power
    whole = terms.sum(1)
    if length - 1 in shards:
        before = np.cumsum(terms, axis=1) - terms
        keys = final(before + (whole[:, None] - before - terms) * INVERSE, length - 1)
        # Of equal letters in a row only the last is deleted.
        last = np.ones((n, length), bool)
        last[:, :-1] = points[:, 1:] != points[:, :-1]
        word, keys = np.nonzero(last)[0], keys[last]
        hit = shards[length - 1].hits(keys)
        yield word[hit], keys[hit]
    if length in shards and shards[length].words > 1:
        order = np.argsort(letters, kind="stable")
        rank = order[np.searchsorted(letters[order], points)].reshape(-1)
        at = np.argsort(rank, kind="stable")
        word = at // length
        base, factor = whole[word] - terms.reshape(-1)[at], power[at % length]
        ends = np.searchsorted(rank[at], np.arange(len(letters)))
        for end, letter in zip(ends, letter_hashes(letters), strict=True):
            if end:
                keys = final(base[:end] + letter * factor[:end], length)
                hit = np.flatnonzero(shards[length].hits(keys))
                yield word[hit], keys[hit]


def with_keys(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``length`` and ``key``, stored in the order of lengths."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words_ = np.array(batch.column(0).to_pylist(), object)
            lengths = batch.column(2).to_numpy()
            keys = np.zeros(len(words_), np.uint64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                step = max(1, CHUNK // max(1, int(length)))
                for k in range(0, len(at), step):
                    some = at[k : k + step]
                    keys[some] = word_keys(words_[some].tolist(), int(length))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys.view(np.int64))], names=["word", "n", "length", "key"]
            )

    sized = words.select("word", "n", F.char_length("word").alias("length"))
    sized = sized.repartition(partitions(words.sparkSession), "word").sortWithinPartitions("length", "word")
    return stored(sized.mapInArrow(run, "word string, n long, length int, key long"))


def passes(sizes: list[tuple[int, int]]) -> list[dict[int, list[int]]]:
    """Slices by length for each pass, so that a pass has ``FILTER_BYTES`` at most."""
    out: list[dict[int, list[int]]] = []
    room = 0
    for length, words in sorted(sizes):
        shard = Shard(words)
        for k in range(shard.slices):
            if not out or room < 8 * shard.blocks:
                out.append({})
                room = FILTER_BYTES
            out[-1].setdefault(length, []).append(k)
            room -= 8 * shard.blocks
    return out


def filled(words: DataFrame, sizes: dict[int, int], wanted: dict[int, list[int]]) -> dict[int, Shard]:
    """The filters of one pass, each built by the task that gets the words of its slice."""
    spark = words.sparkSession
    shards = {length: Shard(sizes[length]) for length in wanted}
    # As many rows as the pass has slices, each of two blocks at least.
    slices = spark.createDataFrame([(x, s.slices) for x, s in shards.items()], "length int, slices long")
    here = spark.createDataFrame([(x, k) for x, own in wanted.items() for k in own], "length int, slice long")
    own = words.select("length", "key").join(F.broadcast(slices), "length")
    # The remainder of the key as an unsigned number, like in ``Shard``.
    rest = F.pmod(F.shiftrightunsigned("key", 1), F.col("slices")) * 2 + F.col("key").bitwiseAND(1)
    own = own.withColumn("slice", F.pmod(rest, F.col("slices"))).join(F.broadcast(here), ["length", "slice"], "left_semi")

    blocks = {length: s.blocks for length, s in shards.items()}

    def build(group: pa.Table) -> pa.Table:
        length, k = group["length"][0].as_py(), group["slice"][0].as_py()
        keys = group["key"].to_numpy().view(np.uint64)
        own = np.zeros(blocks[length], np.uint64)
        np.bitwise_or.at(own, blocks_of(keys, len(own)), bits_of(keys))
        return pa.table({"length": pa.array([length], pa.int32()), "slice": pa.array([k], pa.int64()), "bits": [own.tobytes()]})

    filters: dict[int, dict[int, np.ndarray]] = {length: {} for length in wanted}
    for row in own.groupBy("length", "slice").applyInArrow(build, "length int, slice long, bits binary").collect():
        filters[row["length"]][row["slice"]] = np.frombuffer(bytes(row["bits"]), np.uint64)
    for length, own_slices in wanted.items():
        shards[length].fill(filters[length], own_slices)
    return shards


def probed(words: DataFrame, letters: np.ndarray, shards: dict[int, Shard]) -> DataFrame:
    """key, word and n of the edits that pass the filters; ``words`` as given by ``with_keys``."""
    sent = words.sparkSession.sparkContext.broadcast(shards)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words_, lengths = np.array(batch.column(0).to_pylist(), object), batch.column(2).to_numpy()
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                step = max(1, CHUNK // length)
                for k in range(0, len(at), step):
                    some = at[k : k + step]
                    points = code_points(words_[some].tolist(), length)
                    for word, keys in edits(points, letters, sent.value):
                        if len(word):
                            of = pa.array(some[word])
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(keys.view(np.int64)), batch.column(0).take(of), batch.column(1).take(of)],
                                names=["key", "word", "n"],
                            )

    lengths = [(x,) for x in sorted({x for length in shards for x in (length, length + 1)}) if x]
    here = words.sparkSession.createDataFrame(lengths, "length int")
    own = words.join(F.broadcast(here), "length", "left_semi").select(*words.columns)
    return own.mapInArrow(run, "key long, word string, n long")


def near_words(words: DataFrame) -> DataFrame:
    """word, other and other_n, both ways, of all words (word, n, length, key) at a distance of one."""
    spark = words.sparkSession
    sizes = {r["length"]: r["count"] for r in words.groupBy("length").count().collect()}
    # At most as many rows as there are code points.
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter != ''").groupBy("letter").count()
    ordered = sorted((r["count"], r["letter"]) for r in letters.collect())
    points = np.array([ord(c) for _, c in ordered], np.uint32)
    out = spark.createDataFrame([], "word string, other string, other_n long")
    other = words.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    for wanted in passes(list(sizes.items())):
        found = probed(words, points, filled(words, sizes, wanted)).join(other, "key")
        found = stored(found.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n"))
        out = out.union(found.select("word", "other", "other_n"))
        out = out.union(found.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return out


def roots(forms: DataFrame) -> DataFrame:
    """word and the last form that its forms (word, form) lead to.

    Each round doubles the steps taken; counts grow by a factor with every form, so there are few.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = stored(reached.join(further, "root", "left"))
        if joined.where("beyond is not null").isEmpty():
            return reached
        reached = stored(joined.select("word", F.coalesce("beyond", "root").alias("root")))


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of distinct words (word, n).

    A word's form is its near word of largest n, if that is at least ``ratio`` times its own.
    """
    keyed = with_keys(words)
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = near_words(keyed).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    held = -F.col("best.n") >= ratio * F.col("n")
    known = stored(
        keyed.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(held, F.col("best.word")).alias("form"),
            F.when(held, -F.col("best.n")).alias("form_n"),
        )
    )
    found = roots(known.where("form is not null").select("word", "form"))
    known = known.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return known.select("word", "form", "root", "n", "n_near", "form_n")


def runs(docs: DataFrame, least: int) -> DataFrame:
    """doc_id (as text) and each maximal run of at least ``least`` letters, A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least},}}"), F.lit(0)))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), found.alias("run"))
    return found.select("doc", F.translate("run", upper, upper.lower()).alias("run"))


def counted(words: DataFrame, least_length: int, least_n: int) -> DataFrame:
    """word and n (occurrences) of the words that reach both bounds."""
    counts = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_n)


def with_deletions(found: DataFrame, every: int) -> DataFrame:
    """The words of runs (doc, run), one code point short where a checksum of both is a multiple of ``every``."""
    at = F.pmod("check", F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    checked = found.withColumn("check", F.crc32(F.concat("doc", F.lit(":"), "run")))
    return checked.select(F.when(F.col("check") % every == 0, less).otherwise(F.col("run")).alias("word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = with_deletions(runs(table(spark, sf_dir, "documents"), 7), 31)
    return variants(counted(words, 7, 2))


OP13_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs
),
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
occurrences AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 7 GROUP BY ALL),
spelled AS (
  SELECT run, n, flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda c:
    CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END)) AS bytes
  FROM occurrences
),
checked AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b:
    xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM spelled, crc_table
),
results AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM checked
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM places),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
),
ranked AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
  FROM pairs
),
known AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN ranked ON ranked.word = words.word AND place = 1
),
steps AS (
  SELECT word, form AS last, 1 AS step FROM known WHERE form IS NOT NULL
  UNION ALL SELECT steps.word, known.form, step + 1 FROM steps JOIN known ON known.word = steps.last WHERE known.form IS NOT NULL
),
ends AS (SELECT word, max_by(last, step) AS root FROM steps GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM known LEFT JOIN ends USING (word)
"""
