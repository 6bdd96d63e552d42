"""Operator 11: ranked lexical search with a length-stratified index.

The index is split by documents: a segment holds the documents that one task read one after
the other, up to ``TOKENS`` terms or ``ROWS`` documents. Within a segment the documents of
equal normaliser m form a stratum, and a term's postings are grouped by stratum and then by
tf, so that an impact is computed once for each m and tf. A search takes a query's strata of
a segment in the order of their bounds (each term's largest tf there) and stops when no
other stratum can reach the k-th score. Each segment returns k documents per query at most,
which a window ranks; no pair of query and document is shuffled beyond that.

Every document with a term is indexed, whatever its length. Null and empty texts have no
terms, are not counted and never found; queries without terms find nothing. Documents of
equal score rank by ascending doc_id, null ones last. Repeated rows are documents of their
own; equal queries (same id and text) are one. Extra columns are not read. With no documents
or no queries the result has no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordloom.llm.common import by_arrow, small_batches, stored, table, utf8

# A segment is closed at so many terms or documents.
TOKENS, ROWS = 1 << 21, 1 << 14
# Terms of the queries that go to the tasks at once, and bytes of a text that are split at once.
BLOCK, SLICE = 100_000, 1 << 20
# Terms are runs of digits, letters and all characters past U+007F; of these only A-Z are lower-cased.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
INDEX_SCHEMA = (
    "segment long, term binary, df long, strata array<int>, tfs array<int>, sizes array<int>, ords array<int>, "
    "ms array<long>, lengths array<int>, ids array<long>"
)
HIT_SCHEMA = "query int, doc_id long, score long"


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, slice by slice."""
    raw, at = text.encode("utf-8", "surrogatepass").translate(FOLD), 0
    while len(raw) - at > SLICE:
        cut = raw.rfind(b" ", at, at + SLICE)
        if cut <= at:
            cut = raw.find(b" ", at + SLICE)
            if cut < 0:
                break
        yield raw[at:cut].split()
        at = cut + 1
    yield (raw[at:] if at else raw).split()


def normaliser(n: int, documents: int, total: int) -> int:
    return 100 - 75 + (75 * n * documents) // total


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all given ranges, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class Segment:
    """Collects the documents of one segment and lays out their postings."""

    def __init__(self, documents: int, total: int) -> None:
        self.documents, self.total = documents, total
        self.vocabulary: dict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.ids: list[int | None] = []
        self.ms: list[int] = []
        self.tokens = self.pending = 0
        self.parts: list[np.ndarray] = []
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, doc_id: int | None, text: str) -> None:
        n = 0
        for part in terms(text):
            if part:
                found = np.fromiter(map(self.vocabulary.__getitem__, part), np.int64, len(part))
                self.parts.append(found + (len(self.ids) << 32))
                n += len(part)
                self.pending += len(part)
                if self.pending >= SLICE:
                    self.count()
        if n:
            self.ids.append(doc_id)
            self.ms.append(normaliser(n, self.documents, self.total))
            self.tokens += n

    def count(self) -> None:
        """Sums up the pending terms by document."""
        if self.parts:
            self.counted.append(np.unique(np.concatenate(self.parts), return_counts=True))
        self.parts, self.pending = [], 0

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Term, document and tf of each posting."""
        self.count()
        keys, tfs = (np.concatenate(x) for x in zip(*self.counted, strict=True))
        if len(self.counted) > 1:  # a long document may have been counted in several parts
            order = np.argsort(keys, kind="stable")
            keys, tfs = keys[order], tfs[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, tfs = keys[first], np.add.reduceat(tfs, first)
        return keys & 0xFFFFFFFF, keys >> 32, tfs

    def rows(self, segment: int) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        own = [(m, d is None, d or 0, k) for k, (m, d) in enumerate(zip(self.ms, self.ids, strict=True))]
        order = np.array([x[3] for x in sorted(own)], np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        ms, stratum = np.unique(np.array(self.ms, np.int64)[order], return_inverse=True)
        term, doc, tf = self.postings()
        kinds, tf_rank = np.unique(tf, return_inverse=True)
        # Within a term by stratum, tf and place. The four numbers fit in 63 bits as a segment is bounded.
        key = ((term * len(ms) + stratum[place[doc]]) * len(kinds) + tf_rank) * len(order) + place[doc]
        key.sort()
        key, ords = np.divmod(key, len(order))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(first, len(key)))
        rest, tf_rank = np.divmod(key[first], len(kinds))
        term, strata = np.divmod(rest, len(ms))
        group_ends = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        ends = np.append(first, len(key))[group_ends]

        def lists(offsets, values, kind):
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

        n, none = len(self.vocabulary), lambda n, kind: pa.nulls(n, kind)
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        whole = pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, segment)), pa.array(list(self.vocabulary), pa.binary()), pa.array(np.diff(ends)),
                lists(group_ends, strata, pa.int32()), lists(group_ends, kinds[tf_rank], pa.int32()),
                lists(group_ends, sizes, pa.int32()), lists(ends, ords, pa.int32()),
                none(n, longs), none(n, ints), none(n, longs),
            ],
            names=INDEX_NAMES,
        )
        lengths = np.bincount(stratum, minlength=len(ms)).tolist()
        ids = [self.ids[k] for k in order.tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([segment], pa.int64()), none(1, pa.binary()), none(1, pa.int64()),
                *[none(1, ints)] * 4,
                pa.array([ms.tolist()], longs), pa.array([lengths], ints), pa.array([ids], longs),
            ],
            names=INDEX_NAMES,
        )
        for at in range(0, n, 8192):
            yield whole.slice(at, 8192)


INDEX_NAMES = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]


@dataclass(frozen=True)
class Index:
    """``rows``: one row per segment and term, and one per segment (term null) with its strata."""

    rows: DataFrame
    documents: int
    total: int


def build_index(docs: DataFrame) -> Index:
    """The stored index of every row of ``docs`` (doc_id, text) that has a term."""
    texts = docs.select("doc_id", utf8(F.col("text")).alias("text"))

    def lengths(batches) -> Iterator[list[tuple]]:
        for batch in small_batches(batches):
            sizes = [sum(map(len, terms(t))) for t in batch["text"]]
            yield [(sum(1 for n in sizes if n), sum(sizes))]

    totals = by_arrow(texts.select("text"), lengths, "documents long, total long")
    documents, total = totals.agg(F.sum("documents"), F.sum("total")).first()
    documents, total = documents or 0, total or 0

    def segments(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        segment = Segment(documents, total)
        for batch in small_batches(batches):
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                # A text has half as many terms as characters at most.
                if segment.tokens and segment.tokens + len(text) // 2 > 2 * TOKENS:
                    yield from segment.rows(number)
                    number, segment = number + 1, Segment(documents, total)
                segment.add(doc_id, text)
                if segment.tokens >= TOKENS or len(segment.ids) >= ROWS:
                    yield from segment.rows(number)
                    number, segment = number + 1, Segment(documents, total)
        yield from segment.rows(number)

    return Index(stored(texts.mapInArrow(segments, INDEX_SCHEMA)), documents, total)


def weights(index: Index, wanted: DataFrame) -> dict[bytes, int]:
    """The weight of each wanted term that the index holds."""
    found = index.rows.select("term", "df").join(F.broadcast(wanted), "term", "left_semi")
    return {
        bytes(r["term"]): math.floor(1000 * math.log((2 * index.documents + 2) / (2 * r["df"] + 1)))
        for r in found.groupBy("term").agg(F.sum("df").alias("df")).collect()
    }


class Searcher:
    """One segment's postings of the wanted terms."""

    def __init__(self, rows: pa.Table) -> None:
        head = rows.filter(pc.is_null(rows["term"])).to_pylist()[0]
        rows = rows.filter(pc.is_valid(rows["term"]))
        self.ids, self.ms = head["ids"], np.array(head["ms"], np.int64)
        self.terms = {t: k for k, t in enumerate(rows["term"].to_pylist())}

        def flat(name: str) -> np.ndarray:
            return rows[name].combine_chunks().flatten().to_numpy().astype(np.int64)

        tfs, strata, n_strata = flat("tfs"), flat("strata"), len(self.ms)
        groups = rows["tfs"].combine_chunks().value_lengths().to_numpy()
        self.ords, self.sizes = flat("ords"), flat("sizes")
        self.starts = np.cumsum(self.sizes) - self.sizes
        # One impact for each tf of a stratum.
        width = int(tfs.max(initial=0)) + 1
        kinds, of = np.unique(strata * width + tfs, return_inverse=True)
        tf, m = kinds % width, self.ms[kinds // width]
        self.impacts = ((1_000_000_000 * tf) // (1000 * tf + 8 * m))[of]
        # Each term's groups of a stratum follow one another by tf, so the last has the largest impact.
        key = np.repeat(np.arange(len(groups)), groups) * n_strata + strata
        self.first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        self.next = np.append(self.first[1:], len(key)) if len(key) else self.first
        self.keys = key[self.first]
        self.most = self.impacts[self.next - 1] if len(key) else self.impacts
        self.bounds = np.searchsorted(self.keys, np.arange(len(groups) + 1) * n_strata)
        self.scores = np.zeros(len(self.ids), np.int64)

    def stratum_bounds(self, own: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The highest score that a document of each stratum can have."""
        sizes = self.bounds[own + 1] - self.bounds[own]
        at = ranges(self.bounds[own], sizes)
        out = np.zeros(len(self.ms), np.int64)
        np.add.at(out, self.keys[at] % len(self.ms), self.most[at] * np.repeat(weight, sizes))
        return out

    def scored(self, own: np.ndarray, weight: np.ndarray, strata: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents of these strata that hold a term."""
        wanted = own[:, None] * len(self.ms) + strata
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        at, weight = at[hit], np.broadcast_to(weight[:, None], wanted.shape)[hit]
        n_groups = self.next[at] - self.first[at]
        groups = ranges(self.first[at], n_groups)
        gains = self.impacts[groups] * np.repeat(weight, n_groups)
        places = self.ords[ranges(self.starts[groups], self.sizes[groups])]
        np.add.at(self.scores, places, np.repeat(gains, self.sizes[groups]))
        places = np.unique(places)
        scores = self.scores[places]
        self.scores[places] = 0
        return places[scores > 0], scores[scores > 0]

    def best(self, query: list[tuple[bytes, int]], k: int) -> list[tuple[int | None, int]]:
        """The k highest-scoring documents of the segment for (term, weight) pairs."""
        query = [(self.terms[t], w) for t, w in query if w and t in self.terms]
        if not query:
            return []
        own, weight = np.array(query, np.int64).T
        bounds = self.stratum_bounds(own, weight)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        found: list[tuple[int, bool, int, int]] = []
        at, step = 0, 8
        while at < len(order):
            some = order[at : at + step]
            if len(found) == k:  # an equal score may still have a smaller doc_id
                some = some[bounds[some] >= -found[-1][0]]
                if not len(some):
                    break
            places, scores = self.scored(own, weight, some)
            if len(scores) > 4 * k:
                keep = scores >= np.partition(scores, -k)[-k]
                places, scores = places[keep], scores[keep]
            for place, score in zip(places.tolist(), scores.tolist(), strict=True):
                doc_id = self.ids[place]
                found.append((-score, doc_id is None, doc_id or 0, place))
            found = sorted(found)[:k]
            at, step = at + step, 2 * step
        return [(self.ids[f[3]], -f[0]) for f in found]


def query_terms(queries: DataFrame, id_column: str) -> DataFrame:
    """id, terms and their repeats of each distinct query that has a term."""

    def run(batches) -> Iterator[list[tuple]]:
        for batch in small_batches(batches):
            counted = [(i, Counter(t for part in terms(x) for t in part)) for i, x in zip(batch["id"], batch["text"], strict=True)]
            yield [(i, list(c), list(c.values())) for i, c in counted if c]

    own = queries.select(F.col(id_column).alias("id"), utf8(F.col("text")).alias("text")).distinct()
    kind = dict(own.dtypes)["id"]
    return stored(by_arrow(own, run, f"id {kind}, terms array<binary>, times array<long>"))


def segment_task(queries, k: int) -> Callable[[pa.Table], pa.Table]:
    """The function that finds the best documents of one segment for all broadcast ``queries``."""

    def run(segment: pa.Table) -> pa.Table:
        searcher = Searcher(segment)
        found = [(q, d, s) for q, query in enumerate(queries.value) for d, s in searcher.best(query, k)]
        columns = zip(*found, strict=True) if found else [[], [], []]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query", "doc_id", "score"])

    return run


def search(index: Index, queries: DataFrame, k: int, id_column: str = "item_id") -> DataFrame:
    """``id_column``, rank (from 1), doc_id and score of each query's k best documents.

    The queries go to the tasks in blocks of about ``BLOCK`` terms, each with a pass over the
    index rows of its terms.
    """
    spark = index.rows.sparkSession
    wanted = query_terms(queries, id_column)
    blocks = math.ceil((wanted.agg(F.sum(F.size("terms"))).first()[0] or 0) / BLOCK)
    out = None
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("terms", "times"), F.lit(blocks)) == block)
        own = part.select(F.explode("terms").alias("term")).distinct()
        weight = weights(index, own)
        rows = [(r["id"], [(bytes(t), weight.get(bytes(t), 0) * n) for t, n in zip(r["terms"], r["times"], strict=True)]) for r in part.collect()]
        sent = spark.sparkContext.broadcast([q for _, q in rows])

        terms_ = index.rows.join(F.broadcast(own), "term", "left_semi")
        heads = index.rows.where("term is null")
        hits = terms_.select(INDEX_NAMES).union(heads.select(INDEX_NAMES)).groupBy("segment")
        hits = hits.applyInArrow(segment_task(sent, k), HIT_SCHEMA)
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        hits = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        kind = dict(wanted.dtypes)["id"]
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(rows)], f"query int, id {kind}")
        # As many rows as the block has queries.
        hits = hits.join(F.broadcast(names), "query").select(F.col("id").alias(id_column), "rank", "doc_id", "score")
        out = hits if out is None else out.union(hits)
    if out is None:
        kind = dict(wanted.dtypes)["id"]
        return spark.createDataFrame([], f"{id_column} {kind}, rank int, doc_id long, score long")
    return out


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), 10)


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
postings AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
normalisers AS (SELECT doc_id, 100 - 75 + ((75 * n * docs) // total) AS m FROM lengths, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM postings GROUP BY term), totals
),
items AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM (SELECT item_id, term, count(*) AS times FROM items GROUP BY ALL)
  JOIN weights USING (term) JOIN postings USING (term) JOIN normalisers USING (doc_id)
  GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
