"""Operator 8: benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

Texts and items are lower-case words (runs of letters, digits and underscores). Each run of
``SEED`` words of an item is a seed (of a shorter item: all its words). A first pass counts
in how many rows of the corpus each seed occurs; a seed's rarity is ``log(1 + rows / count)``
over ``log(1 + rows)``, 1 for a seed of one row. A second pass looks up the seeds in every
text. An item is aligned by Smith-Waterman over words with every place that holds a seed of
it, however common, unless too few of its words are there to reach ``threshold``; rarity only
sets the order, so that ``clean`` meets the likely leaks first. An item counts as leaked if
the alignment's score reaches ``threshold`` of the score of a whole copy.

Items go to the tasks in blocks of at most ``BLOCK`` characters, one pass over the texts
for each, so what is broadcast is bounded. Texts are never exchanged.

Null and empty texts and items without words match nothing. Repeated rows are reported each
for themselves, and so are repeated items. A text that holds an item twice is reported with
its best place, the first of equal ones. Extra columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import by_arrow, small_batches, table, utf8

SEED = 3
THRESHOLD = 0.5
BLOCK = 32_000_000
MATCH, OTHER, GAP = 2, -1, 1
WORD = re.compile(r"\w+")


def seeds(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs of ``n`` words that have a number each, and a hash of each run."""
    count = max(0, len(words) - n + 1)
    known = np.ones(count, bool)
    for k in range(n):
        known &= words[k : count + k] != 0
    at = np.flatnonzero(known)
    out = np.full(len(at), n, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[at + k]
        out ^= out >> np.uint64(29)
    return at, out


class Items:
    """The items of a block: their words, numbered, and their seeds in ascending order with their places."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.ids = [item_id for item_id, _ in rows]
        listed = [WORD.findall(text.lower()) for _, text in rows]
        # Words of no item are number 0, which matches nothing.
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for words in listed for w in words}), 1)}
        self.words = [self._numbers(words) for words in listed]
        self.lengths = sorted({min(SEED, len(w)) for w in self.words if len(w)})
        places = defaultdict(list)
        for i, w in enumerate(self.words):
            if len(w):
                for at, seed in zip(*(x.tolist() for x in seeds(w, min(SEED, len(w)))), strict=True):
                    places[seed].append((i, at))
        self.seeds = np.array(sorted(places), np.uint64)
        self.places = [places[s] for s in self.seeds.tolist()]
        self.rarity = np.ones(len(self.seeds))

    def _numbers(self, words: list[str]) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in words], np.uint64)

    def numbers(self, text: str) -> np.ndarray:
        return self._numbers(WORD.findall(text.lower()))

    def found(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places in the text, numbers of seeds) for each length of seeds."""
        out = []
        for n in self.lengths:
            places, here = seeds(words, n)
            at = np.searchsorted(self.seeds, here)
            at[at == len(self.seeds)] = 0
            hit = np.flatnonzero(self.seeds[at] == here) if len(self.seeds) else np.zeros(0, np.int64)
            out.append((places[hit], at[hit]))
        return out

    def regions(self, words: np.ndarray, reach: Callable[[int], int]) -> Iterator[tuple[int, int, int]]:
        """(item, first word, end) of the places of the text worth aligning, items with rare seeds first.

        ``reach`` tells by how many words an item of that length may be shifted within a place.
        """
        lines, rare = defaultdict(list), defaultdict(float)
        for hits, numbers in self.found(words):
            for place, number in zip(hits.tolist(), numbers.tolist(), strict=True):
                for item, at in self.places[number]:
                    lines[item].append(place - at)
                    rare[item] += self.rarity[number]
        for item in sorted(lines, key=lambda i: (-rare[i], i)):
            hits, n = sorted(lines[item]), len(self.words[item])
            shift, start = reach(n), 0
            for k in range(1, len(hits) + 1):
                if k == len(hits) or hits[k] - hits[k - 1] > shift:
                    yield item, max(0, hits[start] - shift), min(len(words), hits[k - 1] + n + shift)
                    start = k


def aligned(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The best local score and the end of its first place in ``text``, row by row of the item."""
    row = np.zeros(len(text) + 1, np.int64)
    steps = GAP * np.arange(len(text) + 1)
    best, end = 0, 0
    for word in item:
        new = np.maximum(row - GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(text == word, MATCH, OTHER))
        # A gap along the row costs its length: the running maximum of what precedes it.
        row = np.maximum.accumulate(new + steps) - steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def scores(items: Items, words: np.ndarray, threshold: float) -> Iterator[tuple[int, float, int, int]]:
    """(item, share of the score, first word of the place, end of the alignment) of the items in a text."""
    # Each gap takes from the score of a whole copy, so an alignment has no more of them than that.
    for item, low, high in items.regions(words, lambda n: math.ceil(MATCH / GAP * n * (1 - threshold))):
        wanted = items.words[item]
        # No alignment has more matches than the item has words that occur in the place.
        if np.count_nonzero(np.isin(wanted, words[low:high])) / len(wanted) < threshold:
            continue
        score, end = aligned(wanted, words[low:high])
        share = score / (MATCH * len(wanted))
        if share >= threshold:
            yield item, share, low, low + end


def leaks(items: Items, text: str, threshold: float) -> Iterator[tuple]:
    """(item, score, first character, end) of the items that a text holds."""
    words = items.numbers(text)
    best: dict[int, tuple[float, int, int]] = {}
    for item, share, low, end in scores(items, words, threshold):
        if share > best.get(item, (0.0, 0, 0))[0]:
            # The start is the end of the same alignment read backwards.
            back = aligned(items.words[item][::-1], words[low:end][::-1])[1]
            best[item] = share, end - back, end
    if best:
        spans = [m.span() for m in WORD.finditer(text)]
        same = len(spans) == len(words)
        for item, (share, start, end) in sorted(best.items()):
            yield (
                items.ids[item],
                share,
                spans[start][0] if same else None,
                spans[end - 1][1] if same else None,
            )


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; each is collected when its pass begins."""
    rows = benchmark.select("item_id", utf8(F.col("text")).alias("text"))
    total = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(2 * total / BLOCK))
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()
        yield sorted(((r.item_id, r.text) for r in block), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _ready(texts: DataFrame, benchmark: DataFrame) -> Iterator[Broadcast]:
    """The blocks of items, each with its seeds' rarity in ``texts``, sent to the tasks."""
    context, rows = texts.sparkSession.sparkContext, texts.count()
    for block in _blocks(benchmark):
        items = Items(block)
        shared = context.broadcast(items)

        def count(batches, shared=shared) -> Iterator[list[tuple]]:
            items_ = shared.value
            totals = np.zeros(len(items_.seeds), np.int64)
            for batch in small_batches(batches):
                for text in batch["text"]:
                    for _, numbers in items_.found(items_.numbers(text)):
                        totals[np.unique(numbers)] += 1
            seen = np.flatnonzero(totals)
            yield list(zip(seen.tolist(), totals[seen].tolist(), strict=True))

        # At most one row per seed of the block.
        for r in by_arrow(texts, count, "seed int, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect():
            items.rarity[r.seed] = math.log1p(rows / r.n) / math.log1p(rows)
        yield context.broadcast(items)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row per document and item it holds: doc_id, item_id, score, start_char, end_char."""
    texts = docs.select("doc_id", utf8(F.col("text")).alias("text"))
    parts = []
    for ready in _ready(texts, benchmark):

        def align(batches, ready=ready) -> Iterator[list[tuple]]:
            for batch in small_batches(batches):
                yield [
                    (doc_id, *leak)
                    for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True)
                    for leak in leaks(ready.value, text, threshold)
                ]

        parts.append(
            by_arrow(texts, align, "doc_id long, item_id long, score double, start_char long, end_char long")
        )
    return reduce(DataFrame.unionByName, parts)


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text holds no item."""

    def free_of(ready: Broadcast) -> Column:
        def free(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in texts:
                items = ready.value
                found = (next(scores(items, items.numbers(text), threshold), None) for text in batch)
                yield pd.Series([leak is None for leak in found], dtype=bool)

        return F.pandas_udf(free, "boolean")(utf8(F.col("text")))

    out = docs
    for ready in _ready(docs.select(utf8(F.col("text")).alias("text")), benchmark):
        out = out.where(free_of(ready))
    return out


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
