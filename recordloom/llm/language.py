"""Operator 6: language identification with hyperdimensional profiles.

Each letter has a random vector of ones and minus ones, drawn from its code point. A run of
three characters (letters, lower case; anything else is one blank) binds the letters'
vectors, permuted by their places, into a vector of its own; a text bundles the vectors of
its runs, and a language those of its texts. A text is compared with the languages'
profiles, less what they have in common, by cosine.

Languages are learned from rows with a text and a language whose crc32 of ``doc_id`` as
text is not divisible by 5. Null texts and texts without a letter are ``und`` with score 0,
and so is every text if nothing was learned. Ties go to the first language by name.
Repeated rows are alike. Extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import by_arrow, small_batches, table
from recordloom.llm.quality import is_held_out

DIMENSIONS = 512
KEPT = 60_000
BLANK = 32


class Runs:
    """The three-letter runs of texts, and their vectors, of which a task keeps up to ``KEPT``."""

    def __init__(self) -> None:
        self.alpha = np.fromiter((chr(c).isalpha() for c in range(0x30000)), bool, 0x30000)
        self.letters: dict[int, np.ndarray] = {}
        self.places: dict[int, int] = {}
        self.rows = np.empty((1024, DIMENSIONS), np.float32)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The distinct runs and their counts; none if no letter is there."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        letter = self.alpha[np.minimum(points, 0x2FFFF)]
        if not letter.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        points = np.where(letter, points, BLANK)
        blank = ~letter
        points = points[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
        points = np.concatenate([[BLANK], points, [BLANK]])
        return np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:], return_counts=True)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            draw = np.random.Generator(np.random.PCG64(point)).integers(0, 2, DIMENSIONS)
            self.letters[point] = (2 * draw - 1).astype(np.float32)
        return self.letters[point]

    def vectors(self, runs: np.ndarray) -> np.ndarray:
        """A row for each run."""
        if len(self.places) + len(runs) > KEPT:
            self.places.clear()
        places = self.places
        for run in runs.tolist():
            if run not in places:
                at = places[run] = len(places)
                if at >= len(self.rows):
                    self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
                a, b, c = (self.letter(run >> s & 0x1FFFFF) for s in (42, 21, 0))
                self.rows[at] = np.roll(a, 2) * np.roll(b, 1) * c
        return self.rows[[places[run] for run in runs.tolist()]]


def profiles(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages of ``docs`` (text, lang) and their unit profiles less their mean."""

    def bundle(batches) -> Iterator[list[tuple]]:
        runs, seen = Runs(), defaultdict(lambda: defaultdict(int))
        totals: dict[str, np.ndarray] = {}

        def settle() -> None:
            for lang, counts in seen.items():
                keys = np.fromiter(counts, np.int64, len(counts))
                values = np.fromiter(counts.values(), np.float64, len(counts))
                total = totals.setdefault(lang, np.zeros(DIMENSIONS))
                for start in range(0, len(keys), 4096):
                    total += values[start : start + 4096] @ runs.vectors(keys[start : start + 4096])
            seen.clear()

        for batch in small_batches(batches, 64):
            by_lang = defaultdict(list)
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                by_lang[lang].append(text)
            for lang, texts in by_lang.items():
                # A line break is a blank, so no run reaches from one text into the next.
                keys, counts = runs.of("\n".join(texts))
                mine = seen[lang]
                for key, count in zip(keys.tolist(), counts.tolist(), strict=True):
                    mine[key] += count
            if sum(map(len, seen.values())) > KEPT:
                settle()
        settle()
        yield [(lang, k, float(x)) for lang, total in totals.items() for k, x in enumerate(total)]

    parts = by_arrow(docs, bundle, "lang string, k int, x double")
    # One number per language and dimension, however many rows were learned from.
    rows = parts.groupBy("lang", "k").agg(F.sum("x").alias("x")).collect()
    names = sorted({r.lang for r in rows})
    out = np.zeros((len(names), DIMENSIONS))
    place = {name: i for i, name in enumerate(names)}
    for r in rows:
        out[place[r.lang], r.k] = r.x
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    if len(names) > 1:
        out -= out.mean(axis=0)
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return names, out.astype(np.float32)


def identified(docs: DataFrame, names: list[str], known: np.ndarray) -> DataFrame:
    """doc_id, lang_pred and score of ``docs`` (doc_id, text)."""

    def run(batches) -> Iterator[list[tuple]]:
        runs = Runs()
        for batch in small_batches(batches, 64):
            found = [runs.of(text or "") for text in batch["text"]]
            every = np.unique(np.concatenate([keys for keys, _ in found]))
            likeness = np.zeros((len(found), len(names)), np.float32)
            if len(every) and names:
                held = np.zeros((len(found), len(every)), np.float32)
                for i, (keys, counts) in enumerate(found):
                    held[i, np.searchsorted(every, keys)] = counts
                bundles = np.zeros((len(found), DIMENSIONS), np.float32)
                for start in range(0, len(every), 8192):
                    bundles += held[:, start : start + 8192] @ runs.vectors(every[start : start + 8192])
                bundles /= np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-9)
                likeness = bundles @ known.T
            out = []
            for doc_id, (keys, _), row in zip(batch["doc_id"], found, likeness, strict=True):
                if not len(keys) or not names:
                    out.append((doc_id, "und", 0.0))
                else:
                    best = int(np.argmax(row))
                    out.append((doc_id, names[best], float(min(1.0, max(0.0, row[best])))))
            yield out

    return by_arrow(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = docs.where(~is_held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    names, known = profiles(learned.select("text", "lang"))
    return identified(docs, names, known).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
