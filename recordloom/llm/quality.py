"""Operator 4: quality scores of a factorisation machine over words, structure and length.

A text's features are its lower-case words, hashed to ``WORDS`` numbers and weighted by the
root of their counts at unit length, and ``STATS`` statistics of its structure (shares of
kinds of characters, repeats of words and lines, mean lengths, size). The score is the
logistic of a constant, a weight per feature and the dot products of all pairs of features'
vectors, summed in linear time as half of (square of sums - sum of squares).

Labels are learned from rows whose crc32 of ``doc_id`` as text is not divisible by 5; of
those a sample of about ``bound`` rows is drawn by a hash of the id. Nothing but the text
enters a score. Null texts score like empty ones. Repeated rows score alike. A table
without both labels gives the constant 0.5. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import by_arrow, small_batches, table, utf8

WORDS = 1 << 14
STATS = 20
RANK = 8
BOUND = 12_000
THRESHOLD = 0.3
KEPT = 300_000


class Model(NamedTuple):
    constant: float
    weights: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray


class Features:
    """Turns texts into (feature numbers, values); hashes each distinct word once per task."""

    def __init__(self) -> None:
        self.hashed: dict[str, int] = {}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = text.split()
        known = self.hashed
        if len(known) > KEPT:
            known.clear()
        for word in set(words).difference(known):
            known[word] = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORDS
        numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        found, counts = np.unique(numbers, return_counts=True)
        values = np.sqrt(counts).astype(np.float32)
        values /= max(1e-9, float(np.sqrt(counts.sum())))
        return found, values, structure(text, words, numbers, counts)


def structure(text: str, words: list[str], numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The statistics; all zero for a text without words."""
    out = np.zeros(STATS, np.float32)
    if not words:
        return out
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size, n = len(text), len(words)
    lines = text.split("\n")
    kinds = Counter(lines)
    upper, lower, digits = raw[65:91].sum(), raw[97:123].sum(), raw[48:58].sum()
    symbols = raw[33:127].sum() - upper - lower - digits
    stops = raw[33] + raw[44] + raw[46] + raw[63]
    again = float((numbers[1:] == numbers[:-1]).mean()) if n > 1 else 0.0
    out[:] = (
        upper / size,
        lower / size,
        digits / size,
        symbols / size,
        stops / n,
        (symbols - stops) / n,
        raw[124] / n,
        raw[33] / n,
        raw[10] / n,
        (size - n) / n,
        len(counts) / n,
        counts.max() / n,
        again,
        len(kinds) / len(lines),
        max(kinds.values()) / len(lines),
        np.log1p(size),
        np.log1p(n),
        np.log1p(size / len(lines)),
        sum(w[0].isupper() for w in words) / n,
        (raw[60] + raw[62] + raw[123] + raw[125] + raw[92]) / n,
    )
    return out


def is_held_out(doc_id: Column) -> Column:
    """False for a null id: such a row is labelled by nothing and is never learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def scores_of(model: Model, found: list[np.ndarray], values: list[np.ndarray], stats: np.ndarray) -> np.ndarray:
    """The machine's sums (before the logistic) for a few texts."""
    numbers, x = np.concatenate(found), np.concatenate(values)
    starts = np.concatenate([[0], np.cumsum([len(f) for f in found])])
    scaled = np.clip((stats - model.mean) / model.spread, -4, 4).astype(np.float32)
    v, w = model.vectors, model.weights

    def each(rows: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=np.float64)])
        return total[starts[1:]] - total[starts[:-1]]

    products = v[numbers] * x[:, None]
    sums = each(products) + scaled @ v[WORDS:]
    squares = each(products**2) + scaled**2 @ v[WORDS:] ** 2
    linear = each((w[numbers] * x)[:, None])[:, 0] + scaled @ w[WORDS:]
    return model.constant + linear + 0.5 * (sums**2 - squares).sum(axis=1)


def fit(found: list[np.ndarray], values: list[np.ndarray], stats: np.ndarray, labels: np.ndarray) -> Model:
    """Adaptive gradient steps on the logistic loss, in a fixed order.

    Ends with the second pass over the rows that lowers the loss by less than a hundredth,
    or by less than a thousandth of a nat.
    """
    order = np.random.default_rng(7)
    size = WORDS + STATS
    mean, spread = stats.mean(axis=0), stats.std(axis=0) + 1e-3
    model = Model(
        float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))),
        np.zeros(size, np.float32),
        order.normal(0, 0.02, (size, RANK)).astype(np.float32),
        mean,
        spread,
    )
    past_w, past_v = np.full(size, 1e-6, np.float32), np.full((size, RANK), 1e-6, np.float32)
    constant, batch, epochs = model.constant, 256, max(4, min(40, 400_000 // len(labels)))
    best, idle = np.inf, 0
    for _ in range(epochs):
        turn, loss = order.permutation(len(labels)), 0.0
        for start in range(0, len(turn), batch):
            some = turn[start : start + batch]
            f, x = [found[i] for i in some], [values[i] for i in some]
            now = model._replace(constant=constant)
            p = 1 / (1 + np.exp(-np.clip(scores_of(now, f, x, stats[some]), -30, 30)))
            loss -= float(np.log(np.where(labels[some] > 0, p, 1 - p)).sum()) / len(labels)
            slope = ((p - labels[some]) / len(some)).astype(np.float32)
            constant -= 0.1 * float(slope.sum())
            # Every text's features, structure included, as one long list of (text, feature, value).
            lengths = np.array([len(i) for i in f])
            scaled = np.clip((stats[some] - mean) / spread, -4, 4).astype(np.float32)
            row = np.concatenate([np.repeat(np.arange(len(some)), lengths), np.repeat(np.arange(len(some)), STATS)])
            col = np.concatenate([*f, np.tile(np.arange(WORDS, size), len(some))])
            val = np.concatenate([*x, scaled.ravel()])
            weight = slope[row] * val
            touched = np.bincount(col, minlength=size) > 0
            grad_w = np.bincount(col, weight, size) + 1e-5 * model.weights * touched
            past_w += grad_w**2
            model.weights[:] -= 0.1 * grad_w / np.sqrt(past_w)
            grad_v = np.empty_like(model.vectors)
            for k in range(RANK):
                products = model.vectors[col, k] * val
                sums = np.bincount(row, products, len(some))
                grad_v[:, k] = np.bincount(col, weight * (sums[row] - products), size)
            grad_v += 1e-4 * model.vectors * touched[:, None]
            past_v += grad_v**2
            model.vectors[:] -= 0.03 * grad_v / np.sqrt(past_v)
        idle = idle + 1 if loss > min(0.99 * best, best - 0.001) else 0
        best = min(best, loss)
        if idle == 2:
            break
    return model._replace(constant=constant)


def trained(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> Model | None:
    """The model of a sample of about ``bound`` labelled rows; None without both labels."""
    known = labels.where(F.col("quality").isin(0, 1) & ~is_held_out(F.col("doc_id"))).select("doc_id", "quality")
    total = known.count()
    if total > bound:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * bound / total))

    def extract(batches) -> Iterator[list[tuple]]:
        features = Features()
        for batch in small_batches(batches):
            out = []
            for text, quality in zip(batch["text"], batch["quality"], strict=True):
                found, values, stats = features(text)
                out.append((quality, found.astype("<i4").tobytes(), values.tobytes(), stats.tobytes()))
            yield out

    rows = docs.select("doc_id", utf8(F.col("text")).alias("text"))
    rows = rows.join(known, "doc_id").select("text", F.col("quality").cast("int").alias("quality"))
    got = by_arrow(rows, extract, "quality int, found binary, vals binary, stats binary").collect()
    if len({r.quality for r in got}) < 2:
        return None
    got.sort(key=lambda r: (zlib.crc32(r.found), zlib.crc32(r.stats), r.quality))
    return fit(
        [np.frombuffer(r.found, "<i4").astype(np.int64) for r in got],
        [np.frombuffer(r.vals, np.float32) for r in got],
        np.stack([np.frombuffer(r.stats, np.float32) for r in got]),
        np.array([r.quality for r in got], np.float32),
    )


def score_column(model: Model | None, text: Column) -> Column:
    """The probability of label 1 of every whole text."""

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for batch in texts:
            out = []
            for start in range(0, len(batch), 128):
                part = [features(t) for t in batch.iloc[start : start + 128]]
                if model is None:
                    out.append(np.full(len(part), 0.5))
                    continue
                raw = scores_of(model, [p[0] for p in part], [p[1] for p in part], np.stack([p[2] for p in part]))
                out.append(1 / (1 + np.exp(-np.clip(raw, -30, 30))))
            yield pd.Series(np.concatenate(out) if out else [], dtype=float)

    return F.pandas_udf(score, "double")(utf8(text))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = trained(docs, table(spark, sf_dir, "labels"))
    return docs.withColumn("score", score_column(model, F.col("text"))).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
