"""The Jaccard join against a comparison of all pairs of texts."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import SCHEMA

from recordloom.llm import jaccard, simhash
from recordloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if 0 < len(words) < n:
        return {tuple(words)}
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()


def joined(docs, n, percent):
    """doc_id, set size and component of documents (doc_id, text) with distinct ids."""
    sets = [(d, shingles(t, n)) for d, t in docs]
    least = {d: d for d, _ in sets}

    def top(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            common = len(x & y)
            if common and 100 * common >= percent * (len(x) + len(y) - common):
                p, q = top(a), top(b)
                least[max(p, q)] = min(p, q)
    return sorted((d, len(x), top(d)) for d, x in sets)


def found(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect())


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert found(QUERIES["op12_jaccard_join"](spark, FOLDER)) == joined(docs, 4, 85)


@pytest.mark.parametrize(("frequent", "cell", "percent"), [(256, 2048, 85), (2, 2048, 85), (2, 5, 85), (1, 9, 60), (3, 2048, 100)])
def test_edited_copies_and_shared_passages(spark, monkeypatch, frequent, cell, percent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(simhash, "CELL", cell)
    draw = random.Random(9)
    prose = lambda n: [f"w{draw.randrange(400)}" for _ in range(n)]
    passage, texts = prose(60), []
    for size in (1, 3, 4, 5, 8, 9, 10, 30, 23, 100, 400):
        base = prose(size)
        for _ in range(12):
            own = list(base)
            for _ in range(draw.randrange(0, max(2, size // 20))):
                own[draw.randrange(size)] = "edit" + str(draw.randrange(10**6))
            if draw.random() < 0.3:
                own += prose(max(1, size // 12))
            texts.append(" ".join(own))
    texts += [" ".join(passage + prose(draw.randrange(1, 30))) for _ in range(25)]
    # 17 of 20 shingles are common: exactly 0.85; and one less of as many.
    texts += [" ".join(f"x{k}" for k in range(23)), " ".join(f"x{k}" for k in range(20))]
    texts += [" ".join(f"y{k}" for k in range(23)), " ".join(f"y{k}" for k in range(19))]
    texts += ["A b\tC", "a B c", "a b", "", None, " \n", texts[0], texts[0].upper(), "É É É É", "é é é é"]
    docs = list(enumerate(texts))
    draw.shuffle(docs)
    frame = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], SCHEMA).repartition(4)
    assert found(jaccard.similar_sets(frame, 4, percent)) == joined(docs, 4, percent)


def test_null_and_repeated_ids(spark):
    rows = [(3, "a b c d e"), (None, "a b c d e"), (None, "only here"), (5, "x y"), (5, "A B C D E"), (6, "x y"), (None, None)]
    got = jaccard.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        [("3", 2, "3"), ("None", 2, "3"), ("None", 1, "None"), ("5", 1, "5"), ("5", 2, "3"), ("6", 1, "5"), ("None", 0, "None")]
    )


@pytest.mark.parametrize("percent", [51, 85, 97])
def test_similar_sets_share_a_signature(percent):
    draw = np.random.default_rng(percent)
    space = np.sort(draw.integers(1, 2**63, 3000).astype(np.uint64))
    shared = 0
    for _ in range(1500):
        share = draw.choice([0, 0.3, 0.9, 1])
        often = np.sort(draw.permutation(space)[: int(share * len(space))])
        frequent = often, draw.integers(1, 4, len(often))
        size = int(draw.choice([1, 2, 3, 6, 7, 8, 15, 40, 300]))
        own = draw.permutation(space)
        a = np.sort(own[:size])
        most = max(1, size * (100 - percent) // 150) + 1
        lost = draw.integers(0, most)
        b = np.sort(np.concatenate([own[lost:size], own[size : size + draw.integers(0, most)]]))
        common = len(np.intersect1d(a, b))
        if len(a) and len(b) and 100 * common >= percent * (len(a) + len(b) - common) and not np.array_equal(a, b):
            shared += 1
            assert len(np.intersect1d(jaccard.signatures(a, percent, frequent), jaccard.signatures(b, percent, frequent)))
    assert shared > 20


@pytest.mark.parametrize("size", [1 << 18, 20, 1])
def test_hashed_shingles_are_those_of_the_words(monkeypatch, size):
    monkeypatch.setattr(jaccard, "SLICE", size)
    monkeypatch.setattr(jaccard.Powers, "up", np.ones(1, np.uint64))
    texts = ["", " ", "a", "A b", "a B c d", "a b c d", "ab cd", "é\tÉ x\x0b\x1fy z  w", "x" * 50, "", "d c b a " * 9, "a b c d e f g\n" * 5]
    texts += [" ".join(texts), "a b c d"]
    for column in (pa.array(texts), pa.array(["skip", *texts], pa.large_string()).slice(1)):
        for n in (1, 2, 4):
            rows = list(jaccard.token_rows(column, n))
            assert [len(r) for r in rows] == [len(shingles(t, n)) for t in texts]
            seen = {}
            for row, text in zip(rows, texts, strict=True):
                assert seen.setdefault(frozenset(shingles(text, n)), row.tobytes()) == row.tobytes()
            assert len(set(seen.values())) == len(seen)


def test_summary_keeps_what_is_frequent():
    draw = np.random.default_rng(2)
    summary = jaccard.Summary(50)
    tokens = np.concatenate([np.repeat(np.arange(1, 6, dtype=np.uint64), 3000), draw.integers(100, 2**60, 20_000).astype(np.uint64)])
    for part in np.array_split(draw.permutation(tokens), 40):
        summary.add(part)
        summary.settle()
    assert len(summary.keys) <= 50 and {1, 2, 3, 4, 5} <= set(summary.keys.tolist())
    counts = dict(zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))
    assert all(3000 - len(tokens) / 50 <= counts[k] <= 3000 for k in range(1, 6))
