"""Near copies by true shingle sets, at the threshold exactly."""

from __future__ import annotations

import random

import numpy as np
import pytest
from llm_rows import SCHEMA

from recordloom.llm import simhash


def shingles(text, words=5):
    found = text.lower().split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


def survivors(rows, similarity=0.8):
    """Brute force: the smallest id of each group."""
    sets, top = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) / len(a | sets[j]) >= similarity:
                old, new = top[i], top[j]
                top = [new if x == old else x for x in top]
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[top[k]] = min(least.get(top[k], doc_id), doc_id)
    return sorted(least.values())


def test_near_copies_at_the_threshold(spark, monkeypatch):
    rng, rows = random.Random(5), []
    for n in (8, 12, 24, 60, 104, 240, 290, 310, 404, 900):
        for _ in range(12):
            words = [f"w{rng.randrange(10**9)}" for _ in range(n)]
            size = n - 4
            # One less, exactly as many and one more than the words that may be added at the end.
            for extra in {max(1, size // 4 - 1), max(1, size // 4), size // 4 + 1}:
                fresh = [f"{w}{extra}" for w in words]
                more = [f"v{rng.randrange(10**9)}" for _ in range(extra)]
                rows += [(len(rows), " ".join(fresh)), (len(rows) + 1, " ".join(fresh + more))]
    # A chain whose ends are no near copies of each other.
    rows += [(len(rows) + k, " ".join(f"c{i}" for i in range(9 * k, 9 * k + 110))) for k in range(4)]
    frame = spark.createDataFrame([(d, t, None, None, 0) for d, t in rows], SCHEMA)
    wanted = survivors(rows)
    assert len(rows) / 3 < len(wanted) < len(rows)
    assert sorted(r.doc_id for r in simhash.deduplicated(frame).collect()) == wanted
    monkeypatch.setattr(simhash, "SET_BYTES", 3_000)
    assert sorted(r.doc_id for r in simhash.deduplicated(frame).collect()) == wanted


FREQUENT = np.sort(np.random.default_rng(4).integers(0, 1 << 63, 50, np.uint64))


@pytest.mark.parametrize("known", [(), ((FREQUENT, np.arange(3, 53)),)])
def test_all_sets_at_the_threshold_share_a_cell(known):
    rng = np.random.default_rng(3)
    for k in range(3000):
        n = int(rng.integers(5, 400))
        whole = np.unique(np.concatenate([rng.choice(FREQUENT, k % 40), rng.integers(0, 1 << 63, n, np.uint64)]))
        # A part of the whole, and two sets that both have shingles of their own.
        part = rng.choice(whole, -(-4 * len(whole) // 5), replace=False)
        kept, fresh = -(-8 * len(whole) // 9), rng.integers(0, 1 << 63, len(whole) // 9, np.uint64)
        other = np.concatenate([rng.choice(whole, kept, replace=False), fresh])
        for one in (np.unique(part), np.unique(other)):
            cells = [simhash.wide_cells(x, 0.8, *known) for x in (whole, one)]
            assert np.intersect1d(*cells).size


def test_near_copies_come_from_the_grid_join(spark, monkeypatch):
    words = [f"word{i}" for i in range(5000)]
    texts = [" ".join(words), " ".join([*words, "more"]), " ".join(words[::-1]), "", " ".join(words[:20]), " ".join(words[:21])]
    seen, asked = [], []
    near, linked = simhash.near_groups, simhash.linked
    monkeypatch.setattr(simhash, "near_groups", lambda prints, radius=3: seen.append(near(prints, radius)) or seen[-1])
    monkeypatch.setattr(simhash, "linked", lambda rows, *more: asked.append(rows) or linked(rows, *more))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # 0 and 1 differ in few bits of their fingerprints, 4 and 5 in many: those are left to the shingles.
    assert sorted(r.doc_id for r in simhash.deduplicated(docs).collect()) == [0, 2, 3, 4]
    groups = [r.component_id for r in seen[0].collect()]
    assert len(groups) == 5 and len(set(groups)) == 4
    assert asked[-1].select("id").distinct().count() == 2


def test_frequent_shingles_come_from_all_rows(spark):
    docs = spark.range(0, 25_000, 1, 4).selectExpr(
        "id as doc_id",
        "concat('a', id, ' b', id, ' c', id, if(id % 50 = 0, ' one two three', ''), if(id % 2000 = 7, ' four five six', '')) as text",
    )
    counters = simhash.frequent(docs, 3)
    seen = [int(counters[simhash.counter_of(simhash.shingle_hashes(x, 3))[0]]) for x in ("one two three", "four five six")]
    # Other shingles may share a counter, a few of them.
    assert 500 <= seen[0] < 510 and 13 <= seen[1] < 23
    shingles = 3 * 500 + 3 * 13 + 25_000
    assert counters.sum() == shingles
