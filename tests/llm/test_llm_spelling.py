"""Spelling variants against a comparison of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import SCHEMA

from recordloom.llm import spelling
from recordloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return len(b) == len(a) + 1 and a[k:] == b[k + 1 :]


def grouped(counts, ratio=10):
    """Rows of (word, form, root, n, n_near, form_n) from {word: n}."""
    shapes = {}
    for w in counts:
        for d in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shapes.setdefault(d, set()).add(w)
    others = {w: {x for d in (w, *(w[:i] + w[i + 1 :] for i in range(len(w)))) for x in shapes[d] if near(w, x)} for w in counts}
    form = {}
    for w, own in others.items():
        best = min(own, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(others[w]), counts.get(form[w])))
    return sorted(out)


def found(frame):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def contract(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert found(QUERIES["op13_spelling_variants"](spark, FOLDER)) == grouped(contract(docs))


@pytest.mark.parametrize(("room", "slice_words"), [(64_000_000, 1 << 16), (600, 7), (100, 50)])
def test_passes_and_slices(spark, monkeypatch, room, slice_words):
    monkeypatch.setattr(spelling, "FILTER_BYTES", room)
    monkeypatch.setattr(spelling, "SLICE_WORDS", slice_words)
    draw = random.Random(4)
    counts = {"".join(draw.choices("aabcé", k=draw.randint(1, 7))): draw.choice([1, 2, 9, 10, 11, 100, 1001]) for _ in range(220)}
    counts |= {"": 3, "z" * 4000: 5, "z" * 3999: 50, "z" * 2000 + "y" + "z" * 1999: 500, "日本語": 4, "日本": 40, "日語": 40, "😀a": 1, "a": 900}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert found(spelling.variants(words)) == grouped(counts)


def test_chains_ties_and_odd_documents(spark):
    docs = [(k, "aaaaaaaa " * 4 + "baaaaaaa caaaaaaa " * 50 + "bbaaaaaa " * 600) for k in range(3)]
    docs += [(None, "Naïveté× naïveté× NAïVETÉ×"), (None, None), (5, ""), (6, "ab " * 40), (6, "ab " * 40), (7, "q" * 3_000 + " " + "q" * 3_000)]
    frame = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], SCHEMA)
    counts = contract(docs)
    got = found(spelling.variants(spelling.counted(spelling_words(frame), 7, 2)))
    assert got == grouped(counts)
    assert any(r[2] != r[1] for r in got if r[1])  # a form that has a form itself


def spelling_words(frame):
    return spelling.with_deletions(spelling.runs(frame, 7), 31)


def test_every_edit_is_generated_once():
    draw = random.Random(1)
    words = sorted({"".join(draw.choices("abcd", k=5)) for _ in range(300)})
    letters = np.array([ord(c) for c in "dcab"], np.uint32)
    shards = {n: spelling.Shard(10) for n in (4, 5)}
    for s in shards.values():
        s.fill({0: np.full(s.blocks, np.uint64(2**64 - 1))}, [0])
    keys = dict(zip(spelling.word_keys(words, 5).tolist(), words, strict=True))
    made = Counter()
    for word, own in spelling.edits(spelling.code_points(words, 5), letters, shards):
        made.update(frozenset((words[w], keys[k])) for w, k in zip(word.tolist(), own.tolist(), strict=True) if k in keys)
    wanted = {frozenset((a, b)) for a in words for b in words if near(a, b)}
    assert set(made) == wanted and set(made.values()) == {1}
