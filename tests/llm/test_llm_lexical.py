"""Ranked search against a plain loop over all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from llm_rows import SCHEMA

from recordloom.llm import lexical
from recordloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w.translate(FOLD) for w in TERM.findall(text or "")]


def ranked(docs, items, k):
    """(item_id, rank, doc_id, score) of documents and items given as (id, text)."""
    counted = [(d, Counter(words(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n, total = len(counted), sum(x[2] for x in counted)
    df = Counter(w for _, c, _ in counted for w in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, length in counted:
            m = 100 - 75 + (75 * length * n) // total
            score = 0
            for w in words(text):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                    score += weight * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m))
            if score:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert found(QUERIES["op11_lexical_search"](spark, FOLDER)) == ranked(docs, items, 10)


@pytest.mark.parametrize(("tokens", "rows", "block"), [(1 << 21, 1 << 14, 100_000), (90, 1 << 14, 9), (1 << 21, 3, 20)])
def test_many_segments_blocks_and_ties(spark, monkeypatch, tokens, rows, block):
    for name, value in (("TOKENS", tokens), ("ROWS", rows), ("BLOCK", block)):
        monkeypatch.setattr(lexical, name, value)
    draw = random.Random(5)
    vocabulary = [f"w{int(draw.paretovariate(0.7))}" for _ in range(400)]
    docs = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 8, 8, 8, 60])))) for k in range(160)]
    docs += [(200 + k, docs[7][1]) for k in range(30)] + [(None, docs[7][1]), (None, None), (400, ""), (401, "- - !")]
    docs += [(7, docs[7][1]), (402, "Éa ÉA éa x\x1fy 東京 w1-W1"), (403, "w1 " * 700)]
    items = [(k, " ".join(draw.choices(vocabulary, k=9))) for k in range(12)]
    items += [(20, docs[7][1]), (21, "Éa x y 東京 W1 w1 w1"), (22, "nothing here"), (23, None), (None, "w1 w2")]
    frame = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], SCHEMA).repartition(5)
    queries = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    for k in (1, 4, 50):
        assert found(lexical.search(lexical.build_index(frame), queries, k)) == ranked(docs, items, k)


def test_index_holds_every_document_and_groups_by_stratum(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = lexical.build_index(docs).rows.collect()
    heads = {r.segment: r for r in rows if r.term is None}
    assert sorted(i for r in heads.values() for i in r.ids) == sorted(r.doc_id for r in docs.collect() if words(r.text))
    for r in rows:
        if r.term is None:
            assert sorted(set(r.ms)) == r.ms and sum(r.lengths) == len(r.ids)
        else:
            assert sum(r.sizes) == len(r.ords) == r.df
            groups = list(zip(r.strata, r.tfs, strict=True))
            assert sorted(set(groups)) == groups


def test_slices_do_not_cut_terms(monkeypatch):
    text = "Some wörds, and-a verylongtermthatgoesonandonandon end " * 9 + "x" * 90
    whole = [t for part in lexical.terms(text) for t in part]
    monkeypatch.setattr(lexical, "SLICE", 16)
    assert [t for part in lexical.terms(text) for t in part] == whole == [w.encode() for w in words(text)]
