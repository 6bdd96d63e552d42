"""Items whose seeds are common in the corpus."""

from __future__ import annotations

import random

from llm_rows import SCHEMA

from recordloom.llm import decontamination


def test_edited_copies_of_an_item_that_a_third_of_many_rows_hold(spark):
    rng = random.Random(2)
    item = [f"item{k}" for k in range(16)]
    # Every fourth word changed: four intact seeds.
    edited = [f"other{k}" if k % 4 == 3 else w for k, w in enumerate(item)]
    benchmark = spark.createDataFrame([(0, " ".join(item)), (1, "alpha beta gamma")], "item_id long, text string")
    filler = [" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) for _ in range(3000)]
    rows = [(k, t + (" " + " ".join(item) + " alpha beta gamma" if k % 3 == 0 else "")) for k, t in enumerate(filler)]
    for n in (3000, 30_000):
        # The same texts over and over make the seeds no less common in a larger corpus.
        many = [(k, rows[k % 3000][1]) for k in range(n)] + [(n, "some words " + " ".join(edited) + " and more")]
        docs = spark.createDataFrame([(d, t, None, None, 0) for d, t in many], SCHEMA).repartition(8)
        got = {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(docs, benchmark).collect()}
        assert got.pop((n, 0)) == (2 * 12 - 3) / 32
        assert got == {(k, i): 1.0 for k in range(n) if k % 3000 % 3 == 0 for i in (0, 1)}
        kept = {r.doc_id for r in decontamination.clean(docs, benchmark).collect()}
        assert kept == {k for k in range(n) if k % 3000 % 3}


def test_an_item_with_many_words_put_in():
    item = [f"i{k}" for k in range(40)]
    # Each half holds too little by itself; together they reach the threshold across the words put in.
    text = " ".join(["x"] * 5 + item[:18] + [f"y{k}" for k in range(10)] + item[18:36] + ["z"] * 5)
    items = decontamination.Items([(7, " ".join(item))])
    ((item_id, share, start, end),) = decontamination.leaks(items, text, 0.5)
    assert (item_id, share, text[start:end].split()[0], text[start:end].split()[-1]) == (7, 62 / 80, "i0", "i35")
