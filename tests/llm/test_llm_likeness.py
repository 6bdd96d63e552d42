"""Likeness of fingerprints for insertions, long texts and shared passages."""

from __future__ import annotations

import random

from recordloom.llm.syncmers import SIZE, STEP, anchors, chain, fingerprint, likeness


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(words))


def test_text_put_in_the_middle_costs_only_itself():
    text = prose(1, 600)
    half = len(text) // 2
    for size in (20, 60, 200):
        longer = text[:half] + " " + prose(2, size) + " " + text[half:]
        true = 2 * len(text) / (len(text) + len(longer))
        assert abs(likeness(fingerprint(text), fingerprint(longer)) - true) < 0.15


def test_a_passage_of_a_very_long_text_is_seen():
    passage = prose(3, 4_000)
    a, b = prose(4, 30_000) + " " + passage, passage + " " + prose(5, 30_000)
    true = 2 * len(passage) / (len(a) + len(b))
    assert 0.3 * true < likeness(fingerprint(a), fingerprint(b)) < 2.5 * true
    assert likeness(fingerprint(prose(6, 30_000)), fingerprint(prose(7, 30_000))) < 0.01


def test_fingerprints_grow_with_the_text():
    for words in (3, 100, 20_000):
        text = prose(8, words)
        n = len({int(h) >> 24 for h in anchors(text)[0]})
        assert len(fingerprint(text)) == 16 * (n if n <= SIZE else SIZE + (n - SIZE) // STEP)


def test_likeness_is_even_and_bounded():
    texts = ["", "a", "ab", prose(1, 4), prose(1, 40), prose(1, 41), prose(1, 4_000)]
    for a in map(fingerprint, texts):
        assert likeness(a, a) == 1.0
        for b in map(fingerprint, texts):
            assert 0 <= likeness(a, b) <= 1 and likeness(a, b) == likeness(b, a)


def test_chain():
    assert chain([]) == 0
    assert chain([(1, 1), (2, 2), (3, 0), (4, 9), (5, 8)]) == 3
    assert chain([(1, 5), (1, 6), (2, 6)]) == 2
