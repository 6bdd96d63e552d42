"""Operators against brute force over small tables."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from llm_rows import PROSE, SCHEMA
from tokenizers import Tokenizer

from recordloom.llm import binary_ids, licenses, packing, repeats, secrets, simhash, syncmers, tokens
from recordloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").collect()
    return sorted((r.doc_id, r.text or "", r.lang) for r in rows)


def by_id(rows):
    return {r.doc_id: r for r in rows}


def covered(texts, span):
    seen = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    for t in texts:
        edges = np.zeros(len(t) + 1, int)
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                edges[i] += 1
                edges[i + span] -= 1
        yield np.cumsum(edges)[:-1] > 0


@pytest.mark.parametrize(("hot", "run"), [(4096, 1 << 16), (3, 200)])
def test_repeats(spark, docs, monkeypatch, hot, run):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "RUN", run)
    got = by_id(QUERIES["op1_suffix_dedup"](spark, FOLDER).collect())
    texts = [t.encode() for _, t, _ in docs]
    for (doc_id, _, _), raw, gone in zip(docs, texts, covered(texts, 200), strict=True):
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        n_spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        row = got[doc_id]
        assert (row.n_bytes, row.n_removed, row.n_spans) == (len(raw), int(gone.sum()), n_spans)
        assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeats_of_periodic_and_shifted_texts(spark):
    texts = ["ab" * 300, PROSE, "x" + PROSE[:250] + "y" + PROSE[100:420], "q" * 199, "q" * 200, "z" * 201, PROSE[:199]]
    rows = spark.createDataFrame([(k, t, None, None, 0) for k, t in enumerate(texts)], SCHEMA)
    got = by_id(repeats.removed(rows).collect())
    for k, gone in enumerate(covered([t.encode() for t in texts], 200)):
        assert got[k].n_removed == int(gone.sum()), k


def test_loser_tree_merges_and_counts_shared():
    draw = np.random.default_rng(3)
    runs = [sorted(bytes(draw.integers(97, 99, draw.integers(0, 9)).tolist()) for _ in range(draw.integers(0, 30))) for _ in range(7)]
    tree = repeats.LoserTree([repeats.decoded(repeats.front_coded(r)) for r in runs])
    got = list(tree)
    assert [g[0] for g in got] == sorted(x for r in runs for x in r)
    for a, b in zip(got, got[1:], strict=False):
        assert b[1] == repeats.shared(a[0], b[0], 0)


def test_packing(spark, docs):
    rows = QUERIES["op2_packing"](spark, FOLDER).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: library.encode(t, add_special_tokens=False).ids + [2] for d, t, _ in docs}
    places, cut = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(array("I", part).tobytes()) == r.ids_crc32
        places[r.sequence_id].append((r.offset, r.length))
        cut[r.doc_id].append((r.piece, r.start, r.length))
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 1024
    for doc_id, parts in cut.items():
        assert [p[0] for p in sorted(parts)] == list(range(len(parts)))
        assert sum(p[2] for p in parts) == len(ids[doc_id])
    assert len(places) <= -(-sum(map(len, ids.values())) // 1024) + 2


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2048, 2500, 4097])
def test_only_the_first_piece_is_shorter(spark, n):
    # One id for each " a", and the end id.
    rows = spark.createDataFrame([(7, " a" * (n - 1))], "doc_id long, text string")
    cut = packing.pieces(rows, public_tokenizers.path("byte_bpe_50k.json"), 2, 1024).collect()
    full = (n - 1) // 1024
    starts = [0, *range(n - 1024 * full, n, 1024)]
    assert [(r.piece, r.start, r.length) for r in sorted(cut)] == [
        (k, at, end - at) for k, (at, end) in enumerate(zip(starts, [*starts[1:], n], strict=True))
    ]


def test_tasks_of_a_worker_share_an_encoder(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")

    def run(batches):
        for batch in batches:
            encoder = tokens.encoder_of(path)
            known = len(encoder.units)
            encoder.encode("some words of a text")
            yield pa.RecordBatch.from_pydict({"worker": [os.getpid()], "known": [known]})

    found = spark.range(0, 16, 1, 16).mapInArrow(run, "worker long, known long").collect()
    # Only the first task of a worker, if any, finds the encoder empty.
    assert sum(r["known"] == 0 for r in found) <= len({r["worker"] for r in found}) < 16


def test_exchanges_empty_bins():
    draw = np.random.default_rng(5)
    for _ in range(5):
        lengths = draw.integers(1, 700, 400).tolist()
        first = packing.best_fit(lengths, 1024)
        last = packing.exchange([list(b) for b in first], lengths, 1024)
        assert sorted(i for b in last for i in b) == list(range(400))
        assert max(sum(lengths[i] for i in b) for b in last) <= 1024
        assert len(last) <= len(first)


def slow_patience(text, template):
    here, there = Counter(text), Counter(template)
    pairs = [(i, template.index(w)) for i, w in enumerate(text) if here[w] == 1 and there[w] == 1]
    if not pairs:
        head = 0
        while head < min(len(text), len(template)) and text[head] == template[head]:
            head += 1
        tail = 0
        while tail < min(len(text), len(template)) - head and text[-1 - tail] == template[-1 - tail]:
            tail += 1
        return head + tail
    best = [1] * len(pairs)
    for i in range(len(pairs)):
        best[i] += max((best[j] for j in range(i) if pairs[j][1] < pairs[i][1]), default=0)
    return max(best)


def test_patience():
    draw = np.random.default_rng(1)
    for _ in range(200):
        text, template = draw.integers(0, 12, 10).tolist(), draw.integers(0, 12, 9).tolist()
        pairs = licenses.patience(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) >= slow_patience(text, template)


def test_license_notices(spark, docs):
    got = defaultdict(set)
    for r in QUERIES["op3_license_scan"](spark, FOLDER).collect():
        got[r.doc_id].add(r.license)
    for doc_id, text, _ in docs:
        for name, notice in licenses.LICENSES.items():
            if notice in text:
                assert name in got[doc_id]
    words = licenses.LICENSES["MIT"].split()
    edited = " ".join(["Lead in."] + words[:20] + ["inserted"] + words[22:] + ["End."])
    (row,) = licenses.licensed(spark.createDataFrame([(1, edited, None, None, 0), (2, PROSE, None, None, 0)], SCHEMA)).collect()
    assert (row.doc_id, row.license) == (1, "MIT")
    assert row.coverage > 0.9
    assert edited[row.start_char : row.end_char].startswith("Permission is hereby")


def test_syncmers(spark, docs):
    got = by_id(QUERIES["op5_syncmers"](spark, FOLDER).collect())
    for k, (doc_id, text, _) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        row = got[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == syncmers.fingerprint(text)
        assert row.near_next == syncmers.likeness(syncmers.fingerprint(text), syncmers.fingerprint(following))
    assert np.median([r.near_edited for r in got.values()]) > 0.6
    assert np.median([r.near_next for r in got.values()]) < 0.1


def test_syncmers_do_not_depend_on_context():
    text = PROSE[:80]
    inner, places = syncmers.anchors(text)
    outer, moved = syncmers.anchors("other words before " + text + " and after")
    shift = len("other words before ")
    assert set(zip(inner.tolist(), (places + shift).tolist(), strict=True)) <= set(
        zip(outer.tolist(), moved.tolist(), strict=True)
    )
    for at in range(len(text) - syncmers.K + 1):
        run = text[at : at + syncmers.K]
        points = np.array([ord(c) for c in run], np.uint64)
        hashes = syncmers.run_hashes(points, syncmers.S)
        assert (at in places) == (hashes.min() in (hashes[0], hashes[-1]))


def test_simhash(spark, docs):
    got = by_id(QUERIES["op7_simhash"](spark, FOLDER).collect())
    prints = {}
    for doc_id, text, _ in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
        hashes = hashes if words else []
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert int(got[doc_id].fingerprint, 16) == prints[doc_id]
    check_components({d: r.component_id for d, r in got.items()}, prints)


def check_components(got, prints):
    ids = sorted(prints)
    top = {d: d for d in ids}
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((top[a], top[b]))
                top = {d: low if t == high else t for d, t in top.items()}
    assert got == top


@pytest.mark.parametrize("cell", [2048, 5])
def test_simhash_chains_and_large_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    draw = np.random.default_rng(2)
    prints, base = {}, int(draw.integers(0, 1 << 62))
    for k in range(120):
        if k % 6 == 0:
            base = int(draw.integers(0, 1 << 62))
        for bit in draw.integers(0, 64, draw.integers(0, 5)).tolist():
            base ^= 1 << bit
        prints[(k * 37) % 120] = base
    rows = spark.createDataFrame([(d, simhash.signed(p)) for d, p in prints.items()], "doc_id long, fp long")
    check_components({r.doc_id: r.component_id for r in simhash.near_groups(rows).collect()}, prints)


def test_manhattan_is_a_lower_bound():
    draw = np.random.default_rng(4)
    a, b = draw.integers(0, 1 << 63, 500).astype(np.uint64), draw.integers(0, 1 << 63, 500).astype(np.uint64)
    got = simhash.manhattan(simhash.counts(a), simhash.counts(b))
    for x, y, d in zip(a.tolist(), b.tolist(), got.tolist(), strict=True):
        want = sum(abs((x >> s & 3).bit_count() - (y >> s & 3).bit_count()) for s in range(0, 64, 2))
        assert d == want <= (x ^ y).bit_count()


def test_binary_ids(spark, docs):
    got = by_id(QUERIES["op9_binary_ids"](spark, FOLDER).collect())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for doc_id, text, _ in docs:
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        row = got[doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(array("I", ids).tobytes())
        start += len(ids)


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n).astype("<u4")
    assert (binary_ids.unpacked(binary_ids.packed(ids, planes)) == ids).all()


def test_small_chunks(spark, docs, tmp_path):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    path = public_tokenizers.path("word_bpe_49k.json")
    binary_ids.write_ids(rows, str(tmp_path / "ids"), path, 2, chunk_ids=100, planes="bit", shards=3)
    got = {r.doc_id: bytes(r.ids) for r in binary_ids.read_ids(spark, str(tmp_path / "ids")).collect()}
    library = Tokenizer.from_file(path)
    for doc_id, text, _ in docs:
        assert got[doc_id] == array("I", library.encode(text, add_special_tokens=False).ids + [2]).tobytes()


KINDS = [
    (
        "assign",
        r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 12,
    ),
    ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 16),
]


def base_spans(text):
    found = [
        (m.start(), k, m.end(), kind)
        for k, (kind, pattern, long_enough) in enumerate(KINDS)
        for m in re.finditer(pattern, text)
        if long_enough(m)
    ]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def test_secrets(spark, docs):
    check_secrets(QUERIES["op10_secret_scan"](spark, FOLDER).collect(), {d: t for d, t, _ in docs})


def check_secrets(rows, texts):
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        counts = Counter(s.split(":")[0] for s in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (counts["assign"], counts["access"], counts["hex"])
        assert [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")] == want


def test_secrets_by_owner(spark):
    shared, own = "token=ABCDEFGHIJKLMNOP", "secret: 'zyxwvutsrqponmlk'"
    texts = {
        1: f"😀 {shared} é {own}",
        2: f"{shared}",
        3: f"password=short token:{'f' * 20} AKIA{'Z' * 20}",
        4: f"{shared} token=secret=abcdefghijkl",
        5: "ghp_" + "a1B2" * 9,
        6: "nothing",
    }
    rows = spark.createDataFrame([(k, t, None, f"o{k}/r", 0) for k, t in texts.items()], SCHEMA)
    got = by_id(secrets.scan(secrets.numbered(rows)).collect())
    check_secrets(got.values(), texts)
    assert (got[1].n_live, got[1].n_shared) == (1, 1)
    assert (got[2].n_live, got[2].n_shared) == (0, 1)
    assert got[5].spans == "github:0:40"
    text = by_id(secrets.redacted(rows).collect())
    assert text[1].text == "😀 [EXAMPLE] é [SECRET]'"
    assert text[6].text == "nothing"
    assert text[5].text == "[SECRET]"
