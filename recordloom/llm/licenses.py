"""Operator 3: license scans by patience alignment with license texts.

Texts and templates are lower-case words (runs of letters, digits and underscores). Runs of
``SEED`` words that a text shares with a template mark the places worth aligning; such a
place reaches as far as the template could, and copies next to each other, told apart by
chains of such runs, have a place each. There, words that occur once in the place and
once in the template are paired, the longest increasing subsequence of the pairs gives the
anchors, and the gaps between anchors are aligned in the same way; where no such word is
left, equal words at both ends of a gap are matched. The share of the template's words that
are matched is its coverage; where places overlap, the larger coverage stays, then the
longer template, then the first by name.

Null and empty texts match nothing. Repeated rows are reported each on their own; a license
that a text holds twice is reported twice. Extra columns are not read. Empty tables give no
rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import by_arrow, small_batches, table, utf8
from recordloom.llm.decontamination import SEED, WORD, Items
from recordloom.llm.license_texts import LICENSES

COVERAGE = 0.75


def reach(n: int) -> int:
    """By how many words a template of ``n`` words may be shifted within a place."""
    return n // 2 + 8


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence, increasing in both places, of pairs sorted by the first."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        before.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            last.append(i)
        else:
            tops[pile], last[pile] = b, i
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def patience(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Matched places (in text, in template), ascending in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, a_end, b, b_end = gaps.pop()
        if a >= a_end or b >= b_end:
            continue
        here, there = Counter(text[a:a_end]), Counter(template[b:b_end])
        place = {w: j for j, w in enumerate(template[b:b_end], b) if there[w] == 1}
        pairs = [(i, place[w]) for i, w in enumerate(text[a:a_end], a) if here[w] == 1 and w in place]
        if pairs:
            anchors = increasing(pairs)
            out.extend(anchors)
            edges = [(a - 1, b - 1), *anchors, (a_end, b_end)]
            gaps.extend(
                (i + 1, i_next, j + 1, j_next) for (i, j), (i_next, j_next) in zip(edges, edges[1:], strict=False)
            )
            continue
        while a < a_end and b < b_end and text[a] == template[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and text[a_end - 1] == template[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            out.append((a_end, b_end))
    return sorted(out)


def chains(items: Items, words: np.ndarray) -> dict[int, list[list[tuple[int, int]]]]:
    """The seeds (place in text, in template) of each item as chains, ascending in both: one or more per copy."""
    hits = defaultdict(set)
    for places, numbers in items.found(words):
        for place, number in zip(places.tolist(), numbers.tolist(), strict=True):
            for item, at in items.places[number]:
                hits[item].add((place, at))
    out = {}
    for item, pairs in hits.items():
        n = len(items.words[item])
        shift, done, live = reach(n), [], []
        for place, at in sorted(pairs):
            done += [c for c in live if place - c[-1][0] > n + shift]
            live = [c for c in live if place - c[-1][0] <= n + shift]
            # The chain on the nearest diagonal goes on, the latest of equal ones.
            fit = [
                (abs(place - at - c[-1][0] + c[-1][1]), -k)
                for k, c in enumerate(live)
                if c[-1][0] < place and c[-1][1] < at
            ]
            drift, k = min(fit, default=(shift + 1, 0))
            if drift <= shift:
                live[-k].append((place, at))
            else:
                live.append([(place, at)])
        out[item] = done + live
    return out


def copies(
    items: Items, item: int, words: np.ndarray, mine: list[list[tuple[int, int]]], low: int, high: int
) -> Iterator[list[tuple[int, int]]]:
    """Alignments (in text, in template) of the copies in a place that has several chains.

    Each chain is aligned in its own window, which ends where a seed of another copy begins.
    """
    n = len(items.words[item])
    template, shift, span = items.words[item].tolist(), reach(n), min(SEED, n)
    places = sorted({place for chain in mine for place, _ in chain})
    for chain in mine:
        (first, at), (last, at_last) = chain[0], chain[-1]
        before, after = bisect_left(places, first) - 1, bisect_right(places, last)
        start = max(low, first - at - shift, min(places[before] + span, first) if before >= 0 else 0)
        end = min(high, last + n - at_last + shift)
        if after < len(places):
            end = max(last + span, min(end, places[after]))
        pairs = patience(words[start:end].tolist(), template)
        yield [(start + i, j) for i, j in pairs]


def found_in(items: Items, names: list[str], text: str, coverage: float) -> list[tuple]:
    """(license, coverage, matched words, first character, end) of a text, places not overlapping."""
    words = items.numbers(text)
    candidates = []
    known = None
    for item, low, high in items.regions(words, reach):
        template = items.words[item].tolist()
        known = chains(items, words) if known is None else known
        mine = [c for c in known[item] if low <= c[0][0] < high]
        found = []
        if len(mine) > 1:
            found = [p for p in copies(items, item, words, mine, low, high) if len(p) / len(template) >= coverage]
        if not found:
            found = [[(low + i, j) for i, j in patience(words[low:high].tolist(), template)]]
        for pairs in found:
            share = len(pairs) / len(template)
            if share >= coverage:
                candidates.append((-share, -len(template), names[item], pairs[0][0], pairs[-1][0] + 1, len(pairs)))
    if not candidates:
        return []
    spans = [m.span() for m in WORD.finditer(text.lower())]
    moved = len(text.lower()) != len(text)
    taken: list[tuple[int, int]] = []
    out = []
    for share, _, name, first, stop, matched in sorted(candidates):
        if all(stop <= a or first >= b for a, b in taken):
            taken.append((first, stop))
            place = (None, None) if moved else (spans[first][0], spans[stop - 1][1])
            out.append((name, -share, matched, *place))
    return sorted(out, key=lambda r: (r[3] is None, r[3] or 0, r[0]))


def licensed(docs: DataFrame, licenses: dict[str, str] = LICENSES, coverage: float = COVERAGE) -> DataFrame:
    """A row per license notice: doc_id, license, coverage, n_matched, start_char, end_char."""
    names = sorted(licenses)
    # Templates are a fixed, short list; every seed counts, so that edited copies are aligned, too.
    items = Items([(k, licenses[name]) for k, name in enumerate(names)])

    def run(batches) -> Iterator[list[tuple]]:
        for batch in small_batches(batches):
            yield [
                (doc_id, *row)
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True)
                for row in found_in(items, names, text, coverage)
            ]

    schema = "doc_id long, license string, coverage double, n_matched long, start_char long, end_char long"
    return by_arrow(docs.select("doc_id", utf8(F.col("text")).alias("text")), run, schema)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licensed(table(spark, sf_dir, "documents"))
