"""License notices next to each other."""

from __future__ import annotations

import pytest

from recordloom.llm import licenses
from recordloom.llm.decontamination import Items

NAMES = sorted(licenses.LICENSES)
ITEMS = Items([(k, licenses.LICENSES[name]) for k, name in enumerate(NAMES)])


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_adjacent_copies(name, n):
    notice = licenses.LICENSES[name]
    text = "foo " + " ".join([notice] * n) + " bar"
    got = [r for r in licenses.found_in(ITEMS, NAMES, text, licenses.COVERAGE) if r[0] == name]
    assert [r[1] for r in got] == [1.0] * n
    assert [r[3] for r in got] == [text.index(notice) + k * (len(notice) + 1) for k in range(n)]


def test_the_notice_of_the_finding():
    text = "foo Released under the MIT License. Released under the MIT License. bar"
    assert len(licenses.found_in(ITEMS, NAMES, text, licenses.COVERAGE)) == 2
