"""Token ids around every code point up to U+024F, against the library."""

from __future__ import annotations

from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordloom.llm.tokens import Encoder


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_code_point_up_to_latin_extended_b(name):
    path = public_tokenizers.path(name)
    encoder, library = Encoder(path), Tokenizer.from_file(path)
    wrong = set()
    for point in range(0x250):
        c = chr(point)
        for text in (f"ab{c}cd", f"ab {c} cd", f"{c}ab", f"ab{c}", f"ab{c}{c}cd", f"1{c}2", f"ab {c}cd\n{c}", c):
            if encoder.encode(text) != array("I", library.encode(text, add_special_tokens=False).ids).tobytes():
                wrong.add(point)
    assert not wrong
