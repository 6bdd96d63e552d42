"""Token ids of whole texts with given tokenizer files of the ``tokenizers`` library.

The library cuts a text into words before it looks for merges, so the ids of a text are
those of its words, one after another. Here the words are cut with the file's own rule,
and the library's model encodes each distinct word once and keeps it in the Python worker,
which runs many tasks. Texts with special tokens, with U+001C to U+001F or with letters
past Latin Extended-B go to the library as they are.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

# Words and space-separated units that a worker keeps per file; past them it starts anew.
KEPT_WORDS, KEPT_UNITS = 500_000, 700_000
# Letters and numbers up to U+024F, and the word rules of the two kinds of files.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACED_WORDS = rf"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
BARE_WORDS = rf"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+"


def _letters() -> dict[int, str]:
    """Byte → the letter that stands for it in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, without special tokens added."""

    def __init__(self, path: str, kept: int | None = None) -> None:
        self.kept_words, self.kept_units = kept or KEPT_WORDS, kept or KEPT_UNITS
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.special = [t["content"] for t in rules["added_tokens"]]
        # Python takes U+001C to U+001F for blanks, the files' rules do not.
        self.far = re.compile("[^\x00-\x1b\x20-ɏ]")
        self.blank = re.compile("[^\n\x20-~\xa1-ɏ]")
        self.letters = _letters()
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}
        pre, normal = rules["pre_tokenizer"] or {}, rules["normalizer"] or {}
        kinds = [x["type"] for x in normal.get("normalizers", [])]
        steps = pre.get("pretokenizers", [{}])
        self.kind = None
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not normal:
            self.kind, self.rule = "spaced", re.compile(SPACED_WORDS)
        elif kinds == ["NFC", "Replace", "Lowercase"] and steps[0].get("behavior") == "Removed":
            self.kind, self.rule = "bare", re.compile(BARE_WORDS)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():  # of these only the space has another letter
            shown = word.replace(" ", self.letters[32])
        else:
            shown = "".join(map(self.letters.__getitem__, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _unit(self, unit: str) -> bytes:
        if unit.isascii() and (unit[1:] if unit[0] == " " else unit).isalpha():  # one word by either rule
            return self.words.get(unit) or self._word(unit)
        out = []
        for word in self.rule.findall(unit):
            ids = self.words.get(word)
            if ids is None:
                if len(self.words) >= self.kept_words:
                    self.words.clear()
                ids = self.words[word] = self._word(word)
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.kind is None or self.far.search(text) or any(s in text for s in self.special):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if self.kind == "bare":
            lower = text.lower()
            if self.far.search(lower):  # some letters have their lower case past U+024F
                return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
            units = lower.split()
        elif (
            "  " in text
            or " \n" in text
            or "\n " in text
            or text[0] == " "
            or text[-1] == " "
            or self.blank.search(text)
        ):
            return self._unit(text)
        else:
            first, *rest = text.split(" ")
            units = [first, *[" " + u for u in rest]]
        known = self.units
        try:
            return b"".join(map(known.__getitem__, units))
        except KeyError:
            if len(known) >= self.kept_units:
                known.clear()
            for unit in set(units).difference(known):
                known[unit] = self._unit(unit)
            return b"".join(map(known.__getitem__, units))


@lru_cache(maxsize=2)
def encoder_of(path: str, kept: int | None = None) -> Encoder:
    """The worker's one encoder of a tokenizer file: a task finds the words that earlier ones have met.

    ``kept`` words and as many units stay in the worker; fewer take less memory and more time.
    """
    return Encoder(path, kept)
