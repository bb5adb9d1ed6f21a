"""Token ids of whole texts with a public tokenizer, word by word where that is exact.

A space or a line feed between two characters that are certainly not white space starts a new piece in both
vocabularies, and no normaliser joins characters across it; so the ids of such a text are the ids of
its words in a row. Words of Latin letters, with or without a run of punctuation behind them, go straight to
the tokenizer's merge model; every other word takes the tokenizer's whole path, as does every text that may
hold one of its marker strings. A text is cut at every space and line feed; a word that does not begin and end in such
characters is never remembered, so it always turns up as missing, and its text is cut at safe places only. Each worker
remembers words in two generations of bounded size; results do not depend on what it remembers.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SOLID = "!-~" + _LETTERS
_CUT = re.compile(f"(?<=[{_SOLID}])(?=[ \\n][{_SOLID}])")
# A word behind a line feed keeps it, the one at the text's start gets a space in front; all others stood behind a space.
# Punctuation but the apostrophe, which may begin a contraction.
_WORD = re.compile(f"([ \\n]?)([{_LETTERS}]+)([!-&(-/:-@\\[-`{{-~]*)")
_SAFE = re.compile(f"[ \\n]?[{_SOLID}](?:.*[{_SOLID}])?", re.DOTALL)
GENERATION = 400_000  # words
LONG_WORD = 64  # characters; longer words are not remembered


def _byte_letters() -> dict[int, str]:
    """The published byte-level alphabet: printable bytes stand for themselves, the others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in own}
    for n, b in enumerate(x for x in range(256) if x not in letters):
        letters[b] = chr(256 + n)
    return letters


class _UnsafeCut(Exception):
    """The text was cut beside white space, or something that may be."""


class _Known(dict):
    """Ids of words as ``_WORD`` tells them apart; a word that is missing is taken from the generation before, or made."""

    def __init__(self, make, before: dict[str, bytes]):
        super().__init__()
        self.make, self.before = make, before

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= LONG_WORD:
            self[word] = ids
        return ids


class WordEncoder:
    """Encodes texts with the tokenizer file at ``path``; ids come as little-endian unsigned 32 bits."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self._folds = settings["normalizer"] is not None  # lower case, white space dropped
        # how the marker strings begin that the tokenizer takes as one id; a text with such a beginning goes the whole path
        self._markers = sorted({t["content"][:2] for t in settings.get("added_tokens") or []})
        letters = _byte_letters()
        self._mapped = str.maketrans({c: "".join(letters[b] for b in c.encode()) for c in map(chr, range(32, 256))})
        self._line_feed = self.whole("\n")
        self._known = _Known(self._word, {})

    def whole(self, text: str) -> bytes:
        """The tokenizer's own path for the text as it is."""
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _merged(self, piece: str) -> list[int]:
        return [t.id for t in self._model.tokenize(piece.translate(self._mapped))]

    def _word(self, word: str) -> bytes:
        simple = _WORD.fullmatch(word)
        if simple is None:
            if _SAFE.fullmatch(word) is None:
                raise _UnsafeCut
            return self.whole(word if word[0] == "\n" else word[1:] if word[0] == " " else " " + word)
        lead, letters, marks = simple.groups()
        if marks:
            return self._known[lead + letters] + self._known[" " + marks]
        if lead == "\n":
            return self._line_feed + self._known[" " + letters]
        if self._folds and (lead or letters != letters.lower()):
            return self._known[letters.lower()]
        return array("I", self._merged(letters if lead or self._folds else " " + letters)).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(m in text for m in self._markers):
            return self.whole(text)
        words = text.replace("\n", " \n").split(" ")
        words[0] = " " + words[0]
        try:
            out = b"".join(map(self._known.__getitem__, words))
        except _UnsafeCut:
            first, *parts = _CUT.split(text)
            last = self.whole(parts.pop()) if parts else b""
            out = self.whole(first) + b"".join(self._known[p.removeprefix(" ")] for p in parts) + last
        if len(self._known) > GENERATION:
            self._known.before = {}
            self._known = _Known(self._word, self._known)
        return out


def tokenizer_file(name: str) -> str:
    """Where the public vocabulary file ``name`` is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's own encoder for ``path``, loaded once."""
    return WordEncoder(path)
