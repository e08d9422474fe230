"""Token ids of whole texts by a public tokenizer, as little-endian bytes, inside tasks.

Ids come from the tokenizer's own model. Its first steps (normalising, cutting into words)
are done here for common texts, because words then need to be encoded once only: the ids of a
word are remembered. Where no word runs over white space, so are the ids of what stands between white
space, and words are looked for in new runs only. Texts with rarer characters, with the string of a
special token, or with characters that Python's tables do not know go to the tokenizer whole.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
import types
import unicodedata
from array import array
from collections.abc import Callable
from functools import partial

import numpy as np
import regex
from tokenizers import Tokenizer

#: words remembered by a Python worker in each of two generations; longer ones are encoded anew
#: each time, so that the memory is bounded in bytes, too
REMEMBERED_WORDS = 400_000
REMEMBERED_CHARS = 64
#: characters that engines disagree on: white space beyond the six common ones, and one whose
#: lower case depends on its neighbours
_RARE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‏    　﻿Σ]")
#: fixed values: the words of the byte tokenizer
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: fixed values: words that end at white space; between two of them it is dropped
SPACED_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: outside the ranges in which every code point has long had a character (Latin to combining marks,
#: Cyrillic, marks, kana, Han, Hangul): libraries of other ages may know more or fewer of these
_STRANGE = re.compile(
    "[^\x00-\u0377\u0400-\u052f\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fff\uac00-\ud7a3]"
)


def _byte_letters() -> str:
    """Byte-level alphabet: visible Latin-1 characters stand for themselves, others follow 255."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(hidden)) for b in range(256))


def _kept(name: str, make: Callable):
    """A value that stays with the Python worker from task to task."""
    store = sys.modules.setdefault("_kvartal_kept", types.ModuleType("_kvartal_kept"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


class _Words(dict):
    """Ids of words, in two generations: what the older half has seen lately moves on."""

    def __init__(self, encode: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self._encode, self._most, self._older = encode, most, {}

    def __missing__(self, word: str) -> bytes:
        if len(word) > REMEMBERED_CHARS:
            return self._encode(word)
        if len(self) >= self._most:
            self._older = dict(self)
            self.clear()
        value = self._older.get(word)
        if value is None:
            value = self._encode(word)
        self[word] = value
        return value


class Encoder:
    """``of(text)``: the text's ids as unsigned 32-bit little-endian bytes."""

    def __init__(self, vocabulary: str, keeps_space: bool) -> None:
        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._model = self._tokenizer.model
        self._keeps_space = keeps_space
        with open(vocabulary, encoding="utf-8") as file:
            described = json.load(file)
        self._special = [token["content"] for token in described["added_tokens"]]
        self._letters = _byte_letters()
        pattern = BYTE_WORDS
        if not keeps_space:
            pattern = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._words = regex.compile(pattern).findall
        self._spaced = pattern == SPACED_WORDS
        self._word = _Words(self._one_run if self._spaced else self._one_word, REMEMBERED_WORDS)

    def whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _one_word(self, word: str) -> bytes:
        letters = codecs.charmap_decode(word.encode(), "strict", self._letters)[0]
        return array("I", [t.id for t in self._model.tokenize(letters)]).tobytes()

    def _one_run(self, run: str) -> bytes:
        """Ids of what stands between white space: a word by itself, or several."""
        words = self._words(run)
        if words == [run]:
            return self._one_word(run)
        return b"".join(map(self._word.__getitem__, words))

    def _has_unassigned(self, text: str) -> bool:
        strange = set(_STRANGE.findall(text))
        return any(unicodedata.category(c) == "Cn" for c in strange)

    def _is_rare(self, text: str) -> bool:
        return (
            _RARE.search(text) is not None
            or any(map(text.__contains__, self._special))
            or not text.isascii() and self._has_unassigned(text)
        )

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._is_rare(text):
            return self.whole(text)
        if not text.isascii() and not self._keeps_space:
            text = unicodedata.normalize("NFC", text)
        if not self._keeps_space:
            text = text.lower()
        # white space beyond the six common ones is rare, so Python and the tokenizer agree on where it is
        words = text.split() if self._spaced else self._words(text)
        return b"".join(map(self._word.__getitem__, words))


def _encoder(vocabulary: str, keeps_space: bool) -> Encoder:
    return _kept(f"{vocabulary} {keeps_space}", lambda: Encoder(vocabulary, keeps_space))


def word_tokens(vocabulary: str) -> partial:
    """Maker of an encoder whose tokenizer drops white space."""
    return partial(_encoder, vocabulary, False)


def byte_tokens(vocabulary: str) -> partial:
    """Maker of an encoder whose tokenizer keeps white space."""
    return partial(_encoder, vocabulary, True)
