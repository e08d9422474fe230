"""Words, word hashes and tokens of whole texts, for use inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

#: a word, for engines that read patterns; in Python ``bytes.split`` cuts at the same six characters
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
#: distinct words remembered per task before the memory is given back, and the longest of them in bytes
REMEMBERED = 100_000
REMEMBERED_BYTES = 64

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


class WordHashes(dict):
    """64-bit hashes of words, each worked out once while it is remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(word) > REMEMBERED_BYTES:
            return xxhash.xxh64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Every input bit spread over the whole number."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """One hash for every run of ``width`` words; none if there are fewer."""
    count = len(hashes) - width + 1
    if count <= 0:
        return hashes[:0]
    rolled = hashes[:count].copy()
    for i in range(1, width):
        rolled = rolled * _FACTOR + hashes[i : i + count]
    return mixed(rolled)


def sequence_digest(words: list[bytes]) -> bytes:
    """128 bits that tell word sequences apart; white space between them does not count."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()
