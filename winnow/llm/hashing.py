"""Words, 64-bit hashes and look-ups of whole arrays, for operators that run over Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

_WORDS: dict[bytes, int] = {}
_WORDS_KEPT = 150_000
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))      # fixed values: a public mixer
SPREAD = np.uint64(0x9E3779B97F4A7C15)      # fixed value: 2**64 over the golden ratio, odd


def constants(label: str, n: int) -> np.ndarray:
    """n odd 64-bit numbers that depend on the label only."""
    return np.array([xxhash.xxh64_intdigest(f"{label}{i}") | 1 for i in range(n)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """Words between blanks and \\x09-\\x0D, with A-Z in lower case, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _hash(word: bytes) -> int:
    if len(_WORDS) >= _WORDS_KEPT:
        _WORDS.clear()
    found = _WORDS[word] = xxhash.xxh64_intdigest(word)
    return found


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    known = _WORDS.get
    return np.fromiter((known(w) or _hash(w) for w in tokens), np.uint64, len(tokens))


class Lookup:
    """Place of each of some distinct numbers, found for whole arrays at once (open addressing)."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys)).bit_length() + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots, self.places = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        waiting, step = np.arange(len(keys)), 0
        while len(waiting):
            slot = (self._home(keys[waiting]) + step) & self.mask
            slot, first = np.unique(slot, return_index=True)
            free = self.slots[slot] < 0
            slot, won = slot[free], waiting[first[free]]
            self.slots[slot], self.places[slot] = keys[won], won
            waiting, step = np.setdiff1d(waiting, won), step + 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and whether there is one."""
        slot = self._home(wanted)
        held = self.slots[slot]
        known = held == wanted
        at = np.where(known, self.places[slot], 0)
        open_ = np.flatnonzero(~known & (held >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.slots[slot[open_]]
            found = open_[held == wanted[open_]]
            known[found], at[found] = True, self.places[slot[found]]
            open_ = open_[(held != wanted[open_]) & (held >= 0)]
        return at, known
