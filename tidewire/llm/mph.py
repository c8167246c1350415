"""Minimal perfect hashing: levels of bit arrays, each of which takes the keys that hash to a place of their own.

A key's slot is the number of set bits before its bit. Keys are unsigned 64-bit hashes and must be distinct.
"""

from __future__ import annotations

import numpy as np

_MOST_LEVELS = 40
_ALL = 0xFFFFFFFFFFFFFFFF


def mix(h: np.ndarray, level: int) -> np.ndarray:
    """A different hash of ``h`` for each level (the finisher of splitmix64)."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class PerfectHash:
    """``slots(hashes)`` gives each built-in key a slot of its own from 0 to n - 1, and any other key some slot or -1."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest, self._before, base = levels, rest, [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self._before.append(base + np.cumsum(ones) - ones)
            base += int(ones.sum())
        self.size = base + len(rest)

    @classmethod
    def build(cls, hashes: np.ndarray, room: float = 1.6) -> PerfectHash:
        left, levels = np.asarray(hashes, np.uint64), []
        while len(left) and len(levels) < _MOST_LEVELS:
            bits = 64 * max(1, -(-int(room * len(left)) // 64))
            at = mix(left, len(levels)) % np.uint64(bits)
            places, first, times = np.unique(at, return_index=True, return_counts=True)
            own = places[times == 1]
            words = np.zeros(bits // 64, np.uint64)
            np.bitwise_or.at(words, (own >> np.uint64(6)).astype(np.int64), np.uint64(1) << (own & np.uint64(63)))
            levels.append(words)
            alone = np.zeros(len(left), bool)
            alone[first[times == 1]] = True
            left = left[~alone]
        return cls(levels, np.sort(left))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        hashes = np.asarray(hashes, np.uint64)
        out = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        for level, (words, before) in enumerate(zip(self.levels, self._before, strict=True)):
            if not len(todo):
                return out
            at = mix(hashes[todo], level) % np.uint64(64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit & np.uint64(1)).astype(bool)
            below = words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[todo[hit]] = before[word[hit]] + np.bitwise_count(below)
            todo = todo[~hit]
        if len(todo) and len(self.rest):
            at = np.searchsorted(self.rest, hashes[todo])
            found = (at < len(self.rest)) & (self.rest[np.minimum(at, len(self.rest) - 1)] == hashes[todo])
            out[todo[found]] = self.size - len(self.rest) + at[found]
        return out

    def one(self):
        """``slots`` for single hashes, as a function on Python integers: quicker where there is no array of them."""
        levels = [(64 * len(w), w.tolist(), b.tolist(), 0x9E3779B97F4A7C15 * (k + 1) & _ALL) for k, (w, b) in enumerate(zip(self.levels, self._before, strict=True))]

        def slot(h: int) -> int:
            for bits, words, before, step in levels:
                x = (h + step) & _ALL
                x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _ALL
                x = (x ^ x >> 27) * 0x94D049BB133111EB & _ALL
                at = (x ^ x >> 31) % bits
                word, bit = words[at >> 6], at & 63
                if word >> bit & 1:
                    return before[at >> 6] + (word & (1 << bit) - 1).bit_count()
            return int(self.slots(np.array([h], np.uint64))[0]) if len(self.rest) else -1

        return slot

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), len(self.rest), *map(len, self.levels)], "<u8")
        return b"".join([head.tobytes(), *(w.astype("<u8").tobytes() for w in self.levels), self.rest.astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        words = np.frombuffer(data, "<u8").astype(np.uint64)
        n_levels, n_rest = int(words[0]), int(words[1])
        sizes, at, levels = words[2 : 2 + n_levels].astype(int), 2 + n_levels, []
        for n in sizes:
            levels.append(words[at : at + n])
            at += n
        return cls(levels, words[at : at + n_rest])
