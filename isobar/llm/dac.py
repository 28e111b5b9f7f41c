"""Directly addressable codes: numbers in levels of eight bits, any of which can be read without its neighbours.

Level 0 holds the lowest eight bits of every number, level 1 the next eight bits of those numbers that have more, and so on. A bit per entry
says whether its number goes on; how many bits are set before an entry, its rank, is the entry's place on the next level. A directory
counts the set bits before every block of 512, so that a rank takes one look-up and at most eight words.

Layout of ``encode``: the four bytes ``DAC1``, the number of levels and of entries per level as 8-byte integers, then for each level its
chunks, padded to eight bytes, its bitmap in 8-byte words and its directory in 8-byte integers; all little-endian.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"DAC1"
BITS = 8
#: Entries between two counts of the directory, and words of 64 bits in as many.
BLOCK = 512
WORDS = BLOCK // 64


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def encode(numbers: np.ndarray) -> bytes:
    """The codes of ``numbers``, whole numbers from 0 to 2^64 - 1."""
    left = np.ascontiguousarray(numbers, np.uint64)
    sizes, parts = [], []
    while not sizes or len(left):
        goes_on = left >> np.uint64(BITS) > 0
        words = np.zeros(-(-len(left) // BLOCK) * WORDS, np.uint64)
        bits = np.packbits(goes_on, bitorder="little")
        words.view(np.uint8)[: len(bits)] = bits
        ranks = np.zeros(len(words) // WORDS + 1, np.uint64)
        np.cumsum(np.bitwise_count(words).reshape(-1, WORDS).sum(axis=1, dtype=np.uint64), out=ranks[1:])
        parts += [_padded(left.astype(np.uint8).tobytes()), words.tobytes(), ranks.tobytes()]
        sizes.append(len(left))
        left = left[goes_on] >> np.uint64(BITS)
    return _padded(MAGIC) + np.array([len(sizes), *sizes], np.uint64).tobytes() + b"".join(parts)


class Codes:
    """Reads ``encode``'s bytes in place; nothing is decoded but what is asked for."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("these bytes are no directly addressable codes")
        at = len(_padded(MAGIC))
        n_levels = int(np.frombuffer(data, np.uint64, 1, at)[0])
        sizes = np.frombuffer(data, np.uint64, n_levels, at + 8).tolist()
        at += 8 * (1 + n_levels)
        self.levels = []
        for size in sizes:
            blocks = -(-size // BLOCK)
            chunks = np.frombuffer(data, np.uint8, size, at)
            at += size + -size % 8
            words = np.frombuffer(data, np.uint64, blocks * WORDS, at)
            at += words.nbytes
            ranks = np.frombuffer(data, np.uint64, blocks + 1, at)
            at += ranks.nbytes
            self.levels.append((chunks, words, ranks))
        self.n = sizes[0]

    @staticmethod
    def _rank(words: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The number of set bits before each place."""
        block, word = places // BLOCK, places // 64
        found = ranks[block].astype(np.int64)
        for k in range(WORDS):
            counted = block * WORDS + k
            before = counted < word
            found[before] += np.bitwise_count(words[counted[before]])
        inside = (places % 64).astype(np.uint64)
        cut = inside > 0
        found[cut] += np.bitwise_count(words[word[cut]] & ((np.uint64(1) << inside[cut]) - np.uint64(1)))
        return found

    def get(self, places: np.ndarray) -> np.ndarray:
        """The numbers at some places, in any order and with repetitions."""
        places = np.asarray(places, np.int64)
        if len(places) and not 0 <= places.min() <= places.max() < self.n:
            raise IndexError(f"places outside 0 to {self.n - 1}")
        out = np.zeros(len(places), np.uint64)
        rows = np.arange(len(places))
        for level, (chunks, words, ranks) in enumerate(self.levels):
            out[rows] |= chunks[places].astype(np.uint64) << np.uint64(BITS * level)
            goes_on = words[places // 64] >> (places % 64).astype(np.uint64) & np.uint64(1) > 0
            rows, places = rows[goes_on], self._rank(words, ranks, places[goes_on])
            if not len(rows):
                break
        return out

    def run(self, start: int, end: int) -> np.ndarray:
        """The numbers from place ``start`` to before ``end``. On every level they are neighbours, between two ranks."""
        if not 0 <= start <= end <= self.n:
            raise IndexError(f"{start} to {end} is outside 0 to {self.n}")
        out = np.zeros(end - start, np.uint64)
        rows = np.arange(end - start)
        for level, (chunks, words, ranks) in enumerate(self.levels):
            if start == end:
                break
            out[rows] |= chunks[start:end].astype(np.uint64) << np.uint64(BITS * level)
            first, last = start // 64, -(-end // 64)
            bits = np.unpackbits(words[first:last].view(np.uint8), bitorder="little")[start - 64 * first : end - 64 * first]
            rows = rows[bits > 0]
            start = int(self._rank(words, ranks, np.array([start]))[0])
            end = start + len(rows)
        return out
