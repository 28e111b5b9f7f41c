"""Words, runs of words and characters of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; the arrays of one piece take some forty times as much. A longer text is a piece of its own.
PIECE = 1 << 19

_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.random.default_rng(20240301).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _ODD)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


class Texts:
    """The bytes of some texts in one array, text i from ``offsets[i]`` to ``offsets[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def words(self, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every word and, per text, the number of its first word: text i has words ``at[i]`` to ``at[i + 1]``."""
        data = _LOWER[self.data] if lower else self.data
        letter = ~_GAP[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = ~letter[:-1]
        edge[self.offsets] = True
        starts = np.flatnonzero(letter & edge[:-1])
        edge[:-1] = ~letter
        edge[self.offsets] = True
        lengths = np.flatnonzero(letter & edge[1:]) + 1 - starts
        at = np.searchsorted(starts, self.offsets)
        if not len(starts):
            return np.zeros(0, np.uint64), at
        begins = np.cumsum(lengths) - lengths
        letters = _BYTE[data[letter]]
        letters *= _powers(int(lengths.max()))[np.arange(len(letters)) - np.repeat(begins, lengths)]
        return mixed(np.add.reduceat(letters, begins) + lengths.astype(np.uint64)), at


def pieces(column: pa.Array | pa.ChunkedArray, size: int = PIECE) -> Iterator[tuple[int, Texts]]:
    """A column of strings as texts of about ``size`` bytes in all, each with the row it starts at; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, Texts(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def runs(words: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``n`` words inside a text, and per text the number of its first run."""
    counts = np.diff(at)
    total = len(words) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    joined = np.zeros(total, np.uint64)
    for k in range(n):
        joined += words[k : k + total] * _PLACE[k]
    text = np.repeat(np.arange(len(counts)), counts)
    inside = text[:total] == text[n - 1 :]
    return mixed(joined[inside]), np.concatenate([[0], np.cumsum(np.maximum(counts - n + 1, 0))])


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of ``values[at[i]:at[i + 1]]`` for every i, 0 where that is empty. A sum does not depend on its neighbours."""
    out = np.zeros((len(at) - 1, *values.shape[1:]), values.dtype)
    used = np.flatnonzero(at[1:] > at[:-1])
    if len(used):
        out[used] = np.add.reduceat(values, at[used], axis=0)
    return out
