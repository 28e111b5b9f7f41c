"""A minimal acyclic transducer from words to numbers, in arrays that can be mapped into memory.

Words share prefixes and suffixes. Every arc carries an output; the outputs along a word add up to its rank among all words, which
selects its row of a table. That is what a transducer with the rows as outputs gives, with outputs moved into one table.
"""

from __future__ import annotations

import hashlib
import io
import mmap
import tempfile
from collections.abc import Sequence

import numpy as np


def ragged(codes: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``codes`` of a table of runs, one after another, and where each run begins (with the end at last)."""
    lengths = offsets[codes + 1] - offsets[codes]
    at = np.concatenate([[0], np.cumsum(lengths)])
    return values[np.arange(at[-1]) + np.repeat(offsets[codes] - at[:-1], lengths)], at


def runs_of(rows: Sequence[Sequence[int]], kind) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return offsets, np.fromiter((x for r in rows for x in r), kind, int(offsets[-1]))


def build(entries: dict[bytes, Sequence[int]]) -> bytes:
    """The transducer of ``entries`` as bytes. Words are added in order; a state that no later word can change is merged with an
    equal one, so the automaton is minimal at the end."""
    words = sorted(entries)
    arcs: list[dict[int, int]] = [{}]
    final, known = [False], {}
    path = [0]

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            shape = (final[state], tuple(arcs[state].items()))
            same = known.setdefault(shape, state)
            if same != state:
                parent = arcs[path[-1]]
                parent[next(reversed(parent))] = same
                arcs[state] = {}

    before = b""
    for word in words:
        shared = 0
        while shared < min(len(before), len(word)) and before[shared] == word[shared]:
            shared += 1
        freeze(shared)
        for byte in word[shared:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][byte] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        before = word
    freeze(0)

    order, place = [0], {0: 0}
    for state in order:
        for target in arcs[state].values():
            if target not in place:
                place[target] = len(order)
                order.append(target)
    # arcs lead to states whose number of words is known when states are taken deepest first
    count: dict[int, int] = {}
    todo = [0]
    while todo:
        state = todo[-1]
        missing = [t for t in arcs[state].values() if t not in count]
        if missing:
            todo += missing
        else:
            count[state] = final[state] + sum(count[t] for t in arcs[state].values())
            todo.pop()
    keys, targets, outputs = [], [], []
    for state in order:
        passed = int(final[state])
        for byte, target in sorted(arcs[state].items()):
            keys.append(place[state] * 256 + byte)
            targets.append(place[target])
            outputs.append(passed)
            passed += count[target]
    offsets, values = runs_of([entries[w] for w in words], np.int32)
    held = io.BytesIO()
    for array in (np.array(keys, np.int64), np.array(targets, np.int32), np.array(outputs, np.int32), np.array([final[s] for s in order]), offsets, values):
        np.save(held, array)
    return held.getvalue()


class Lexicon:
    """Looks words up in mapped arrays."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as file:  # has no name, and goes when it is unmapped
            file.write(data)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        arrays, at = [], 0
        for _ in range(6):
            head = io.BytesIO(self.map[at : at + 256])
            version = np.lib.format.read_magic(head)
            shape, _, kind = np.lib.format.read_array_header_1_0(head) if version == (1, 0) else np.lib.format.read_array_header_2_0(head)
            arrays.append(np.frombuffer(self.map, kind, shape[0], at + head.tell()))
            at += head.tell() + arrays[-1].nbytes
        self.keys, self.targets, self.outputs, self.final, self.offsets, self.values = arrays

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, or -1. All words advance by a byte at a time."""
        n = len(words)
        state, rank = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if not n or not len(self.keys):
            return np.full(n, -1)
        length = np.fromiter(map(len, words), np.int64, n)
        data, start = np.frombuffer(b"".join(words), np.uint8), np.cumsum(length) - length
        live = np.arange(n)
        for k in range(int(length.max())):
            live = live[length[live] > k]
            key = state[live] * 256 + data[start[live] + k]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            state[live[~ok]] = -1
            live, at = live[ok], at[ok]
            state[live] = self.targets[at]
            rank[live] += self.outputs[at]
            if not len(live):
                break
        return np.where((state >= 0) & self.final[state], rank, -1)


_OPEN: dict[str, Lexicon] = {}


def opened(data: bytes) -> Lexicon:
    """The lexicon of ``data``, mapped once per worker."""
    name = hashlib.sha256(data).hexdigest()
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = Lexicon(data)
    return _OPEN[name]
