"""Plain versions of the operators, one document at a time, to test against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def jump(key, shards):
    """(shard, next shard of the chain)."""
    b, j, key = -1, 0, (key or 0) % 2**64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b, j


def targets(sizes, share=1.5, most=2, weights=(5, 2, 1)):
    """Fill and reshare until no source is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        rest, open_ = total - sum(fixed.values()), [s for s in order if s not in fixed]
        got = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if got[s] >= most * sizes[s]]
        if not over:
            return {**fixed, **got}
        fixed |= {s: float(most * sizes[s]) for s in over}


def chunks(lines, window=1):
    def md5(x):
        return hashlib.md5(x.encode()).hexdigest()

    h = [md5(x) for x in lines]
    if window > 1:
        h = [md5("".join(h[i : i + window])) for i in range(len(h))]
    starts = [i for i in range(len(h)) if i == 0 or (i + 1 < len(h) and h[i] < h[i - 1] and h[i] <= h[i + 1])]
    return list(zip(starts, [*starts[1:], len(h)], strict=True))


def line_runs(lines, long=50):
    """(first line, number of lines) of the smallest runs that count: two neighbouring lines with a word, or one with more than ``long``."""
    full = [i for i, x in enumerate(lines) if words(x)]
    return [(i, j - i + 1) for i, j in zip(full, full[1:], strict=False)] + [(i, 1) for i in full if len(words(lines[i])) > long]


def dedup_lines(docs, window=1):
    """docs: (id, text). The text that stays and the number of lines removed, per document in the given order."""
    first, out = {}, {}
    for id_, text in sorted(set(docs), key=lambda d: (d[0], hashlib.md5((d[1] or "").encode()).hexdigest()[:16])):
        if text is None:
            out[id_, text] = (None, 0)
            continue
        lines, gone = text.split("\n"), set()
        spans = [(a, b - a) for a, b in chunks(lines, window) if b - a > 1 and words("\n".join(lines[a:b]))] + line_runs(lines)
        for start, n in sorted(spans):
            before, end = first.setdefault("\n".join(lines[start : start + n]), ((id_, text), start + n))
            if before != (id_, text) or end <= start:
                gone.update(range(start, start + n))
        out[id_, text] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return [out[d] for d in docs]


def rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    ws = words(text)
    grams = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    times, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(covered)


def shingles(text, n=5):
    ws = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) or frozenset([tuple(ws)])


def components(docs, n=5):
    """docs: id -> text. Smallest id reachable over pairs whose shingle sets overlap by 80 %."""
    sets = {d: shingles(t, n) for d, t in docs.items()}
    by = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            by[x].add(d)
    parent = {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in sets.items():
        for e in {e for x in s for e in by[x] if e < d}:
            common = len(s & sets[e])
            if 100 * common >= 80 * (len(s) + len(sets[e]) - common):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: root(d) for d in docs}
