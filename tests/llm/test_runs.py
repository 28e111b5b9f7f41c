"""Repeated runs of lines against a plain version that compares all places."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from isobar.llm import line_dedup
from tests.llm import brute, frames
from tests.llm.tables import documents

LOWEST = -(2**63)


def plain(docs):
    """docs: (id, text). As ``brute.dedup_lines``; the longest run at each line that stands at an earlier place goes, place by place."""
    places, out = [], {}
    for id_, text in sorted(set(docs), key=lambda d: (d[0], hashlib.md5((d[1] or "").encode()).hexdigest()[:16])):
        lines = [] if text is None else text.split("\n")
        gone = set()
        for before in [*places, lines]:
            for a in range(len(before)):
                for b in range(len(lines)):
                    n = 0
                    while a + n < len(before) and b + n < len(lines) and before[a + n] == lines[b + n] and (before is not lines or a + n < b):
                        n += 1
                    run = list(range(b, b + n))
                    while run and not brute.words(lines[run[-1]]):
                        run.pop()
                    full = [i for i in run if brute.words(lines[i])]
                    if full and run[0] == full[0] and (len(full) > 1 or len(brute.words(lines[full[0]])) > line_dedup.LONG):
                        gone.update(run)
        places.append(lines)
        out[id_, text] = (None, 0) if text is None else ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return [out[d] for d in docs]


def compare_chunks(docs, rows):
    """As ``compare``, of ``dedup_lines``."""
    got = line_dedup.dedup_lines(docs).collect()
    plain_rows = [(LOWEST if i is None else i, t) for i, t in rows]
    expected = Counter((i, t, *kept) for (i, t), kept in zip(rows, brute.dedup_lines(plain_rows, line_dedup.WINDOW), strict=True))
    assert Counter((r["row"]["doc_id"], r["row"]["text"], r.kept_text, r.n_removed) for r in got) == expected
    return got


def compare(docs, rows):
    got = line_dedup.dedup_runs(docs).collect()
    wanted = plain([(LOWEST if i is None else i, t) for i, t in rows])
    expected = Counter((i, t, kept, removed) for (i, t), (kept, removed) in zip(rows, wanted, strict=True))
    assert Counter((r["row"]["doc_id"], r["row"]["text"], r.kept_text, r.n_removed) for r in got) == expected
    return got


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("n", range(1, 11))
def test_planted_passages_go_whole(spark, n):
    passage = [f"line {k} of a passage " + " ".join(f"w{k}x{j}" for j in range(60 if n == 1 else 8)) for k in range(n)]
    rows = [(i, "\n".join([f"own {i} {j}" for j in range(1 + i)] + passage + [f"tail {i} {j}" for j in range(2)])) for i in range(8)]
    for operator in (compare, compare_chunks):
        got = {r["row"]["doc_id"]: r for r in operator(frame(spark, rows), rows)}
        assert [got[i].n_removed for i in range(8)] == [0] + [n] * 7
        assert all(not set(passage) & set(got[i].kept_text.split("\n")) for i in range(1, 8))


def test_random_lines(spark):
    draw = random.Random(7)
    words = ["", " ", "a", "b", "c", "x " * 51, "y " * 50]
    rows = [(draw.choice([None, *range(40)]), "\n".join(draw.choice(words) for _ in range(draw.randint(1, 9)))) for _ in range(60)]
    assert any(r.n_removed for r in compare(frame(spark, rows), rows))
    assert any(r.n_removed for r in compare_chunks(frame(spark, rows), rows))


def test_awkward_rows(spark):
    compare(frames.awkward(spark), [(i, t) for i, t, *_ in frames.awkward_rows()])
    assert line_dedup.dedup_runs(frames.none(spark)).collect() == []


def test_copies_that_overlap_stay(spark):
    rows = [(1, "x\nx\nx"), (2, "y\ny\ny\ny"), (3, "a\n\n\n\nb"), (4, "c\na\n\n\n\nb\n"), (5, "single"), (6, "single")]
    got = {r["row"]["doc_id"]: r.kept_text for r in compare(frame(spark, rows), rows)}
    assert got == {1: "x\nx\nx", 2: "y\ny", 3: "a\n\n\n\nb", 4: "c\n", 5: "single", 6: "single"}


def test_every_line_stays_somewhere(spark):
    docs = documents(spark)
    got = line_dedup.dedup_runs(docs).collect()
    left = {x for r in got for x in (r.kept_text or "").split("\n")}
    assert {x for r in docs.collect() for x in (r.text or "").split("\n") if brute.words(x)} <= left
    chunks = {r["row"]["doc_id"]: r.n_removed for r in line_dedup.dedup_lines(docs).collect()}
    assert all(r.n_removed <= chunks[r["row"]["doc_id"]] for r in got)


def test_one_repeated_row_among_many(spark):
    """A third of all rows is the same row, another third holds one passage."""
    passage = "\n".join(f"line {k} that many share with each other" for k in range(3))
    rows = [(1, f"head\n{passage}\ntail")] * 300 + [(10 + i, f"own {i}\n{passage}\nend {i}") for i in range(300)] + [(1000 + i, f"other {i}\nthing {i}") for i in range(300)]
    got = {r["row"]["doc_id"]: r.n_removed for r in compare_chunks(frame(spark, rows), rows)}
    assert got[1] == 0 and all(got[10 + i] == 3 and got[1000 + i] == 0 for i in range(300))
