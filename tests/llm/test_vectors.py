"""Neighbours against comparing all vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from isobar.llm.vectors import neighbours
from tests.llm.tables import folder

SCHEMA = "vec_id bigint, embedding array<float>, list int, score string"


def exact(rows, every, k=10):
    """Per query the (score, id) of the nearest, by comparing all."""
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = {}
    for i, v in usable:
        if i % every == 0:
            out[i] = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in usable if j != i)[:k]
    return out


def found(vectors, every, **limits):
    out = {}
    for r in sorted(neighbours(vectors, every, **limits).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({j for _, j in got.get(q, [])} & {j for _, j in w}) for q, w in want.items()) / max(sum(map(len, want.values())), 1)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "s") for i, v in rows], SCHEMA)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0, 2.0]), (8, [1.0, 2.5]), (None, [1.0, 2.0]), (10, [3.0, 1.0])]
    got = found(frame(spark, rows), 2)
    assert got == exact(rows, 2) and set(got) == {0, 8, 10}
    assert neighbours(frame(spark, rows).where("false"), 2).collect() == []
    assert neighbours(frame(spark, [(0, [1.0])]), 2).collect() == []


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0, 0.0, 1.0]) for i in range(300)] + [(300 + i, [float(i), 1.0, 2.0, 3.0]) for i in range(50)]
    got = found(frame(spark, rows), 50)
    assert got[100] == [(0.0, j) for j in range(10)] and got[0] == [(0.0, j) for j in range(1, 11)]


def test_repeated_rows_are_candidates_of_their_own(spark):
    """Equal rows, rows that share an id only, and a query whose row repeats: each query row has its own ranks and leaves out itself alone."""
    rows = [(i, [float(i), 1.0, float(i % 3)]) for i in range(1, 40)] + [(7, [7.0, 1.0, 1.0])] * 5 + [(8, [6.5, 1.0, 1.0])] * 2 + [(20, [20.0, 1.0, 2.0])] * 3 + [(0, [7.0, 1.0, 1.0])]
    at = [(i, np.array(v)) for i, v in rows]
    want = [(q, n + 1, j, s) for a, (q, v) in enumerate(at) if q % 10 == 0 for n, (s, j) in enumerate(sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for b, (j, w) in enumerate(at) if b != a)[:10])]
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours(frame(spark, rows), 10).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("clusters", [0, 20])
def test_recall(spark, clusters):
    rng = np.random.default_rng(1)
    centers = rng.standard_normal((max(clusters, 1), 32)) * 3
    x = rng.standard_normal((3000, 32)) + (centers[rng.integers(0, clusters, 3000)] if clusters else 0)
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    got, want = found(frame(spark, rows), 100), exact(rows, 100)
    assert recall(got, want) >= 0.9
    scores = {(q, j): s for q, w in want.items() for s, j in w}
    assert all(s == scores[q, j] for q, w in got.items() for s, j in w if (q, j) in scores)


def test_embeddings(spark):
    vectors = spark.read.parquet(f"{folder()}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert recall(found(vectors, 10), exact(rows, 10)) >= 0.9
