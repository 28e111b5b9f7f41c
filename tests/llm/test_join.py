"""The similarity join against comparing all pairs, and components against a plain search."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from isobar.llm import components, jaccard
from isobar.llm.components import connected
from isobar.llm.hashing import pieces
from isobar.session import stage
from tests.llm import brute, frames
from tests.llm.tables import documents


def joined(docs, **limits):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, **limits).collect()}


def expected(rows):
    found = brute.components(rows)
    return {i: (len(brute.shingles(t)), found[i]) for i, t in rows.items()}


def near_copies(seed=3, groups=6, copies=14, words=60):
    """Copies of originals with a few words changed; many pairs lie close to the threshold."""
    random.seed(seed)
    rows, i = {}, 0
    for g in range(groups):
        original = [f"g{g}w{random.randrange(400)}" for _ in range(words + 10 * g)]
        for _ in range(copies):
            changed = list(original)
            for _ in range(random.randrange(0, 4)):
                changed[random.randrange(len(changed))] = f"n{random.randrange(10**6)}"
            rows[i] = " ".join(changed[: len(changed) - random.randrange(0, 8)])
            i += 1
    return rows


def frame(spark, rows):
    return spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")


@pytest.mark.parametrize("limits", [{}, {"region": 8, "pivots": 2}, {"region": 4, "pivots": 1}])
def test_near_copies(spark, limits):
    rows = near_copies()
    assert joined(frame(spark, rows), **limits) == expected(rows)


def test_a_common_passage_does_not_link(spark):
    shared = " ".join(f"shared{i}" for i in range(50))
    rows = {i: shared + " " + " ".join(f"own{i}x{j}" for j in range(60)) for i in range(60)}
    rows |= {100 + i: shared + f" end{i}" for i in range(30)}
    assert joined(frame(spark, rows), region=16) == expected(rows)


def test_documents(spark):
    docs = documents(spark)
    rows = {r.doc_id: r.text for r in docs.collect()}
    assert joined(docs) == expected(rows)


def test_awkward_rows(spark):
    rows = frames.awkward_rows()
    got = jaccard.near_duplicates(frames.awkward(spark)).collect()
    assert len(got) == len(rows)
    known = {i: t for i, t, *_ in rows if i is not None}
    want = expected(known)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == Counter((i, *want[i]) for i, *_ in rows if i is not None)
    assert {r.component_id for r in got if r.doc_id is None} == {None, 0} or all(r.component_id in (None, 0) for r in got if r.doc_id is None)
    assert jaccard.near_duplicates(frames.none(spark)).collect() == []


def test_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(2)
    sets = []
    for i in range(120):
        s = rng.integers(0, 2**63, 5 + 3 * i, dtype=np.uint64)
        for _ in range(3):
            changed = s.copy()
            changed[: rng.integers(0, 2 + len(s) // 5)] = rng.integers(0, 2**63, 1)
            sets.append(np.unique(changed))
    everyone, alone_each = np.ones(len(sets), bool), np.arange(len(sets))
    near = jaccard.near_in_sketch(np.array([len(s) for s in sets]), [jaccard.sketch(s) for s in sets], everyone, alone_each, 80)
    for i, s in enumerate(sets):
        common = np.array([len(np.intersect1d(s, t)) for t in sets])
        union = len(s) + np.array([len(t) for t in sets]) - common
        linked = 100 * common >= 80 * union
        linked[i] = False
        assert near[i] or not linked.any()
    alone = [rng.integers(0, 2**63, 300, dtype=np.uint64) for _ in range(50)]
    assert not jaccard.near_in_sketch(np.full(50, 300), [jaccard.sketch(s) for s in alone], everyone[:50], np.arange(50), 80).any()
    same = [jaccard.sketch(alone[0])] * 4
    assert jaccard.near_in_sketch(np.full(4, 300), same, np.array([True, False, False, False]), np.array([0, 0, 1, 2]), 80).tolist() == [True, False, True, True]


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """The session's own limit holds again afterwards, and a lower one is kept."""
    name, given = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    monkeypatch.setattr(jaccard, "stage", lambda df: given.append(int(spark.conf.get(name))) or stage(df))
    docs = spark.createDataFrame([(i, f"a b c d e f g {i % 3}") for i in range(9)], "doc_id bigint, text string")
    before = spark.conf.get(name)
    try:
        for limit, used in ((10_000, jaccard.BATCH), (7, 7), (0, jaccard.BATCH)):
            spark.conf.set(name, str(limit))
            given.clear()
            assert len(jaccard.near_duplicates(docs).collect()) == 9
            assert given[0] == used and len(given) > 4 and spark.conf.get(name) == str(limit)
    finally:
        spark.conf.set(name, before)


def test_common_shingles_of_a_stretch(monkeypatch):
    """Those that enough documents have, with their counts, of each stretch by itself."""
    monkeypatch.setattr(jaccard, "STRETCH", 50)
    texts = [f"one two three four five six {'seven' if i % 3 else 'eight'} nine {'ten' if i % 20 else i} x y z {i % 12} q" for i in range(103)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array(range(a, b)), "text": texts[a:b]}) for a, b in ((0, 50), (50, 100), (100, 103))]
    sets = [list(jaccard.shingle_sets(t))[0] for text in texts for _, t in pieces(pa.array([text]))]
    plain = []
    for a, b in ((0, 50), (50, 100), (100, 103)):
        counts = Counter(int(x) for s in sets[a:b] for x in s if x < 1 << 62)
        plain += sorted((x, n) for x, n in counts.items() if n >= jaccard.LEAST_COMMON)
    rows = [r for b in jaccard._survey(iter(batches)) for r in b.to_pylist()]
    assert plain and [(r["d1"], r["n"]) for r in rows if r["kind"] == 1] == plain
    assert [r["n"] for r in rows if r["kind"] == 0] == [len(s) for s in sets]


def test_regions_too_large_for_sketches(spark, monkeypatch):
    """Dealt out among pivots first, in the same pass as small regions; what is open then is joined by Voronoi regions."""
    monkeypatch.setattr(jaccard, "SKETCH_PART", 16)
    windows, whole = [], jaccard.Join.window_parts
    monkeypatch.setattr(jaccard.Join, "window_parts", lambda *a: windows.append(1) or whole(*a))
    rows = near_copies(seed=8, groups=4, copies=30)
    shared = " ".join(f"shared{i}" for i in range(100))
    rows |= {1000 + i: shared + " " + " ".join(f"own{i // 2}x{j}" for j in range(22)) + f" end{i}" for i in range(40)}
    assert joined(frame(spark, rows), region=6, pivots=2) == expected(rows)
    assert windows


def test_crowded_regions_take_few_passes(spark, monkeypatch):
    """Texts go to the tasks that join once for all regions, and once more for what is still open."""
    passes, run = [], jaccard.Join._run
    monkeypatch.setattr(jaccard.Join, "_run", lambda self, rows, texts, work, schema: passes.append(work.__name__) or run(self, rows, texts, work, schema))
    rows = near_copies()
    assert joined(frame(spark, rows), region=8, pivots=2) == expected(rows)
    assert passes.count("_join_parts") <= 2


def test_edges_merged_in_a_task():
    rng = np.random.default_rng(4)
    for n, m in ((2, 1), (50, 30), (400, 390), (300, 2000)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        low = list(range(n))
        for _ in range(n):
            for x, y in zip(a, b, strict=True):
                low[x] = low[y] = min(low[x], low[y])
        node, comp = components._forest(a, b)
        assert dict(zip(node.tolist(), comp.tolist(), strict=True)) == {i: low[i] for i in range(n) if low[i] != i}
    chain = np.random.default_rng(5).permutation(5000)
    node, comp = components._forest(chain[1:], chain[:-1])
    assert sorted(node.tolist()) == list(range(1, 5000)) and not comp.any()


def test_components_within_a_task_need_no_round(spark, monkeypatch):
    rounds, star = [], components._large_star
    monkeypatch.setattr(components, "_large_star", lambda edges: rounds.append(1) or star(edges))
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001)]
    got = {r.node: r.comp for r in connected(spark.createDataFrame(edges, "a bigint, b bigint").coalesce(1)).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert not rounds


def test_components_of_edges_that_no_task_holds_together(spark, monkeypatch):
    """With nothing merged, the rounds do all."""
    monkeypatch.setattr(components, "_merged", lambda edges: stage(edges))
    rounds, star = [], components._large_star
    monkeypatch.setattr(components, "_large_star", lambda edges: rounds.append(1) or star(edges))
    random.seed(6)
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 200) for i in range(20)] + [(7, 8), (8, 7), (5, 5)]
    random.shuffle(edges)
    got = {r.node: r.comp for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(20)}, 200: 100}
    assert rounds


def test_components(spark):
    random.seed(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (300, 301), (301, 300)]
    random.shuffle(edges)
    got = {r.node: r.comp for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 300, 301: 300}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
