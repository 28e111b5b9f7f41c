"""Sharding, mixing, line dedup and rules against plain versions, on awkward rows and on the driver's tables."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from isobar.llm import line_dedup, mixing, quality_rules, sharding
from tests.llm import brute, frames
from tests.llm.tables import documents, folder, parity

OPERATORS = {
    "shards": lambda d: sharding.assign_shards(d, 5),
    "mix": mixing.mix,
    "take": lambda d: mixing.take(d, mixing.mix(d)),
    "lines": line_dedup.dedup_lines,
    "rules": quality_rules.judge,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](frames.none(spark)).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_no_python_in_plan(spark, name):
    plan = OPERATORS[name](frames.awkward(spark))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "MapPartitions"))


def test_shards_follow_the_chain(spark):
    got = sharding.assign_shards(frames.awkward(spark), 5).collect()
    assert len(got) == len(frames.awkward_rows())
    for r in got:
        shard, after = brute.jump(r.doc_id, 5)
        assert (r.shard, r.grown_shard, r.law) == (shard, 5 if after == 5 else shard, "key")
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = Counter((i, len((t or "").encode()) + 8, None if t is None else zlib.crc32(t.encode())) for i, t, *_ in frames.awkward_rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected


def test_one_more_shard_takes_rows_only_into_itself(spark):
    docs = documents(spark)
    for n in (1, 7, 24):
        now, grown = (sharding.assign_shards(docs, m).select("doc_id", F.col("shard").alias(f"s{m}"), "grown_shard") for m in (n, n + 1))
        moved = now.join(grown.drop("grown_shard"), "doc_id").where(f"s{n} <> s{n + 1}")
        assert moved.where(f"s{n + 1} <> {n}").count() == 0
        assert now.join(grown.drop("grown_shard"), "doc_id").where(f"grown_shard <> s{n + 1}").count() == 0


@settings(max_examples=20, deadline=None)
@given(keys=st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=20), shards=st.integers(1, 60))
def test_jump_equals_plain_loop(spark, keys, shards):
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = rows.select("k", sharding.jump(F.col("k"), shards).alias("c")).collect()
    assert all((r.c.b, r.c.j) == brute.jump(r.k, shards) for r in got)


def test_written_shards_hold_all_rows(spark, root):
    docs = documents(spark)
    sharding.write_shards(docs, root, 24)
    stored = spark.read.parquet(root)
    assert stored.count() == docs.count()
    assert stored.where(F.col("shard_folder") != sharding.jump(F.col("doc_id"), 24)["b"]).count() == 0


def test_targets_are_filled_and_shared_again(spark):
    sizes = {"a": 100, "b": 5, "c": 1000, "d": 0, "é": 30, "\uffff": 40, "\U0001f600": 50, None: 70}
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size bigint, units bigint")
    got = {r.source: r.target for r in mixing.source_targets(rows, mixing.WEIGHTS, mixing.SHARE, mixing.MOST).collect()}
    expected = brute.targets(sizes)
    assert got.keys() == expected.keys()
    assert all(abs(got[s] - expected[s]) < 1e-9 * (1 + expected[s]) for s in got)


@pytest.mark.parametrize("block", [4, mixing.BLOCK])
def test_mix_comes_near_targets(spark, block):
    docs = documents(spark, "sf0.01")
    got = mixing.mix(docs, block=block).collect()
    assert sorted(r.id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        share = r.target / r.source_size
        assert r.copies in ((0,) if not r.size else (int(share), -int(-share // 1)))
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert abs(sum(taken.values()) / sum(target.values()) - 1) < 0.02
    assert sorted(got) == sorted(mixing.mix(docs, block=block).collect())


def test_mixing_keeps_expectations(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "b" if i % 2 else "a") for i in range(24)], "doc_id bigint, text string, source string")
    total, share = Counter(), {}
    runs = 60
    for seed in range(runs):
        for r in mixing.mix(docs, weights=(1, 3), share=0.8, most=1, seed=str(seed), block=6).collect():
            total[r.id] += r.copies
            share[r.id] = r.target / r.source_size
    assert all(abs(total[i] / runs - share[i]) < 0.35 for i in share)
    assert abs(sum(total.values()) / runs - sum(share.values())) < 1.5


def test_take_repeats_rows_with_all_columns(spark):
    docs = frames.awkward(spark)
    mixed = mixing.mix(docs)
    got = mixing.take(docs, mixed)
    assert got.columns == docs.columns
    expected = Counter()
    for r in mixed.collect():
        expected[r.id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in got.collect()) == +expected


def test_awkward_lines(spark):
    rows = [(i, t) for i, t, *_ in frames.awkward_rows()]
    got = line_dedup.dedup_lines(frames.awkward(spark)).collect()
    plain = brute.dedup_lines([(-(2**63) if i is None else i, t) for i, t in rows], line_dedup.WINDOW)
    expected = Counter((i, t, kept, removed) for (i, t), (kept, removed) in zip(rows, plain, strict=True))
    assert Counter((r.row.doc_id, r.row.text, r.kept_text, r.n_removed) for r in got) == expected
    assert any(r.n_removed for r in got) and all(r.row.label == "l" for r in got)


def test_cuts_survive_insertions(spark):
    passage = [f"sentence {i} of the passage" for i in range(40)]
    rows = [(i, "\n".join([f"own {i} {j}" for j in range(i)] + passage + [f"tail {i}"])) for i in range(6)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("row.doc_id").collect()
    assert got[0].n_removed == 0 and all(r.n_removed == 40 for r in got[1:])


@pytest.mark.parametrize("window", [1, 2, 3])
def test_lines_equal_plain_version(spark, window):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.row.doc_id: (r.kept_text, r.n_removed) for r in line_dedup.dedup_lines(docs, window).collect()}
    assert got == dict(zip([i for i, _ in rows], brute.dedup_lines(rows, window), strict=True))


def test_rules_equal_plain_version(spark):
    rows = frames.awkward_rows()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = quality_rules.judge(frames.awkward(spark)).collect()
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter((i, *brute.rules(t)) for i, t, *_ in rows)
    for r in got:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and not r.host_refused)


def test_a_bad_host_is_refused_and_small_hosts_are_not(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, "bad" if i % 20 else good, "bad.org") for i in range(400)] + [(1000 + i, good, f"good{i % 5}.org") for i in range(400)]
    rows += [(5000, "bad", "tiny.org"), (5001, good, "tiny.org")]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    verdict = {r.host: r.host_refused for r in got}
    assert verdict == {"bad.org": True, "tiny.org": False, **{f"good{i}.org": False for i in range(5)}}
    assert not any(r.kept for r in got if r.host == "bad.org") and next(r for r in got if r.doc_id == 5001).kept


@pytest.mark.parametrize("name", ["op5_mixing", "op6_line_dedup", "op6_line_runs", "op7_quality_rules"])
def test_query_equals_sql(spark, name):
    assert parity(spark, folder(), name) == ""
