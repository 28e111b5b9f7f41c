"""The Merkle manifest against a plain one."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from isobar.llm import merkle
from isobar.llm.order import places
from isobar.llm.queries import registered
from tests.llm import frames
from tests.llm.tables import folder, parity

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(row, text):
    values = [*[row[c] for c in FIELDS[:-1]], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def fold(nodes):
    """All levels, from ``nodes`` to the single last one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain(rows):
    rows = [r.asDict() for r in rows]
    for r in rows:
        r["leaf"] = digest(r, r["text"])
        altered = r["text"] is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        r["tampered"] = digest(r, r["text"].translate(LOWER)) if altered else r["leaf"]
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"], r["tampered"]))
        trees[s] = (own, fold([r["leaf"] for r in own]))
    top = fold([trees[s][1][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        own, levels = trees[s]
        for i, r in enumerate(own):
            proof, folded = "", r["tampered"]
            for tree, at in ((levels, i), (top, k)):
                for level in tree[:-1]:
                    run, slot = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    proof += "".join(run[:slot] + run[slot + 1 :])
                    folded = sha("".join([*run[:slot], folded, *run[slot + 1 :]]))
                    at //= 16
            out.append((r["doc_id"], r["leaf"], levels[-1][0], top[-1][0], sha(proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def proofs(docs):
    found = merkle.Manifest(docs).proofs().select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted((tuple(r) for r in found), key=str)


def test_awkward_documents(spark):
    docs = frames.awkward(spark).withColumn("text", F.concat(F.lit("ÉTé À "), "text")).repartition(5)
    got = proofs(docs)
    assert got == plain(docs.select(*FIELDS).collect())
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (16,), (17,), (1, 1), (300, 1, 2), (1,) * 18, (16, 257) + (3,) * 30], ids=str)
def test_shapes_of_trees(spark, sizes):
    rows = [(1000 * s + i, f"Text {i} of {s}", None, f"s{s:02d}" if s else None, i) for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert proofs(docs) == plain(docs.select(*FIELDS).collect())


def test_equal_rows_are_leaves_of_their_own(spark):
    docs = spark.range(700).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit("Same").alias("text"), F.lit(None).cast("string").alias("lang"), F.lit("a").alias("source"), F.lit(4).alias("n_chars"))
    assert proofs(docs) == plain(docs.select(*FIELDS).collect())


def test_empty_table(spark):
    assert proofs(frames.none(spark)) == []


def test_query_against_plain(spark):
    docs = spark.read.parquet(f"{folder()}/documents.parquet")
    got = registered()["op12_merkle"](spark, folder())
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs.select(*FIELDS).collect())


def test_query_against_sql(spark):
    assert not parity(spark, folder(), "op12_merkle")


def test_more_levels_than_the_limit_on_rows_allows(spark):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "3")
    try:
        docs = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(1).alias("n_chars"))
        assert len(proofs(docs)) == 600 and spark.conf.get("spark.sql.cteRecursionRowLimit") == "3"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")


def test_places(spark):
    rows = spark.createDataFrame([(g, v) for g in ("a", "b", None) for v in (3, 1, 2, 2, None)], "g string, v int").repartition(4)
    got = sorted(((r.g or "", r.pos, r.v) for r in places(rows, ["g"], [F.col("v").desc_nulls_last()]).collect()))
    assert got == [(g, i, v) for g in ("", "a", "b") for i, v in enumerate((3, 2, 2, 1, None))]
