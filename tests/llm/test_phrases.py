"""Phrase mining against plain counting."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isobar.llm import phrases
from isobar.llm.queries import registered
from tests.llm import frames
from tests.llm.tables import documents, folder, parity

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def counts(rows):
    found = Counter()
    for lang, text in rows:
        for ws in words_of(text):
            for n in range(1, 6):
                found.update((lang or "und", *ws[i : i + n]) for i in range(len(ws) - n + 1))
    return found


def plain(rows, frequent, top):
    f = counts(rows)
    total = Counter()
    for (lang, *ws), a in f.items():
        if len(ws) == 1:
            total[lang] += a
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= frequent}
    swallowed = set()
    for (lang, *ws), a in candidates.items():
        for i in range(len(ws)):
            for j in range(i + 2, len(ws) + 1):
                inner = (lang, *ws[i:j])
                if j - i < len(ws) and a >= candidates[inner]:
                    swallowed.add(inner)
    out = []
    for (lang, *ws), a in candidates.items():
        if (lang, *ws) in swallowed:
            continue
        cuts = [(1000 * a * total[lang] // (f[(lang, *ws[:k])] * f[(lang, *ws[k:])]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.append((lang, score, a, " ".join(ws), f[(lang, *ws[:k])], f[(lang, *ws[k:])], total[lang]))
    out.sort(key=lambda r: (r[0], -r[1], -r[2], r[3].encode()))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right, n in out:
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase, a, left, right, n, score))
    return ranked


def mined(docs, **limits):
    return sorted(tuple(r) for r in phrases.collocations(docs, **limits).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.mark.parametrize("frequent, top, sample, bits", [(100, 2000, 0.125, 27), (12, 2000, 0.125, 27), (5, 40, 0.02, 27), (5, 2000, 0.0, 27), (12, 2000, 0.3, 8)])
def test_equals_plain_counting(docs, frequent, top, sample, bits):
    """Whatever the sample proposes, also nothing, and however small the filter."""
    want = plain([(r.lang, r.text) for r in docs.select("lang", "text").collect()], frequent, top)
    assert mined(docs, frequent=frequent, top=top, sample=sample, most_bits=bits) == want and want


def test_border_failures_are_seen_and_mended(docs):
    """Nothing fails if the sample is everything; everything frequent does if it is nothing."""
    whole, none = phrases.frequent_phrases(docs, 12, 1.0), phrases.frequent_phrases(docs, 12, 0.0)
    assert whole[1] == 0 < none[1]
    assert sorted(map(tuple, whole[0].collect())) == sorted(map(tuple, none[0].collect()))


def test_awkward_documents(spark):
    docs = frames.awkward(spark)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    for frequent in (2, 30):
        assert mined(docs, frequent=frequent) == plain(rows, frequent, 2000)


def test_null_language_and_und_are_one(spark):
    docs = spark.createDataFrame([(None, "New York is new york"), ("und", "NEW YORK"), ("en", "new york"), ("x y", "new\tyork  new york")], "lang string, text string")
    got = mined(docs, frequent=2)
    assert got == [("und", 1, "new york", 3, 3, 3, 7, 2333), ("x y", 1, "new york", 2, 2, 2, 4, 2000)]


def test_products_beyond_64_bits_are_exact(spark):
    rows = [("en", 0, "", 9 * 10**15), ("en", 1, "a", 3 * 10**15 + 1), ("en", 1, "b", 2 * 10**15 + 3), ("en", 2, "a b", 2 * 10**15 - 7)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, n int, phrase string, a bigint")).collect()
    assert [(r.phrase, r.score) for r in got] == [("a b", 1000 * (2 * 10**15 - 7) * 9 * 10**15 // ((3 * 10**15 + 1) * (2 * 10**15 + 3)))]


def test_empty_table(spark):
    assert mined(frames.none(spark)) == []


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 22])
def test_blocks_are_cut_between_pieces(size):
    texts = ["A b,c d", None, "", "é f" * 5, "g;;h i\nj " * 9, "." * 4, " k", "l m"]
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y"] * 4), pa.array(texts, pa.string())], ["lang", "text"]).slice(1)
    got = []
    for block, names, codes in phrases.blocks(iter([batch]), size):
        spelled = block.spelled(np.arange(len(block.hashes)), 1).to_pylist() if len(block.hashes) else []
        got += [(names[codes[block.text[i]]], w) for i, w in enumerate(spelled)]
    assert got == [(lang, w) for lang, text in zip(["y", "x"] * 4, texts[1:]) for ws in words_of(text) for w in ws]


def test_repeated_rows_count_each(spark):
    docs = spark.range(500).select(F.lit("en").alias("lang"), F.lit("to be or not to be").alias("text"))
    assert mined(docs) == plain([("en", "to be or not to be")] * 500, 100, 2000)


def test_query_against_sql(spark):
    assert "op11_collocations" in registered()
    assert not parity(spark, folder(), "op11_collocations")
