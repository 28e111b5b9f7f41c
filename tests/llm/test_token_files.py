"""Directly addressable codes, and token files against the tokenizers library."""

from __future__ import annotations

import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from isobar.llm import dac, token_files
from isobar.llm.queries import registered
from tests.llm import frames
from tests.llm.tables import documents, folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "Hello, world! it's I'LL  12 x3 ", "<|endoftext|>Hi <|endoftext|> İstanbul ΣΑΣ ẞ café café", "", "ab" * 3000 + "'s't",
    "\x1c\x1d a\x85b\xa0c d　e​᠎ f", "naïve ¼ ² ½ ௧ Ⅷ ǅ ŉ ﬁ", "''''sss 'S 'T n't\n\n \n x", "日本語 🎉🎉👍🏽 한국어 ไทย \U00020020\U0001e900",
    "\x00 \U0010ffff ﻿", "   ", " \t\n",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    with open(PATH, encoding="utf-8") as file:
        return token_files.ByteBpe(file.read())


@settings(max_examples=100, deadline=None)
@given(
    numbers=st.lists(st.integers(0, 300) | st.integers(0, 70_000) | st.integers(0, 2**64 - 1), max_size=1500),
    wanted=st.lists(st.integers(0, 10**6), max_size=30), data=st.data(),
)
def test_codes_read_any_place(numbers, wanted, data):
    codes = dac.Codes(dac.encode(np.array(numbers, np.uint64)))
    places = [w % len(numbers) for w in wanted] if numbers else []
    assert codes.get(np.array(places, np.int64)).tolist() == [numbers[p] for p in places]
    a = data.draw(st.integers(0, len(numbers)))
    b = data.draw(st.integers(a, len(numbers)))
    assert codes.run(a, b).tolist() == numbers[a:b]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_codes_at_the_edges_of_blocks(n):
    numbers = np.random.default_rng(n).integers(0, 1 << 17, n).astype(np.uint64)
    codes = dac.Codes(dac.encode(numbers))
    assert np.array_equal(codes.run(0, n), numbers) and np.array_equal(codes.get(np.arange(n)[::-1]), numbers[::-1])
    with pytest.raises(IndexError):
        codes.run(0, n + 1)
    with pytest.raises(IndexError):
        codes.get(np.array([n]))
    with pytest.raises(ValueError):
        dac.Codes(b"none")


def test_ids(coder, library):
    assert coder.fast
    for text in TEXTS:
        assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=200) | st.text("abcdehinrst '!1é\n ", max_size=300))
def test_any_text(coder, library, text):
    assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_class_of_character(coder, library):
    for c in [*range(0x80, 0x3000, 5), *range(0xE000, 0x32000, 97)]:
        text = f"the{chr(c)}re {chr(c)}12{chr(c)}{chr(c)} \n{chr(c)}  the"
        assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_another_file_is_left_to_the_library():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        spec = file.read()
    other = token_files.ByteBpe(spec)
    assert other.fast is None
    assert other.encode("Hello there").tolist() == Tokenizer.from_str(spec).encode("Hello there", add_special_tokens=False).ids


def test_a_word_without_end_is_encoded_in_time(coder):
    started = time.time()
    coder.encode("x" * 1_000_000)
    assert time.time() - started < 30


def plain(library, rows):
    """(doc_id, start, n_tokens, ids_crc32) and all ids, for rows that differ in their ids."""
    out, all_ids = [], []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, len(all_ids), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        all_ids += ids
    return out, all_ids


def test_query_against_the_library(spark, library):
    got = registered()["op13_token_files"](spark, folder())
    assert sorted(map(tuple, got.collect())) == plain(library, [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()])[0]


@pytest.mark.parametrize("size", [1, 700, token_files.SEGMENT])
def test_awkward_documents_and_any_position(spark, library, root, size):
    docs = frames.awkward(spark).repartition(3)
    files = token_files.write_tokens(docs, root, PATH, size=size)
    got = sorted((tuple(r) for r in files.documents().collect()), key=lambda r: r[1])
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows) and [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]
    assert [r[0] or -1 for r in got] == sorted((r.doc_id or -1 for r in rows))
    want = plain(library, [(r.doc_id, r.text) for r in rows])[0]
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in got) == sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in want)
    total = got[-1][1] + got[-1][2]
    ids = {r.position: r.token_id for r in files.tokens_at(spark.range(-3, total + 3), size=max(size, 50)).collect()}
    assert sorted(ids) == list(range(total))
    for doc_id, start, n, crc in got:
        assert ids[start + n - 1] == 0 and zlib.crc32(np.array([ids[start + i] for i in range(n)], "<u4").tobytes()) == crc


def test_repeated_rows_spread_over_partitions(spark, root):
    docs = spark.range(4000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("the same text again").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = token_files.write_tokens(docs, root, PATH)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.read.parquet(root).groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()
    assert len(parts) > 4 and max(r.n for r in parts) < 1500
    assert files.documents().agg(F.count("*"), F.countDistinct("start"), F.countDistinct("ids_crc32")).first() == (4000, 4000, 1)


def test_empty_table(spark, root):
    files = token_files.write_tokens(frames.none(spark), root, PATH)
    assert files.documents().collect() == [] and files.tokens_at(spark.range(3)).collect() == []
