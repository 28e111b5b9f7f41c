"""Encoding and decoding against the tokenizers library."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from isobar.llm import bpe, lexicon
from tests.llm import frames
from tests.llm.tables import documents

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, world! it's I'll 12 x3", "<|startoftext|>Hi <|endoftext|> İstanbul ΣΑΣ ẞ café café", "", "a" * 300, "ab" * 3000 + "'s't",
    "\x1c\x1d a\x85b\xa0c d　e", "naïve ¼ ² ½ ௧ Ⅷ ǅ ŉ ﬁ", "''''sss 'S 'T n't", "<|startoftext|><|startoftext|>", "日本語 🎉🎉👍🏽", "\x00 \U0010ffff",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def coder():
    spec = bpe.prepared(open(PATH, encoding="utf-8").read())
    vocabulary = bpe.Vocabulary(spec)
    words = Counter(w for t in TEXTS for w in vocabulary.words(t))
    return bpe._Coder(spec, lexicon.build({w.encode(): vocabulary.merge(w) for w in sorted(words)[::2]}))


def ids_of(coder, texts):
    ids, at = coder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_ids(coder, library):
    assert ids_of(coder, TEXTS) == [e.ids for e in library.encode_batch(TEXTS, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=200) | st.text("abcdehinrst '!1é\n", max_size=300))
def test_any_text(coder, library, text):
    assert ids_of(coder, [text]) == [library.encode(text, add_special_tokens=False).ids]


def test_characters_belong_to_the_same_classes(coder, library):
    texts = ["a" + chr(c) + "a" for c in range(0x80, 0x3000, 7)] + ["a" + chr(c) + "a" for c in range(0xE000, 0x20000, 61)]
    assert ids_of(coder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=50, deadline=None)
@given(words=st.sets(st.binary(min_size=1, max_size=6), max_size=60), others=st.lists(st.binary(max_size=6), max_size=20))
def test_lexicon_finds_its_words_and_no_others(words, others):
    rows = {w: [len(w), *w] for w in words}
    found = lexicon.Lexicon(lexicon.build(rows))
    asked = [*words, *others]
    for word, place in zip(asked, found.find(asked).tolist(), strict=True):
        assert (place >= 0) == (word in words)
        if place >= 0:
            assert found.values[found.offsets[place] : found.offsets[place + 1]].tolist() == rows[word]


def test_lexicon_shares_suffixes():
    stems = [f"stem{i:03d}".encode() for i in range(200)]
    shared = lexicon.Lexicon(lexicon.build({s + b"ingness": [1] for s in stems}))
    assert len(shared.final) < 200 + 40


@pytest.mark.parametrize("most", [0, 5, 1 << 17])
def test_documents_round_trip(spark, library, most):
    docs = frames.awkward(spark).union(documents(spark).limit(60).selectExpr(
        "doc_id", "text", "lang", "source", "n_chars", "NULL size", "true kept", "'r' row", "'i' id", "'l' label", "NULL node", "0.5D target", "'s' salt", "NULL copies"))
    tokenizer = bpe.WordBpe(PATH).fit(docs, most=most)
    got = tokenizer.decode(tokenizer.encode(docs)).collect()
    assert len(got) == docs.count()
    for r in got:
        ids = library.encode(r.row.text or "", add_special_tokens=False).ids
        assert r.bpe_ids == ids and r.bpe_decoded == library.decode(ids, skip_special_tokens=False)
        assert r.row.label == "l"


def test_a_task_keeps_one_python_worker_and_one_copy_of_a_text(spark, monkeypatch):
    tokenizer = bpe.WordBpe(PATH)
    plan = tokenizer.decode(tokenizer.encode(documents(spark)).select("row.doc_id", "bpe_ids"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "bpe_text" not in plan
    given, encode = [], bpe._Coder.encode
    monkeypatch.setattr(bpe._Coder, "encode", lambda self, texts: given.append(sum(map(len, texts))) or encode(self, texts))
    rows = pa.array([{"id": i, "text": "word " * 2000} for i in range(300)])
    batch = pa.RecordBatch.from_arrays([rows], ["row"])
    coded = pa.Table.from_batches(bpe._encode(iter([batch.slice(0, 0), batch.slice(3)]), tokenizer.spec, tokenizer.lexicon, 1))
    assert coded["row"].to_pylist() == rows[3:].to_pylist() and set(map(len, coded["bpe_ids"].to_pylist())) == {2000}
    assert sum(given) == 297 * 10_000 and max(given) < (1 << 18) + 10_000


def test_text_of_a_nested_column(spark):
    docs = spark.createDataFrame([(1, ("a b c",)), (2, (None,))], "id bigint, held struct<text: string>")
    got = {r.row.id: r for r in bpe.WordBpe(PATH).encode(docs, "held.text").collect()}
    assert len(got[1].bpe_ids) == 3 and got[2].bpe_ids == [] and got[1].row.held.text == "a b c"


def test_decoding_of_given_ids(spark, library):
    lists = [[], None, list(range(len(library.get_vocab()))), [5, 1 << 20, 7, -1, 9]]
    coded = spark.createDataFrame(list(enumerate(lists)), "id int, bpe_ids array<int>")
    got = {r.id: r.bpe_decoded for r in bpe.WordBpe(PATH).decode(coded).collect()}
    assert got[0] == got[1] == "" and got[2] == library.decode(lists[2], skip_special_tokens=False)
    assert got[3] == library.decode([5, 1 << 20, 7, 9], skip_special_tokens=False)


def test_empty_table(spark):
    tokenizer = bpe.WordBpe(PATH).fit(frames.none(spark))
    assert tokenizer.decode(tokenizer.encode(frames.none(spark))).collect() == []
