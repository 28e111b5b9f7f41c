"""The quality sample, URL filter and language models."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from isobar.llm import charmodel, importance, language, urls
from isobar.llm.hashing import Texts, pieces, runs, sums
from isobar.llm.queries import URL_RULES, op3_url_filter
from tests.llm import brute, frames
from tests.llm.tables import documents, folder


def texts_of(rows):
    return next(t for _, t in pieces(pa.array(rows, pa.string()), 1 << 30))


def test_words_and_runs_tell_texts_apart():
    rows = ["", None, "a", "b a", "a b", "ab", " a\tb\n", "a" * 3000, "a" * 3001, "é à", "x " * 9]
    words, at = texts_of(rows).words()
    per = [tuple(words[a:b]) for a, b in zip(at, at[1:])]
    assert [len(p) for p in per] == [len(brute.words(t)) for t in rows]
    assert per[4] == per[6] and per[3] == per[4][::-1] and per[7] != per[8] and per[5] not in (per[3], per[4])
    pairs, pairs_at = runs(words, at, 2)
    assert np.diff(pairs_at).tolist() == [max(len(brute.words(t)) - 1, 0) for t in rows]
    assert sums(np.ones(len(words)), at).tolist() == [len(p) for p in per]


def test_pieces_cover_all_rows_whatever_their_size():
    rows = [None, "", "abc", "é" * 50, "", "x"] * 7
    for size in (1, 10, 1000):
        got = [bytes(t.data[a:b]).decode() for _, t in pieces(pa.array(rows, pa.string()).slice(2), size) for a, b in zip(t.offsets, t.offsets[1:])]
        assert got == [t or "" for t in rows[2:]]


def test_sample_prefers_target_kind_and_has_the_wanted_size(spark):
    docs = frames.awkward(spark)
    got = importance.resample(docs, frames.labels(spark)).collect()
    assert len(got) == len(frames.awkward_rows())
    with_words = sum(bool(brute.words(t)) for _, t, *_ in frames.awkward_rows())
    kept = [r for r in got if r.kept]
    known = {i: (i < 60) for i in range(20, 90)} | {21: False}
    wanted = round(sum(known.values()) / len(known) * len(got))
    assert min(wanted, with_words) <= len(kept) <= min(wanted, with_words) + 1
    assert all(r.key is None and not r.kept for r in got if not r.n_grams)
    of = {r.id: r for r in got}
    assert np.mean([of[i].log_weight for i in range(22, 50)]) > np.mean([of[i].log_weight for i in range(60, 90)])


def test_weights_equal_a_plain_count(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a", "a c", "d d d", "b c d a"])], "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, 0, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    grams = {i: Counter(w) + Counter(zip(w, w[1:])) for i, w in enumerate([x.split() for x in ["a b a", "a c", "d d d", "b c d a"]])}
    raw, target, size, s = sum(grams.values(), Counter()), grams[0] + grams[1], 1 << 18, 0.1
    ratio = {g: math.log((target[g] + s) / (target.total() + s * size)) - math.log((raw[g] + s) / (raw.total() + s * size)) for g in raw}
    got = {r.id: r.log_weight for r in importance.resample(docs, labels).collect()}
    for i, counts in grams.items():
        assert got[i] == pytest.approx(sum(ratio[g] * n for g, n in counts.items()))


def test_without_targets_every_document_with_words_stays(spark):
    got = importance.resample(frames.awkward(spark), frames.labels(spark, [])).collect()
    assert all(r.kept == (r.n_grams > 0) for r in got)
    assert importance.resample(frames.none(spark), frames.labels(spark)).collect() == []


def test_kept_rows_have_their_columns(spark):
    docs, labels = frames.awkward(spark), frames.labels(spark)
    kept = importance.keep_sample(docs, labels)
    assert kept.columns == docs.columns
    wanted = Counter(r.id for r in importance.resample(docs, labels).collect() if r.kept)
    assert Counter(r.doc_id for r in kept.collect()) == wanted


@pytest.mark.parametrize("k", [1, 5, 100, 999, 1000])
def test_threshold_is_the_kth_largest(spark, k):
    values = [math.sin(i) * 10 ** (i % 5) for i in range(990)] + [7.0] * 10
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    assert importance.threshold(keys, k) == sorted(values, reverse=True)[k - 1]


def test_sample_on_labelled_documents(spark):
    docs = documents(spark, "sf0.01")
    labels = spark.read.parquet(f"{folder('sf0.01')}/labels.parquet")
    kept = {r.id: r.kept for r in importance.resample(docs, labels).collect()}
    rows = labels.collect()
    assert np.mean([kept[r.doc_id] for r in rows if r.quality == 1 and not r.toxic]) > 0.9
    assert np.mean([kept[r.doc_id] for r in rows if r.quality == 0]) < 0.2


# characters


def plain_grams(text, rule):
    chars = [x if (x := rule(c)) <= 0xFFFF else 0xD800 + x % (0xF900 - 0xD800) for c in text or ""]
    out = [charmodel.SPACE]
    for c in [*chars, charmodel.SPACE]:
        if c != charmodel.SPACE or out[-1] != charmodel.SPACE:
            out.append(c)
    if len(out) < 3:
        return []
    padded = [charmodel.SPACE] * 3 + out
    return [tuple(padded[i : i + 4]) for i in range(1, len(out))]


def unpack(code):
    return tuple((int(code) >> s) & 0xFFFF for s in (48, 32, 16, 0))


@pytest.mark.parametrize("rule", [charmodel.letters_only, charmodel.any_character])
def test_grams_equal_plain_ones(rule):
    rows = ["Ab  1 c", "", None, "é!", "  x  ", "...", "İß\U00010348z", "a\nb", " "]
    codes, at = charmodel.grams(texts_of(rows), charmodel.Alphabet(rule))
    assert [[unpack(c) for c in codes[a:b]] for a, b in zip(at, at[1:])] == [plain_grams(t, rule) for t in rows]


def plain_model(counts, classes):
    """Interpolated Kneser-Ney by dictionaries: a function of (class, gram)."""
    tables = []
    for c in range(classes):
        orders = {4: dict(counts[c])}
        for order in (3, 2, 1):
            orders[order] = Counter(g[1:] for g in orders[order + 1])
        tables.append(orders)

    def p(c, gram):
        if not gram:
            return charmodel.UNKNOWN
        table = tables[c][len(gram)]
        ones, twos = sum(n == 1 for n in table.values()), sum(n == 2 for n in table.values())
        discount = ones / (ones + 2 * twos) if ones else 0.5
        around = [n for g, n in table.items() if g[:-1] == gram[:-1]]
        if not around:
            return p(c, gram[1:])
        return max(table.get(gram, 0) - discount, 0) / sum(around) + discount * len(around) / sum(around) * p(c, gram[1:])

    return p


def test_model_equals_plain_one():
    rows = ["the cat sat on the mat", "el gato se sienta aquí", "the hat of the cat", "la casa y el gato"]
    counts = [Counter(g for t in rows[c::2] for g in plain_grams(t, charmodel.letters_only)) for c in (0, 1)]
    table = [(c, sum(x << s for x, s in zip(g, (48, 32, 16, 0))), n) for c in (0, 1) for g, n in counts[c].items()]
    model = charmodel.Model(np.array([t[0] for t in table]), np.array([t[1] for t in table], np.uint64), np.array([t[2] for t in table]), 2)
    tests = ["the gato", "zzz that", "cat aquí ñ", ""]
    n, entropy = model.entropies(texts_of(tests), charmodel.Alphabet(charmodel.letters_only))
    p = plain_model(counts, 2)
    for i, text in enumerate(tests):
        grams = plain_grams(text, charmodel.letters_only)
        assert n[i] == len(grams)
        for c in (0, 1):
            expected = -sum(math.log(p(c, g)) for g in grams) / max(len(grams), 1)
            assert entropy[i, c] == pytest.approx(expected, rel=1e-4)


def test_language_of_awkward_rows(spark):
    got = language.identify(frames.awkward(spark)).collect()
    assert len(got) == len(frames.awkward_rows())
    text = defaultdict(list)
    for i, t, *_ in frames.awkward_rows():
        text[i].append(t)
    for r in got:
        fold = None if r.doc_id is None else crc32(str(r.doc_id).encode()) % 5
        assert r.held_out == (fold in (0, None)) and 0 <= r.score <= 1
        if not any(c.isalpha() for t in text[r.doc_id] for c in t or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    spanish = [r for r in got if r.doc_id is not None and 60 <= r.doc_id < 90]
    assert all(r.lang_pred == "es" for r in spanish)
    assert language.identify(frames.none(spark)).collect() == []


def test_without_languages_nothing_is_predicted(spark):
    docs = spark.createDataFrame([(1, "words without a language", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language.identify(docs).collect()} == {("und", 0.0)} | ({("en", r.score) for r in language.identify(docs).collect() if r.lang_pred == "en"})


def test_language_of_held_out_documents(spark):
    docs = documents(spark)
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in language.identify(docs).collect() if r.held_out]
    assert len(held) > 20 and np.mean([lang[r.doc_id] == r.lang_pred for r in held]) > 0.95


def test_shares_rise():
    got = language.rising(np.array([0.0, 5, 1, 9, 9]), np.array([0.0, 5, 9, 9, 9]))
    assert len(got) == 5 and (np.diff(got) >= 0).all() and got[-1] > 0.9


# URLs


def plain_url(url):
    head, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]


def plain_rule(host, path):
    best = None
    for rule, verdict in URL_RULES:
        at, slash, below = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + below) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best


URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG/es/1", "http://example.org/en/12?x=1", "https://a.b.org/", "https://b.org", "http://xorg/", "http://COM/fr/",
    "http://x.com/fr/2#/de/", "http://x.com/de/2", "http://x.com/d", "http://net/y", "a://b://c/d", "http://É.com/fr/", "http://x.org\n/es/", "http://h.example.org/es/5", "http://example.org?es/",
]


def test_rules_for_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(URLS * 2)], "page_id bigint, url string, host string, label int")
    got = urls.filter_urls(pages, URL_RULES).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path = plain_url((URLS * 2)[r.page_id])
        rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])
        assert r.verdict == rule[1] if rule else r.verdict in ("allow", "block")
    assert next(r for r in got if r.page_id == 0).verdict == "block"
    assert urls.filter_urls(pages.where("false"), URL_RULES).collect() == []


CONTRACT = [
    ("http://a.org/x", "org/", "allow"),
    ("http://example.org/en/2", "org/", "allow"),
    ("http://a.example.org/es/2", "example.org/es/", "block"),
    ("http://Example.org/en/1", "example.org/en/1", "block"),
    ("http://a.example.org/en/15?q", "example.org/en/1", "block"),
    ("http://a.com/fr/1", "com/fr/", "allow"),
    ("http://a.com/de/1", "com/de/", "block"),
]


def test_each_rule_has_the_verdict_of_the_contract(spark, tmp_path):
    rows = [(i, url) for i, (url, _, _) in enumerate(CONTRACT)]
    spark.createDataFrame(rows, "page_id bigint, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: (r.rule, r.verdict) for r in op3_url_filter(spark, str(tmp_path)).collect()}
    assert got == {i: (rule, verdict) for i, (_, rule, verdict) in enumerate(CONTRACT)}


def test_url_models_learn_from_rules(spark):
    rows = [(i, f"http://good{i % 7}.org/wiki/article-{i}") for i in range(300)] + [(1000 + i, f"http://casino{i % 7}.com/de/win-big-{i}") for i in range(300)]
    rows += [(5000 + i, f"http://good{i}.net/wiki/article-{i}") for i in range(20)] + [(6000 + i, f"http://casino{i}.net/de/win-big-{i}") for i in range(20)]
    got = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string"), URL_RULES).collect()}
    assert all(got[5000 + i].verdict == "allow" and got[6000 + i].verdict == "block" and got[5000 + i].rule is None for i in range(20))


def test_letters_beyond_sixteen_bits_are_letters(spark):
    """A script beyond U+FFFF is learned like any other, and none of its characters is a space."""
    rows = []
    for i in range(400):
        lang, first, n = (("xa", 0x20020, 40), ("xb", 0x10A00 + 0x10, 4), ("en", 0x61, 26))[i % 3]
        letters = [chr(first + (7 * i + j * j) % n) for j in range(60)]
        rows.append((i, "".join(c if k % 6 else c + " " for k, c in enumerate(letters) if c.isalpha()), lang))
    rows.append((1000, chr(0x20020) * 5, None))
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:-1] if lang != "xb")
    assert got[1000].lang_pred == "xa" and got[1000].score > 0.5
    shared = charmodel.sixteen_bits(np.arange(0x110000))
    assert (shared[:0x10000] == np.arange(0x10000)).all() and shared[0x10000:].min() >= 0xD800 and shared[0x10000:].max() < 0xF900
