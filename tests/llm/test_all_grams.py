"""The character models keep every gram, in files that workers map."""

from __future__ import annotations

import itertools
import pickle
import random
from functools import partial
from zlib import crc32

import numpy as np
import pytest

from isobar.llm import charmodel, language
from tests.llm import frames
from tests.llm.test_models import texts_of

CLASSES = ("en", "es", "none", "zh")


def counts(rows):
    """What ``count_task`` finds, as arrays."""
    k, codes = [], []
    alphabet = charmodel.Alphabet(charmodel.letters_only)
    for text, label in rows:
        found, _ = charmodel.grams(texts_of([text]), alphabet)
        codes.append(found)
        k.append(np.full(len(found), CLASSES.index(label)))
    both, n = np.unique(np.stack([np.concatenate(k).astype(np.uint64), np.concatenate(codes)]), axis=1, return_counts=True)
    return both[0].astype(int), both[1], n


def rows(n=300):
    draw = random.Random(3)
    letters = {"en": "abcdefgh", "es": "abcñóéqr", "zh": [chr(0x9000 + i) for i in range(400)]}
    return [("".join(draw.choice([*letters[c], " "]) for _ in range(40)), c) for c in letters for _ in range(n)]


@pytest.mark.parametrize("least", [1, 4])
def test_shared_tables_equal_those_in_memory(spark, least):
    docs = rows()
    model = charmodel.Model(*counts(docs), len(CLASSES), least)
    task = partial(charmodel.count_task, classes=CLASSES, rule=charmodel.letters_only)
    shared = pickle.loads(pickle.dumps(charmodel.fitted(spark.createDataFrame(docs, "text string, label string"), task, len(CLASSES), least)))
    assert (shared.seen, shared.classes) == (3, 4)
    texts = texts_of([t for t, _ in rows(20)] + ["", "ñandú 鐀", "zzz", "\U0001f600"])
    got, wanted = (m.entropies(texts, charmodel.Alphabet(charmodel.letters_only)) for m in (shared, model))
    assert got[0].tolist() == wanted[0].tolist() and got[1] == pytest.approx(wanted[1], rel=1e-5)
    distinct = {(k, c) for k, c in zip(*counts(docs)[:2])}
    assert shared.bounds[charmodel.ORDER] - shared.bounds[charmodel.ORDER - 1] == len(distinct) > 10_000


def test_nothing_to_learn_from(spark):
    task = partial(charmodel.count_task, classes=CLASSES, rule=charmodel.letters_only)
    shared = charmodel.fitted(frames.none(spark).selectExpr("lang label", "text"), task, len(CLASSES))
    _, entropy = shared.entropies(texts_of(["abc"]), charmodel.Alphabet(charmodel.letters_only))
    assert shared.seen == 0 and entropy[0] == pytest.approx(-np.log(charmodel.UNKNOWN))


def in_fold(folds, begin):
    return (i for i in itertools.count(begin) if crc32(str(i).encode()) % language.FOLDS in folds)


def test_a_rare_language_keeps_its_grams_next_to_a_common_one(spark):
    """More than 2^20 different grams of one language, each of them more frequent than those of another."""
    draw, ids, held = np.random.default_rng(5), in_fold((2, 3, 4), 0), in_fold((0,), 10**6)
    common = ["".join(map(chr, draw.integers(0x4E00, 0x9E00, 12_000).tolist())) for _ in range(100)]
    rows = [(next(ids), t, "zh") for t in [*common, *common, *common[:1], *common[:1]]]
    rows += [(next(ids), "the cat and the bird are not in the house but near it", "en") for _ in range(4)]
    rows += [(next(ids), "la niña y el señor comen una manzana en casa", "es")]
    rows += [(next(held), t, None) for t in ("la casa y una manzana", "el señor y la niña")]
    got = language.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).where("doc_id >= 1000000").collect()
    assert [r.lang_pred for r in got] == ["es", "es"]
