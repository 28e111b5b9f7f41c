"""Awkward rows that every operator must take: NULLs in any column, empty and very long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, kept boolean, row string, id string,"
    " label string, node int, target double, salt string, copies int"
)
LINES = [f"line {i} says something of its own here" for i in range(12)]
PASSAGE = "\n".join(f"shared passage line {i} with quite a few words in it" for i in range(8))
PROSE = "the quick brown fox jumps over the lazy dog while seven other animals look on and wonder what it may mean for them"


def awkward_rows() -> list[tuple]:
    texts = [
        (0, PROSE, "en", "a"),
        (1, PROSE, "en", "a"),
        (2, PROSE + " today", "en", None),
        (3, None, None, None),
        (4, "", "en", "b"),
        (5, " \n\t\n ", "de", "b"),
        (6, "one two three", "en", "b"),
        (7, "ONE two three", None, "b"),
        (8, "\n".join(LINES[:3]) + "\n" + PASSAGE + "\n" + LINES[4], "en", "a"),
        (9, "\n".join(LINES[5:8]) + "\n" + PASSAGE, "en", "c"),
        (9, "\n".join(LINES[5:8]) + "\n" + PASSAGE, "en", "c"),
        (10, "word " * 20_000, "en", "c"),
        (11, "x" * 50_000, "xx", "c"),
        (12, "año niño señal corazón llave calle que como muy bien todo día más aquí", "es", "a"),
        (13, "12345 !!! ### 67890", "en", "a"),
        (14, "same line twice\nsame line twice\nsame line twice", "en", "é"),
        (None, PROSE + " without an id", "en", "a"),
        (None, None, None, None),
        (15, "\U0001f600 emoji \U00010348 gothic ﬁ İ Σ", "en", "\uffff"),
    ]
    more = [(20 + i, f"{PROSE} variant {i} " + " ".join(f"w{i}x{j}" for j in range(40)), "en", "abc"[i % 3]) for i in range(30)]
    more += [(60 + i, " ".join(f"palabra{i}y{j} niño señor llama" for j in range(15)), "es", "abc"[i % 3]) for i in range(30)]
    clash = (None, True, "r", "i", "l", None, 0.5, "s", None)
    return [(i, t, lang, s, None if t is None else len(t), *clash[:0], None, *clash[1:]) for i, t, lang, s in texts + more]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS)


def none(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=None):
    rows = [(i, 1 if i < 60 else 0, 0) for i in range(20, 90)] + [(20, None, None), (21, 1, 1), (None, 1, 0), (22, 1, None)] if rows is None else rows
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
