"""Byte-pair encoding of whole texts by a lexicon of frequent words, and decoding.

The merges of a word do not depend on its neighbours, so a word's ids can be looked up. The words of the whole corpus are counted,
the most frequent ones encoded once and compiled into a minimal acyclic transducer, which every worker maps into memory. Words that
it lacks are merged one by one, exactly.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from tokenizers import Regex
from tokenizers.normalizers import Lowercase
from tokenizers.pre_tokenizers import Split

from isobar.llm.lexicon import build, opened, ragged, runs_of
from isobar.session import stage

#: Words of the lexicon, at most: bounds what is collected and sent to the workers.
LEXICON = 1 << 17
#: Different words a worker counts before it passes the counts on, and looks up before it forgets them.
HELD = 200_000
#: Characters of text handled at a time. Their words are Python strings, of some ten times the memory.
PIECE = 1 << 18
STEPS = 16


#: Characters asked about at a time; a list of all of them would take hundreds of megabytes.
ASKED = 1 << 13


def _characters() -> Iterator[str]:
    """All characters but U+0000, in strings of ``ASKED``."""
    for first, end in ((1, 0xD800), (0xE000, 0x110000)):
        for c in range(first, end, ASKED):
            yield "".join(map(chr, range(c, min(c + ASKED, end))))


@cache
def _lower_cases() -> dict[str, str]:
    """Where the library's lower case of a character is not Python's, which knows another Unicode version."""
    library, odd = Lowercase(), {}
    for some in _characters():
        lowered = library.normalize_str("\0".join(some)).split("\0")
        odd |= {c: low for c, low in zip(some, lowered, strict=True) if low != c.lower()}
    return odd


@cache
def _class(expression: str) -> str:
    """The characters that the tokenizers library's regular expressions count to ``expression``, as the inside of a character class.

    Asked of the library, since every regular-expression engine knows the letters of another Unicode version.
    """
    splitter, spans = Split(Regex(f"(?:{expression})+"), "removed", invert=True), []
    for some in _characters():
        for run, _ in splitter.pre_tokenize_str(some):
            if spans and spans[-1][1] + 1 == ord(run[0]):
                spans[-1][1] = ord(run[-1])
            else:
                spans.append([ord(run[0]), ord(run[-1])])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


def _byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else the next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def prepared(text: str) -> str:
    """The text of a tokenizer file together with the character tables, which take seconds to ask for, once on the driver."""
    tables = {"classes": {e: _class(e) for e in (r"\p{L}", r"\p{N}", r"\s")}, "lower": _lower_cases()}
    return json.dumps(json.loads(text) | {"tables": tables})


def _tokens(text: str) -> list[str]:
    """The tokens of a tokenizer file in the order of their ids, empty where an id has none."""
    spec = json.loads(text)
    tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [tokens.get(i, "") for i in range(max(tokens) + 1)]


class Vocabulary:
    """A word-end vocabulary read from a prepared tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.merged = [a + b for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.chars = _byte_characters()
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.classes, self.lower = spec["tables"]["classes"], spec["tables"]["lower"]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.odd = re.compile("[" + "".join(map(re.escape, self.lower)) + "]").search if self.lower else None
        # classes without the characters beyond U+FFFF are compiled into tables, which is several times faster
        self.split, self.split_basic, self.split_ascii = (self._finder(top) for top in (0x10FFFF, 0xFFFF, 0x7F))

    def _finder(self, top: int):
        pattern = self.pattern
        for name, inside in self.classes.items():
            low = [m for m in re.findall(r"\\U(.{8})-\\U(.{8})", inside) if int(m[0], 16) <= top]
            inside = "".join(f"\\U{a}-\\U{min(int(b, 16), top):08x}" for a, b in low)
            pattern = pattern.replace(f"[{name}]", f"[{inside}]").replace(name, inside)
        return re.compile(pattern).findall

    def words(self, text: str) -> list[str]:
        """The pieces that are merged on their own; a special token is a piece by itself."""
        if self.cut and any(t in text for t in self.special):
            parts = self.cut(text)
            return [w for part in parts for w in ([part] if part in self.special else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.split_ascii(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma
        if self.odd and self.odd(text):
            text = "".join(self.lower.get(c, c) for c in text)
        text = text.lower()
        return (self.split_basic if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else self.split)(text)

    def merge(self, word: str) -> list[int]:
        """The ids of one piece: of all neighbouring pairs the one of lowest rank is merged, the first of equals, until none is left."""
        if word in self.special:
            return [self.special[word]]
        chars, rank, none = self.chars, self.ranks.get, len(self.merged)
        parts = [chars[b] for b in word.encode()]
        parts[-1] += self.end
        if len(parts) > 48:
            return [self.ids[p] for p in self._merge_long(parts)]
        found = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            parts[i] = self.merged[best]
            del parts[i + 1], found[i]
            if i < len(found):
                found[i] = rank((parts[i], parts[i + 1]), none)
            if i:
                found[i - 1] = rank((parts[i - 1], parts[i]), none)
        return [self.ids[p] for p in parts]

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a heap, for pieces of many characters."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found, i, pair) for i, pair in enumerate(zip(parts, parts[1:])) if (found := self.ranks.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = pair[0] + pair[1], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if 0 <= a and b < n and (found := self.ranks.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (found, a, (parts[a], parts[b])))
        return [p for p in parts if p is not None]


@cache
def _vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


def _count(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    words, counts = _vocabulary(spec).words, Counter()

    def held() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column("text"):
            counts.update(words(text.as_py() or ""))
            if len(counts) > HELD:
                yield held()
                counts.clear()
    yield held()


def _merge(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    merge = _vocabulary(spec).merge
    for batch in batches:
        words = batch.column("word").to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(list(map(merge, words)), pa.list_(pa.int32()))], ["word", "ids"])


class _Coder:
    """Turns texts into ids. Words met before have a code; new ones are looked up in the lexicon, all of a piece at once."""

    def __init__(self, spec: str, lexicon: bytes):
        self.vocabulary, self.lexicon = _vocabulary(spec), opened(lexicon)
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.offsets, self.values = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def learn(self, new: list[str]) -> None:
        place = self.lexicon.find([w.encode() for w in new])
        known = place >= 0
        rows, at = ragged(place[known], self.lexicon.offsets, self.lexicon.values)
        merged = [self.vocabulary.merge(w) for w, k in zip(new, known.tolist(), strict=True) if not k]
        offsets, values = runs_of(merged, np.int32)
        begin = len(self.codes)
        order = [w for w, k in zip(new, known.tolist(), strict=True) if k] + [w for w, k in zip(new, known.tolist(), strict=True) if not k]
        self.codes.update(zip(order, range(begin, begin + len(order)), strict=True))
        size = self.offsets[-1]
        self.offsets = np.concatenate([self.offsets, size + at[1:], size + at[-1] + offsets[1:]])
        self.values = np.concatenate([self.values, rows.astype(np.int32), values])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin."""
        words = [self.vocabulary.words(t) for t in texts]
        if len(self.codes) > HELD:
            self.forget()
        new = set().union(*words).difference(self.codes)
        if new:
            self.learn(sorted(new))
        count = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.fromiter((c for ws in words for c in map(self.codes.__getitem__, ws)), np.int64, int(count.sum()))
        ids, at = ragged(codes, self.offsets, self.values)
        return ids, at[np.concatenate([[0], np.cumsum(count)])]


def _encode(batches: Iterator[pa.RecordBatch], spec: str, lexicon: bytes, field: int | None) -> Iterator[pa.RecordBatch]:
    """``field`` is the place of the text in the rows; without one it comes beside them."""
    coder = _Coder(spec, lexicon)
    for batch in batches:
        rows, row = batch.column("row"), 0
        texts = batch.column("bpe_text") if field is None else rows.field(field)
        while row < batch.num_rows:
            part, size = [], 0
            while row + len(part) < batch.num_rows and (not part or size < PIECE):
                part.append(texts[row + len(part)].as_py() or "")
                size += len(part[-1])
            ids, at = coder.encode(part)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([rows.slice(row, len(part)), lists], ["row", "bpe_ids"])
            row += len(part)


class WordBpe:
    """A tokenizer file and the lexicon of one corpus. The file is read on the driver; its path is a parameter."""

    def __init__(self, path: str, lexicon: bytes | None = None):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.spec, self.tokens = prepared(text), _tokens(text)
        self.lexicon = lexicon or build({})

    def fit(self, docs: DataFrame, text_column: str = "text", most: int = LEXICON) -> WordBpe:
        """Compile the most frequent words of all texts, ``most`` at the most.

        Counts are kept in the shared folder. How often a word must occur follows from a table of words per size class, so that
        only the chosen words, with their ids, come to the driver.
        """
        counted = docs.select(F.col(text_column).alias("text")).mapInArrow(partial(_count, spec=self.spec), "word string, n bigint")
        sized = F.floor(F.log2(F.sum("n")) * STEPS).cast("int")
        words = stage(counted.groupBy("word").agg(sized.alias("class")))
        room, least = most, None
        for found in words.groupBy("class").count().orderBy(F.desc("class")).collect():
            room -= found["count"]
            if room < 0:
                break
            least = found["class"]
        chosen = words.where(F.lit(False) if least is None else F.col("class") >= least).select("word")
        table = chosen.mapInArrow(partial(_merge, spec=self.spec), "word string, ids array<int>").toArrow()
        entries = zip(table["word"].to_pylist(), table["ids"].to_pylist(), strict=True)
        self.lexicon = build({word.encode(): ids for word, ids in entries})
        return self

    def encode(self, docs: DataFrame, text_column: str = "text") -> DataFrame:
        """``docs`` with their columns packed as ``row``, and ``bpe_ids``, the ids of the whole text.

        NULL and empty texts have no ids. The lexicon changes no result: words it lacks are merged as the tokenizer does.
        """
        field = docs.columns.index(text_column) if docs.columns.count(text_column) == 1 else None
        beside = [F.col(text_column).alias("bpe_text")] if field is None else []  # else the text goes to Python once, in its row
        rows = docs.select(F.struct(*docs.columns).alias("row"), *beside)
        schema = StructType([rows.schema["row"], StructField("bpe_ids", ArrayType(IntegerType()))])
        return rows.mapInArrow(partial(_encode, spec=self.spec, lexicon=self.lexicon, field=field), schema)

    def decode(self, encoded: DataFrame) -> DataFrame:
        """``encoded`` with ``bpe_decoded``, the tokens of the column ``bpe_ids`` joined by spaces; empty without ids.

        Ids are looked up in Spark, so that a task that encodes and decodes keeps one Python worker, not two. Ids that the
        vocabulary lacks are passed over, as the tokenizers library does.
        """
        tokens = F.split(F.lit("\0".join(self.tokens)), "\0")  # a constant of the plan, split once
        decoded = F.array_join(F.transform("bpe_ids", lambda i: F.get(tokens, i)), " ")
        return encoded.withColumn("bpe_decoded", F.coalesce(decoded, F.lit("")))
