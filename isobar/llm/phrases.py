"""Phrase collocations by Toivonen's way of mining: a sample proposes, a full pass counts, failures of the border make another pass count more.

A phrase is a run of up to ``LONGEST`` words inside a piece of text. Those that are frequent in a sample, at a lowered threshold, are put into a
bit filter of bounded size. The first full pass counts the phrases whose two parts one word shorter are in that filter, by their 64-bit hashes:
all words, the proposals, and their negative border as far as it occurs. The second pass spells and counts by their text the phrases found
frequent. If some of the border are among them, the sample has failed there: the pass then also counts every phrase that the
first one left out and whose parts are both frequent or themselves counted now. A frequent phrase has frequent parts, so after that pass, by induction
over the length, no frequent phrase is left out: it is closed. What the filters let through by mistake is counted as well, so their size and
collisions of hashes decide how much is counted and never what is found.

Words are lower-cased in A to Z and separated by spaces and tabs; the characters of ``BREAKS`` end a piece. A language that is NULL is ``und``, a
NULL text is empty; an empty table gives no phrase. Other columns are not read, and repeated rows count as often as they are there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from isobar.llm.common import empty_to
from isobar.llm.hashing import Texts, mixed
from isobar.llm.order import places
from isobar.session import stage

LONGEST = 5
#: Occurrences from which a phrase is a candidate.
FREQUENT = 100
#: Share of the documents in the sample, and the part of a phrase's expected count there that is enough to propose it.
SAMPLE = 1 / 16
SLACK = 1 / 2
SEED = 11
#: A candidate is dropped where a longer one around it has at least this share of its occurrences, in per cent.
ABSORBED = 100
TOP = 2000
#: The filter has 16 bits for each phrase, and at most 2 to this power (16 MB).
MOST_BITS = 27
#: Bytes of text looked at together; longer texts are cut between pieces.
BLOCK = 1 << 21

BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = np.isin(np.arange(256), list(BREAKS))
_GAP = _BREAK | np.isin(np.arange(256), list(b" \t"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_PLACE = np.random.default_rng(20240511).integers(1, 2**63, LONGEST + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND = np.uint64(0xD6E8FEB86659FD93)

SPELLED = "lang string, n int, phrase string, a bigint"


class Filter:
    """Which hashes are in a set, with false positives: two bits of a hash are set."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), np.uint64) if words is None else words

    def _probes(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for hashed in (keys, keys * _SECOND):
            place = hashed >> np.uint64(64 - self.bits)
            yield (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))

    def add(self, keys: np.ndarray) -> None:
        for word, bit in self._probes(keys):
            np.bitwise_or.at(self.words, word, bit)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for word, bit in self._probes(keys):
            found &= self.words[word] & bit > 0
        return found


class Block:
    """The words of some pieces: their hashes, the piece and text each is in, and their bytes with one space between neighbours."""

    def __init__(self, data: np.ndarray, texts: np.ndarray):
        """``texts`` are the places in ``data`` at which texts begin, the first at 0."""
        data = _LOWER[data]
        letter = ~_GAP[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = ~letter[:-1]
        edge[texts] = True
        starts = np.flatnonzero(letter & edge[:-1])
        edge[:-1] = ~letter
        edge[texts] = True
        self.lengths = np.flatnonzero(letter & edge[1:]) + 1 - starts
        marks = np.sort(np.concatenate([np.flatnonzero(_BREAK[data]), texts]))
        self.piece = np.searchsorted(marks, starts, side="right")
        self.text = np.searchsorted(texts, starts, side="right") - 1
        self.starts = np.cumsum(self.lengths + 1) - (self.lengths + 1)
        self.bytes = np.full(int((self.lengths + 1).sum()), 0x20, np.uint8)
        self.bytes[np.arange(int(self.lengths.sum())) + np.repeat(np.arange(len(starts)), self.lengths)] = data[letter]
        self.hashes = Texts(self.bytes, np.array([0, len(self.bytes)])).words()[0]

    def runs(self, seeds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For every length the words at which runs begin that lie in one piece, their hashes, and marks per word, all unset: the runs of the next
        length are those whose two parts have been marked. The marks of the parts themselves come last."""
        marks = np.ones(len(self.hashes), bool)
        at, joined = np.arange(len(self.hashes)), seeds[self.text] * _PLACE[LONGEST]
        for n in range(1, LONGEST + 1):
            if n > 1:
                at = at[: np.searchsorted(at, len(self.hashes) - n + 1)]
                going = marks[at] & marks[at + 1] & (self.piece[at] == self.piece[at + n - 1])
                at, joined = at[going], joined[: len(going)][going]
            if not len(at):
                return
            joined = joined + self.hashes[at + n - 1] * _PLACE[n - 1]
            marks = np.zeros(len(self.hashes), bool)
            yield n, at, mixed(joined), marks

    def spelled(self, first: np.ndarray, n: int) -> pa.Array:
        """The runs of ``n`` words from the words ``first`` on, with single spaces."""
        last = first + n - 1
        lengths = self.starts[last] + self.lengths[last] - self.starts[first]
        ends = np.cumsum(lengths)
        data = self.bytes[np.arange(int(ends[-1])) + np.repeat(self.starts[first] - (ends - lengths), lengths)]
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[tuple[Block, list[str], np.ndarray]]:
    """Blocks of some ``size`` bytes, cut between pieces, with the languages at hand and the language of each text."""
    for batch in batches:
        column = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        langs = batch.column("lang").dictionary_encode()
        names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        row = 0
        while row < len(column):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
            some, texts = data[offsets[row] : offsets[end]], offsets[row:end] - offsets[row]
            if end > row + 1 or len(some) <= size:
                yield Block(some, texts), names, codes[row:end]
            else:
                for part in _cut(some, size):
                    yield Block(part, texts), names, codes[row:end]
            row = end


def _cut(text: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """A long text in parts of about ``size`` bytes that end where a piece ends; a piece that is longer stays whole."""
    ends = np.append(np.flatnonzero(_BREAK[text]) + 1, len(text))
    at = 0
    while at < len(text):
        end = int(ends[max(np.searchsorted(ends, at + size, side="right") - 1, np.searchsorted(ends, at, side="right"))])
        yield text[at:end]
        at = end


def _seeds(names: list[str], codes: np.ndarray) -> np.ndarray:
    """A number for the language of each text, the same everywhere."""
    hashed = [Texts(np.frombuffer(b"." + n.encode().replace(b" ", b"_"), np.uint8), np.array([0, 1 + len(n.encode())])).words()[0][0] for n in names]
    return np.array(hashed, np.uint64)[codes] if hashed else np.zeros(0, np.uint64)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different key is first met, and how often it is there."""
    number = pa.array(keys).dictionary_encode().indices.to_numpy()
    highest = np.maximum.accumulate(number)
    return np.flatnonzero(np.concatenate([[True], highest[1:] > highest[:-1]])[: len(number)]), np.bincount(number)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all phrases that can be a part of another one, and their counts in a block."""
    for block, names, codes in blocks(batches):
        for n, at, keys, marks in block.runs(_seeds(names, codes)):
            if n < LONGEST:
                marks[at] = True
                first, count = _grouped(keys)
                yield pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(count)], ["key", "a"])


def _hashed(batches: Iterator[pa.RecordBatch], proposed) -> Iterator[pa.RecordBatch]:
    """Hashes and counts of the phrases whose parts are proposed, and whether they can only be failures of the border: parts, not proposed."""
    wanted = proposed.value
    for block, names, codes in blocks(batches):
        for n, at, keys, marks in block.runs(_seeds(names, codes)):
            first, count = _grouped(keys)
            alike = wanted.has(keys) if n < LONGEST else np.ones(len(keys), bool)
            marks[at] = alike
            yield pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(~alike[first]), pa.array(count)], ["key", "failed", "a"])


def _spelled(batches: Iterator[pa.RecordBatch], proposed, frequent, failed: bool) -> Iterator[pa.RecordBatch]:
    """The frequent phrases of the first pass; if that one ``failed``, also what it left out and may be frequent. An empty phrase has the words' number."""
    before, found = proposed.value, frequent.value

    def rows(names, langs, n, phrases, count):
        lang = pa.DictionaryArray.from_arrays(pa.array(langs, pa.int32()), pa.array(names, pa.string())).cast(pa.string())
        return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(langs), n, np.int32)), phrases, pa.array(count)], ["lang", "n", "phrase", "a"])

    for block, names, codes in blocks(batches):
        words = np.bincount(codes[block.text], minlength=len(names))
        used = np.flatnonzero(words)
        yield rows(names, used, 0, pa.array([""] * len(used), pa.string()), words[used])
        parts_proposed = None
        for n, at, keys, marks in block.runs(_seeds(names, codes)):
            counted = np.ones(len(at), bool) if parts_proposed is None else parts_proposed[at] & parts_proposed[at + 1]
            wanted = counted & found.has(keys)
            if failed:
                wanted |= ~counted
                parts_proposed = np.zeros(len(marks), bool)
                parts_proposed[at] = counted & before.has(keys)
            at, keys = at[wanted], keys[wanted]
            marks[at] = True
            if len(at):
                first, count = _grouped(keys)
                yield rows(names, codes[block.text[at[first]]], n, block.spelled(at[first], n), count)


def _bits(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    held = Filter(bits)
    for batch in batches:
        held.add(batch.column("key").to_numpy().view(np.uint64))
    used = np.flatnonzero(held.words)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held.words[used].view(np.int64))], ["word", "bits"])


def _filter(keys: DataFrame, most_bits: int) -> Filter:
    """A filter of the column ``key``; only its words, of bounded number, reach the driver."""
    bits = min(max(16, math.ceil(math.log2(16 * (1 + keys.count())))), most_bits)
    words = keys.select("key").mapInArrow(partial(_bits, bits=bits), "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    made = Filter(bits)
    made.words[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return made


def frequent_phrases(docs: DataFrame, frequent: int = FREQUENT, sample: float = SAMPLE, most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """(lang, n, phrase, a) of every phrase of up to ``LONGEST`` words with ``a >= frequent`` occurrences, and of an empty phrase with n = 0 whose a
    is the number of all words; and how many hashes of the border turned out frequent."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(empty_to(F.col("lang").cast("string"), "und").alias("lang"), F.col("text").cast("string").alias("text"))
    enough = max(1, math.floor(frequent * sample * SLACK))
    sampled = rows.sample(sample, seed=SEED).mapInArrow(_sampled, "key bigint, a bigint").groupBy("key").agg(F.sum("a").alias("a"))
    proposed = context.broadcast(_filter(stage(sampled.where(F.col("a") >= enough)), most_bits))
    hashed = rows.mapInArrow(partial(_hashed, proposed=proposed), "key bigint, failed boolean, a bigint")
    met = stage(hashed.groupBy("key").agg(F.sum("a").alias("a"), F.max("failed").alias("failed")).where(F.col("a") >= frequent))
    failures = met.where("failed").count()
    found = context.broadcast(_filter(met, most_bits))
    spelled = rows.mapInArrow(partial(_spelled, proposed=proposed, frequent=found, failed=failures > 0), SPELLED)
    summed = spelled.groupBy("lang", "n", "phrase").agg(F.sum("a").alias("a"))
    return stage(summed.where((F.col("a") >= frequent) | (F.col("n") == 0))), failures


def scored(found: DataFrame, absorbed: int = ABSORBED) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one around them absorbs."""
    totals = found.where("n = 0").select("lang", F.col("a").alias("total"))
    parts = found.where("n > 0").select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("a").alias("f"))
    words = found.where("n > 1").withColumn("words", F.split("phrase", " "))
    cuts = words.join(totals, "lang").select("*", F.explode(F.expr("sequence(1, n - 1)")).alias("k"))
    cut = cuts.withColumn("left_part", F.array_join(F.expr("slice(words, 1, k)"), " ")).withColumn("right_part", F.array_join(F.expr("slice(words, k + 1, n - k)"), " "))
    left = parts.select(F.col("of").alias("lang"), F.col("part").alias("left_part"), F.col("f").alias("l"))
    right = parts.select(F.col("of").alias("lang"), F.col("part").alias("right_part"), F.col("f").alias("r"))
    wide = {c: f"CAST({c} AS DECIMAL(19, 0))" for c in ("a", "total", "l", "r")}
    score = F.expr(f"({wide['a']} * {wide['total']} * 1000) div ({wide['l']} * {wide['r']})")
    rated = cut.join(left, ["lang", "left_part"]).join(right, ["lang", "right_part"]).withColumn("score", score)
    best = rated.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inner = words.select("lang", "a", "words", "n", F.explode(F.expr("sequence(2, n - 1)")).alias("m")).where("n > 2")
    inside = inner.select("lang", "a", F.explode(F.expr("transform(sequence(1, n - m + 1), i -> array_join(slice(words, i, m), ' '))")).alias("phrase"))
    around = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(around, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {absorbed} * a")
    return kept.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def collocations(docs: DataFrame, frequent: int = FREQUENT, top: int = TOP, sample: float = SAMPLE, most_bits: int = MOST_BITS) -> DataFrame:
    """The first ``top`` phrases of each language by score, occurrences and text: lang, rank, phrase, a, l, r, n, score."""
    found, _ = frequent_phrases(docs, frequent, sample, most_bits)
    ranked = places(scored(found), ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()], "place")
    return ranked.where(F.col("place") < top).select("lang", (F.col("place") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
