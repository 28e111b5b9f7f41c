"""Token ids of a corpus in files of directly addressable codes.

``write_tokens`` range-partitions the documents by id, encodes each partition where it lies and writes it as segments: rows of a Parquet
table whose column ``codes`` holds the ids as ``dac.encode`` lays them out. Spark's committer makes the files appear whole or not at all,
on any storage that Spark can write to. A segment holds whole documents and is closed at ``SEGMENT`` ids.

Order: NULL ids first, then ascending; documents of one id by a hash of their text, so that equal ids spread over partitions. Rows equal in
id and text are interchangeable. A NULL text is empty and leaves the end id alone; an empty table leaves a table without segments. Other
columns are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from isobar.llm import dac

#: Ids at which a segment is closed.
SEGMENT = 1 << 18
#: The splitting rule that the ByteLevel step of the tokenizers library applies, fixed by its format, with possessive runs: they cut alike, but no
#: run of letters is tried again in parts.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Characters next to which a character of either class would be split or merged differently.
_CONTEXTS = ("a{0}a {0}a  {0}  {0}a", "1{0}1 {0}1{0}{0}", "!{0}! {0}!  {0}\n{0} \n{0}", "'{0}s {0}'s\t{0}\t{0}  ")

SEGMENTS = "part int, segment int, start bigint, n_ids bigint, doc_ids array<bigint>, ends array<bigint>, codes binary"


def _byte_of() -> dict[str, int]:
    """The byte for which each character of a byte-level vocabulary stands: itself where it is printable, else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Encodes as the tokenizers library does with a file of its byte-level BPE.

    Merges run in tiktoken, four times as fast, where the file's merges are in the order of its ids. The two libraries know
    different versions of Unicode, so every character that is not ASCII is first encoded in some contexts by both. Texts with a character on
    which they differ, and texts that spell a special token, are left to the tokenizers library.
    """

    def __init__(self, text: str):
        self.library = Tokenizer.from_str(text)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(text)
        self.fast = self._fast(spec)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.agreed, self.odd = set(map(chr, range(128))), set()

    @staticmethod
    def _fast(spec: dict) -> tiktoken.Encoding | None:
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if model.get("type") != "BPE" or not plain or spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
            return None
        byte_of, special = _byte_of(), {t["content"] for t in spec.get("added_tokens") or []}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ids = [model["vocab"].get(m, -1) for m in merged]
        ranks = {bytes(byte_of[c] for c in word): rank for word, rank in model["vocab"].items() if word not in special}
        single = [ranks.get(bytes([b]), 1 << 40) for b in range(256)]
        if ids != sorted(set(ids)) or max(single) > min(ids, default=0) or len(ranks) != 256 + len(ids):
            return None
        return tiktoken.Encoding("files", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _agree(self, text: str) -> bool:
        if text.isascii():
            return True
        for c in set(text) - self.agreed - self.odd:
            same = all(self.library.encode(p, add_special_tokens=False).ids == self.fast.encode_ordinary(p) for p in (x.format(c) for x in _CONTEXTS))
            (self.agreed if same else self.odd).add(c)
        return not self.odd or self.odd.isdisjoint(text)

    def encode(self, text: str) -> np.ndarray:
        if self.fast and not any(s in text for s in self.special) and self._agree(text):
            return self.fast.encode_to_numpy(text)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def _coder(text: str) -> ByteBpe:
    """Kept by a worker for its next tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ByteBpe(text)


def _segments(batches: Iterator[pa.RecordBatch], spec, end_id: int, size: int) -> Iterator[pa.RecordBatch]:
    """The segments of one partition, in the order of its rows."""
    coder, part = _coder(spec.value), TaskContext.get().partitionId()
    held, ids, segment, start, n = [], [], 0, 0, 0

    def closed() -> pa.RecordBatch:
        ends = np.cumsum([len(x) for x in held])
        row = [[part], [segment], [start], [int(ends[-1])], [ids], [ends.tolist()], [dac.encode(np.concatenate(held))]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "segment", "start", "n_ids", "doc_ids", "ends", "codes"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            held.append(np.append(coder.encode(text.as_py() or ""), np.uint32(end_id)))
            ids.append(doc_id)
            n += len(held[-1])
            if n >= size:
                yield closed()
                held, ids, segment, start, n = [], [], segment + 1, start + n, 0
    if held:
        yield closed()


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            data = dac.Codes(row["codes"]).run(0, row["n_ids"]).astype("<u4").tobytes()
            ends = np.array(row["ends"], np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + starts), pa.array(ends - starts), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            places = np.array(row["places"], np.int64)
            found = dac.Codes(row["codes"]).get(places - row["start"])
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(found.astype(np.int64))], ["position", "token_id"])


class TokenFiles:
    """The segments in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _placed(self, *columns: str) -> DataFrame:
        """Segments with ``start`` counted over the whole corpus. One row per written partition is added up in one task."""
        stored = self.spark.read.schema(SEGMENTS).parquet(self.path)
        sizes = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        parts = sizes.select("part", before.alias("before"))
        # as many rows as the write had partitions
        return stored.join(F.broadcast(parts), "part").select("part", "segment", (F.col("before") + F.col("start")).alias("start"), "n_ids", *columns)

    def documents(self) -> DataFrame:
        """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of the ids as little-endian 4-byte integers; all from the files."""
        placed = self._placed("doc_ids", "ends", "codes").select("start", "n_ids", "doc_ids", "ends", "codes")
        return placed.mapInArrow(_documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

    def tokens_at(self, positions: DataFrame, size: int = SEGMENT) -> DataFrame:
        """(position, token_id) of the wanted positions of the corpus, each once; those outside it are left out.

        Only the ranks above an id are looked at. Positions meet segments on bins of ``size`` ids; a segment gets its positions as a
        set, which cannot be larger than the segment.
        """
        bins = F.sequence(F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("n_ids") - 1) / size))
        segments = self._placed().select("part", "segment", "start", "n_ids", F.explode(bins).alias("bin"))
        wanted = positions.select(F.col(positions.columns[0]).cast("bigint").alias("position"))
        met = wanted.withColumn("bin", F.floor(F.col("position") / size)).join(segments, "bin")
        inside = met.where("position >= start AND position < start + n_ids")
        places = inside.groupBy("part", "segment", "start").agg(F.collect_set("position").alias("places"))
        codes = self.spark.read.schema(SEGMENTS).parquet(self.path).select("part", "segment", "codes")
        return places.join(codes, ["part", "segment"]).select("start", "places", "codes").mapInArrow(_picked, "position bigint, token_id bigint")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, size: int = SEGMENT) -> TokenFiles:
    """Write ``docs`` (doc_id, text) to the folder ``path`` and return its reader; ``end_id`` follows every document."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("salt"), F.monotonically_increasing_id().alias("turn"))
    order = (F.col("doc_id").asc_nulls_first(), "salt", "turn")
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(partial(_segments, spec=spec, end_id=end_id, size=size), SEGMENTS).write.mode("overwrite").parquet(path)
    return TokenFiles(spark, path)
