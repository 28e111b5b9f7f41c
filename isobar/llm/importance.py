"""Quality by importance resampling.

Words and pairs of neighbouring words are hashed into buckets. Two generative models say how likely a bucket is in texts of the
target kind and in the whole corpus; the importance weight of a document is the product of the ratios over its n-grams. The k
documents with the largest log weight plus Gumbel noise are a sample without replacement in proportion to the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from isobar.llm.hashing import pieces, runs, sums
from isobar.session import stage

#: Buckets of the models, as a power of two. A task holds two counters per bucket.
BUCKET_BITS = 18
#: Labelled target documents the target model is fitted on, as a mean. All documents make up the corpus model.
TARGET_DOCS = 20_000
#: Count added to every bucket of either model.
SMOOTHING = 0.1
SEED = "sample"
#: Bins of one round of the search for the k-th largest key.
BINS = 4096


def _buckets(texts, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    shift = np.uint64(64 - bits)
    words, at = texts.words()
    pairs, pairs_at = runs(words, at, 2)
    return (words >> shift).astype(np.int32), at, (pairs >> shift).astype(np.int32), pairs_at


def _count(batches: Iterator[pa.RecordBatch], bits: int, targets: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The counts of one task: all of its texts, and those whose ids are targets."""
    size = 1 << bits
    raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        wanted = np.isin(ids, targets)
        for row, texts in pieces(batch.column("text")):
            chosen = wanted[row : row + texts.n]
            words, at, pairs, pairs_at = _buckets(texts, bits)
            for found, where in ((words, at), (pairs, pairs_at)):
                raw += np.bincount(found, minlength=size)
                if chosen.any():
                    target += np.bincount(found[np.repeat(chosen, np.diff(where))], minlength=size)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])


def _score(batches: Iterator[pa.RecordBatch], bits: int, ratios: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
        for row, texts in pieces(batch.column("text")):
            words, at, pairs, pairs_at = _buckets(texts, bits)
            part = slice(row, row + texts.n)
            n[part] = np.diff(at) + np.diff(pairs_at)
            weight[part] = sums(ratios[words], at) + sums(ratios[pairs], pairs_at)
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(n), pa.array(weight)], [*names, "n_grams", "log_weight"])


def targets_of(labels: DataFrame) -> DataFrame:
    """One row per labelled document: whether all its labels call it good and none toxic. A NULL toxic label counts as 0."""
    marked = labels.where("quality IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    return marked.agg((F.min("quality") == 1).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")).select(
        "doc_id", (F.col("good") & (F.col("toxic") == 0)).alias("target")
    )


def ratio_model(docs: DataFrame, target_ids: np.ndarray, bits: int, smoothing: float) -> np.ndarray:
    """The log ratio of each bucket, from one reading of all documents. Each task sends one row per bucket it met."""
    counted = docs.mapInArrow(partial(_count, bits=bits, targets=target_ids), "bucket int, raw bigint, target bigint")
    summed = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    raw[summed["bucket"].to_numpy()] = summed["raw"].to_numpy()
    target[summed["bucket"].to_numpy()] = summed["target"].to_numpy()
    if not target.any():
        return np.zeros(1 << bits)

    def logs(counts: np.ndarray) -> np.ndarray:
        return np.log((counts + smoothing) / (counts.sum() + smoothing * len(counts)))

    return logs(target) - logs(raw)


def threshold(keys: DataFrame, k: int) -> float:
    """The k-th largest of the column ``key``, from counts per bin that narrow round by round; no row is sorted or collected."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k <= 0:
        return float("inf")
    above = 0
    while True:
        inside = keys.where(F.col("key").between(low, high))
        place = F.least(F.floor((F.col("key") - low) / (high - low) * BINS), F.lit(BINS - 1)) if high > low else F.lit(0)
        bins = inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for found in sorted(bins.collect(), key=lambda b: -b["low"]):
            if above + found["n"] >= k:
                break
            above += found["n"]
        if found["low"] == found["high"] or above + found["n"] <= k:
            return found["low"]
        low, high = found["low"], found["high"]


def gumbel(seed: str, *parts: Column) -> Column:
    """Standard Gumbel noise that follows from the text of ``parts`` alone."""
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, 12), 16, 10).cast("double")
    return -F.log(-F.log((draw + 0.5) / float(1 << 48)))


class Resampler:
    """Importance weights of documents, fitted on one corpus."""

    def __init__(self, bits: int = BUCKET_BITS, target_docs: int = TARGET_DOCS, smoothing: float = SMOOTHING, seed: str = SEED, id_column: str = "doc_id", text_column: str = "text"):
        self.bits, self.target_docs, self.smoothing, self.seed = bits, target_docs, smoothing, seed
        self.id_column, self.text_column = id_column, text_column
        self.ratios, self.share = np.zeros(1 << bits), 1.0

    def _rows(self, docs: DataFrame, *more: Column) -> DataFrame:
        text = F.col(self.text_column)
        return docs.select(F.col(self.id_column).cast("bigint").alias("id"), F.substring(F.md5(text), 1, 16).alias("salt"), text.alias("text"), *more)

    def fit(self, docs: DataFrame, labels: DataFrame) -> Resampler:
        """Fit both models, and take the share of targets among labelled documents as the share to sample.

        The target model is fitted on about ``target_docs`` labelled documents, chosen by a hash of the id, whose ids are all that
        is collected besides the model; the corpus model counts all documents.
        """
        marked = stage(targets_of(labels))
        known, good = marked.agg(F.count(F.lit(1)), F.sum(F.col("target").cast("bigint"))).first()
        cut = int(2**32 * min(1.0, self.target_docs / max(good or 0, 1)))
        chosen = marked.where("target AND doc_id IS NOT NULL").where(F.pmod(F.xxhash64("doc_id"), F.lit(2**32)) < cut)
        target_ids = chosen.select("doc_id").toArrow()["doc_id"].to_numpy().astype(np.int64)
        self.ratios = ratio_model(self._rows(docs).select("id", "text"), target_ids, self.bits, self.smoothing)
        self.share = good / known if len(target_ids) else 1.0
        return self

    def weigh(self, docs: DataFrame, *more: Column) -> DataFrame:
        """id, salt, the columns ``more``, n_grams, log_weight and key of every document. A text is weighed by itself, so the result
        is the same however rows are dealt out."""
        rows = self._rows(docs, *more)
        schema = StructType([*rows.drop("text").schema, StructField("n_grams", LongType()), StructField("log_weight", DoubleType())])
        scored = rows.mapInArrow(partial(_score, bits=self.bits, ratios=self.ratios), schema)
        noise = gumbel(self.seed, F.col("id").cast("string"), F.col("salt"))
        return scored.withColumn("key", F.when(F.col("n_grams") > 0, F.col("log_weight") + noise))

    def sample(self, docs: DataFrame, share: float | None = None) -> tuple[DataFrame, float]:
        """The weighed documents with ``kept``, and the key from which on they are."""
        keys = stage(self.weigh(docs))
        least = threshold(keys, round((self.share if share is None else share) * keys.count()))
        return keys.withColumn("kept", F.coalesce(F.col("key") >= least, F.lit(False))), least


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, **parameters) -> DataFrame:
    """One row per document: id, salt (tells rows with the same id apart), n_grams, log_weight, key, and whether the sample keeps it.

    The sample holds ``share`` of the documents, by default the share of targets among the labelled ones; keys equal to the
    last one in are kept as well. Texts are read twice and never shuffled.

    Documents without words (NULL or empty texts) have no key and are not kept. Without a labelled target all weights are 1 and
    every document with words is kept. Rows equal in id and text get the same key. An empty table gives no rows. Other columns are not read.
    """
    return Resampler(**parameters).fit(docs, labels).sample(docs, share)[0]


def keep_sample(docs: DataFrame, labels: DataFrame, share: float | None = None, **parameters) -> DataFrame:
    """The rows of ``docs`` that the sample keeps, with all their columns. They are weighed once more instead of joined, so that no
    text is shuffled."""
    sampler = Resampler(**parameters).fit(docs, labels)
    _, least = sampler.sample(docs, share)
    return sampler.weigh(docs, F.struct(*docs.columns).alias("row")).where(F.col("key") >= least).select("row.*")
