"""From raw documents to token ids: quality sample, line dedup, near duplicates, mixing, encoding.

Each stage takes (spark, docs, table folder) and returns the documents it leaves, with their columns; the last one returns ids. Between
stages documents are written as Parquet. A column n_chars follows the text where lines are removed.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from isobar.llm import bpe, importance, jaccard, line_dedup, mixing
from isobar.llm.common import table
from isobar.session import configure, stage

TOKENIZER = Path(public_tokenizers.path("word_bpe_49k.json"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample keeps; documents without words go."""
    return importance.keep_sample(docs, table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that an earlier document has; a document of which nothing is left goes."""
    cut = line_dedup.dedup_lines(docs).where((F.col("n_removed") < F.col("n_lines")) | F.col("row.text").isNull())
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return cut.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, the one with the smallest id. Rows equal in id and text are one document."""
    found = jaccard.near_duplicates(docs)
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.md5("text").alias("salt"))
    joined = rows.join(stays, F.col("id").eqNullSafe(F.col("kept_id")), "left_semi")
    turn = F.row_number().over(Window.partitionBy("id", "salt").orderBy("id", "salt"))
    return joined.withColumn("turn", turn).where("turn = 1").select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the whole text, and the text that they decode to."""
    tokenizer = bpe.WordBpe(str(TOKENIZER)).fit(docs)
    coded = tokenizer.decode(tokenizer.encode(docs).select("row.doc_id", "row.lang", "row.source", "bpe_ids"))
    return coded.select("doc_id", "lang", "source", F.size("bpe_ids").cast("bigint").alias("n_tokens"), F.col("bpe_ids").alias("ids"), F.col("bpe_decoded").alias("decoded"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", encode),
]

#: Hashes, sampled models and merges are beyond SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(configure(spark), sf_dir, "documents")
    for _, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir))
    return docs
