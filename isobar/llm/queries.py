"""The operators as queries over the driver's tables: (session, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from isobar.llm import bpe, importance, jaccard, language, line_dedup, merkle, mixing, phrases, quality_rules, sharding, token_files, urls, vectors
from isobar.llm.common import table
from isobar.session import configure, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
QUERY_EVERY = 100
URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = lambda spark, sf_dir: build(configure(spark), sf_dir)
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op1_importance(spark, sf_dir):
    sample = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return sample.select(F.col("id").alias("doc_id"), "n_grams", "log_weight", F.col("key").alias("sample_key"), "kept")


@query
def op2_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_url_filter(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op4_sharding(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)


@query
def op5_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken, "copies")


@query
def op6_line_dedup(spark, sf_dir):
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "n_lines", "n_removed", F.col("kept_text").alias("text"))


@query
def op6_line_runs(spark, sf_dir):
    cut = line_dedup.dedup_runs(table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "n_lines", "n_removed", F.col("kept_text").alias("text"))


@query
def op7_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(*base, "host_refused", F.floor(F.col("host_rate") * 1_000_000 + 0.5).cast("bigint").alias("host_rate_ppm"))


@query
def op8_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokenizer = bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json")).fit(docs)
    coded = tokenizer.decode(tokenizer.encode(docs).select("row.doc_id", "bpe_ids"))
    return coded.select(
        "doc_id",
        F.size("bpe_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("bpe_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("bpe_decoded"), 256).alias("decoded_sha256"),
    )


@query
def op9_neighbours(spark, sf_dir):
    return vectors.neighbours(table(spark, sf_dir, "embeddings"), QUERY_EVERY)


@query
def op10_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op11_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op12_merkle(spark, sf_dir):
    proofs = merkle.Manifest(table(spark, sf_dir, "documents")).proofs()
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op13_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_files.write_tokens(docs, shared_folder(spark), public_tokenizers.path("byte_bpe_50k.json")).documents()
