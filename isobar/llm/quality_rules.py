"""Quality rules per document, and a verdict on the host from the rules its documents fail.

A host's share of failing documents is noisy where it has few of them. The shares of all hosts say how alike hosts are: a beta
distribution is fitted to them by moments, and each host's share is pulled toward the common mean with its weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isobar.llm.common import SPACES, let, trimmed, words
from isobar.session import stage

SYMBOLS = "#*$%&|<>"
RUN = 5
FEW_WORDS = 10
REPEATED_PERCENT = 20
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30
#: A host is refused when this share of its documents is expected to fail a rule.
HOST_LIMIT = 0.5


def length_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def repeated_words(ws: Column, run: int = RUN) -> Column:
    """Words inside runs of ``run`` words that occur twice or more; runs are compared by a 64-bit hash of their words' hashes.

    Most texts repeat no run, which a set of the hashes tells; only for the others are runs sorted, those with an equal neighbour
    put back in order, and the words they cover counted.
    """

    def grams(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - (run - 1))
        return F.transform(starts, lambda i: F.xxhash64(*[F.element_at(h, i + k) for k in range(run)]))

    def covered(g: Column) -> Column:
        placed = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))

        def twice(s: Column) -> Column:
            def alike(x: Column, i: Column) -> Column:
                return (F.get(s, i - 1)["g"] == x["g"]) | (F.get(s, i + 1)["g"] == x["g"])

            hits = F.filter(s, lambda x, i: F.coalesce(alike(x, i), F.lit(False)))
            return F.array_sort(F.transform(hits, lambda x: x["i"]))

        def cover(p: Column) -> Column:
            first = F.struct(F.lit(-run).alias("last"), F.lit(0).alias("n"))
            done = F.aggregate(p, first, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(x - a["last"], F.lit(run))).alias("n")))
            return done["n"]

        return let(let(placed, twice), cover)

    def count(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(0)

    hashed = F.transform(ws, lambda w: F.xxhash64(w))
    return F.when(F.size(ws) > run, let(let(hashed, grams), count)).otherwise(0)


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source") -> DataFrame:
    """One row per document with what the rules are about."""
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(host_column).cast("string").alias("host"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("body"),
    )
    lines = F.filter(F.split("body", "\n"), lambda line: trimmed(line) != "")

    def of_words(ws: Column) -> Column:
        return F.struct(F.size(ws).cast("bigint").alias("n_words"), repeated_words(ws).cast("bigint").alias("n_repeat_words"))

    measured = rows.select(
        "doc_id",
        "host",
        let(words(F.col("body")), of_words).alias("of_words"),
        length_without(F.col("body"), SPACES).cast("bigint").alias("word_chars"),
        (F.length("body") - length_without(F.col("body"), SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        F.size(F.split("body", "\n")).alias("n_lines"),
    )
    return measured.select("doc_id", "host", "of_words.*", "word_chars", "n_symbols", "n_dup_lines", "n_lines")


def verdicts(measured: DataFrame, few: int = FEW_WORDS, repeated: int = REPEATED_PERCENT) -> DataFrame:
    """``measured`` with base_failed (too few words or too many in repeated runs) and failed (any rule)."""
    base = (F.col("n_words") < few) | (100 * F.col("n_repeat_words") > repeated * F.col("n_words"))
    symbols = 100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words")
    lines = 100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * F.col("n_lines")
    return measured.withColumn("base_failed", base).withColumn("failed", base | symbols | lines)


def host_rates(judged: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: documents, failures, shrunk rate, and whether it is refused.

    The strength of the prior follows from how much hosts differ beyond chance (moments of the beta-binomial). Hosts that differ no
    more than chance all get the common rate.
    """
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("bigint")).alias("f"))
    totals = hosts.agg(
        F.sum("n").alias("docs"),
        (F.sum("f") / F.sum("n")).alias("mean"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        F.sum(F.col("f").cast("double") * F.col("f") / F.col("n")).alias("spread"),
        F.count(F.lit(1)).alias("hosts"),
    )
    chance = F.col("mean") * (1 - F.col("mean"))
    between = F.col("spread") - F.col("docs") * F.col("mean") * F.col("mean") - (F.col("hosts") - 1) * chance
    scale = (F.col("docs") - F.col("squares") / F.col("docs")) * chance
    alike = F.when(scale > 0, F.least(F.greatest(between / scale, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    prior = totals.select("mean", alike.alias("alike"))
    # with strength 1/alike - 1 the weight of the host's own share is n / (n + strength)
    own = F.col("n") * F.col("alike") / (F.col("n") * F.col("alike") + 1 - F.col("alike"))
    rate = F.when(F.col("alike") > 0, own * F.col("f") / F.col("n") + (1 - own) * F.col("mean")).otherwise(F.col("mean"))
    rated = hosts.crossJoin(F.broadcast(prior)).select("host", "n", "f", rate.alias("rate"))
    return rated.withColumn("refused", F.col("rate") > limit)


def judge(docs: DataFrame, limit: float = HOST_LIMIT, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source") -> DataFrame:
    """One row per document: its measures, base_failed, its host with host_rate and host_refused, and kept.

    A document is kept unless it fails a base rule or its host is refused. The texts are read once: the measures are written to the
    shared folder, counted per host (a host with very many documents is counted in every task first) and joined with the
    verdict on the host, which is small or else a join that adaptive execution splits.

    A NULL or empty text has no words and fails. A NULL host is a host of its own. Repeated rows count each. An empty table gives
    no rows. Other columns are not read.
    """
    measured = stage(verdicts(measures(docs, id_column, text_column, host_column)))
    hosts = stage(host_rates(measured, limit)).select(F.col("host").alias("of"), F.col("rate").alias("host_rate"), F.col("refused").alias("host_refused"))
    joined = measured.join(hosts, F.col("host").eqNullSafe(F.col("of")), "left").drop("of")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_refused"))
