"""URL filter: rules for hosts and paths, and for all other URLs the ratio of two character models.

The URLs that rules allow and those they block train one variable-order Markov model each: the longest context that was seen often
enough says how likely the next character is, smoothed by shorter ones. A URL passes if its mean log-likelihood under the first
model exceeds that under the second by a threshold, set on URLs that no model has seen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from isobar.llm.charmodel import PIECE, Alphabet, Tables, any_character, count_task, fitted
from isobar.llm.hashing import pieces
from isobar.llm.importance import threshold
from isobar.session import stage

VERDICTS = ("allow", "block")
FOLDS = 5
#: A context counts from this many occurrences on.
LEAST_CONTEXT = 4
#: The threshold is half-way between the values that this share of the allowed URLs, and of the blocked ones, is above and below.
SIDE = 0.95


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_: Column, path_: Column, rules: Sequence[tuple[str, str]], value: int) -> Column:
    """Item ``value`` of the longest rule (text, verdict) that fits, or NULL. A rule's text is a host and the begin of a path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0])):
        at, slash, below = rule[0].partition("/")
        fits = ((host_ == at) | F.endswith(host_, F.lit(f".{at}"))) & F.startswith(path_, F.lit(slash + below))
        found = F.when(fits, rule[value]).otherwise(found)
    return found


def _differences(batches: Iterator[pa.RecordBatch], model: Tables) -> Iterator[pa.RecordBatch]:
    alphabet = Alphabet(any_character)
    for batch in batches:
        difference, known = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
        for row, texts in pieces(batch.column("text"), PIECE):
            n, entropy = model.entropies(texts, alphabet)
            part = slice(row, row + texts.n)
            known[part], difference[part] = n > 0, entropy[:, 1] - entropy[:, 0]
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(difference, mask=~known)], [*names, "difference"])


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_column: str = "page_id",
    url_column: str = "url",
    least_context: int = LEAST_CONTEXT,
    side: float = SIDE,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, difference (mean log-likelihood, allowed less blocked).

    ``rules`` are (text, ``allow`` or ``block``). The models count all URLs under a rule but a fifth, by a hash of the URL, on which the
    threshold is set: half-way between the value that a share ``side`` of the allowed ones reaches and the one that as large a share of
    the blocked ones stays below. A URL under a rule gets the rule's verdict.

    A NULL or empty URL has empty host and path and no difference; it is blocked, as nothing speaks for it. Without allowed or without
    blocked URLs there is no ratio, and every other URL passes. Repeated rows are judged alike. An empty table gives no rows. Other
    columns are not read.
    """
    url = F.col(url_column).cast("string")
    rows = pages.select(F.col(id_column).alias("page_id"), url.alias("text"), host(url).alias("host"), path(url).alias("path"))
    judged = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules, 0))
    judged = judged.withColumn("label", rule_of(F.col("host"), F.col("path"), rules, 1))
    judged = judged.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)))
    training = judged.where("label IS NOT NULL AND fold <> 0").select("label", "text")
    model = fitted(training, partial(count_task, classes=VERDICTS, rule=any_character), len(VERDICTS), least_context)
    both = model.seen == len(VERDICTS)
    schema = "page_id {}, host string, path string, rule string, label string, fold bigint, difference double".format(dict(judged.dtypes)["page_id"])
    scored = stage(judged.mapInArrow(partial(_differences, model=model), schema))

    def reached_by(label: str, share: float) -> float | None:
        """The difference that this share of the calibration URLs of one verdict reaches."""
        keys = scored.where((F.col("label") == label) & (F.col("fold") == 0) & F.col("difference").isNotNull()).select(F.col("difference").alias("key"))
        n = keys.count()
        return threshold(keys, max(round(n * share), 1)) if n else None

    high, low = (reached_by("allow", side), reached_by("block", 1 - side)) if both else (None, None)
    sides = [x for x in (high, low) if x is not None]
    least = sum(sides) / len(sides) if sides else float("-inf")
    passes = F.col("difference") >= least
    verdict = F.when(F.col("label").isNotNull(), F.col("label")).when(passes, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "difference")
