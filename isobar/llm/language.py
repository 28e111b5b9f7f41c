"""Language of whole texts by character models.

One interpolated Kneser-Ney model per language; a text gets the language whose model has the lowest cross-entropy per character. How
often that is right at a given lead over the second is read off documents that no model has seen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from isobar.llm.charmodel import PIECE, Alphabet, Tables, count_task, fitted, letters_only
from isobar.llm.hashing import pieces
from isobar.session import stage

UNKNOWN = "und"
FOLDS = 5
#: Fold 0 is held out, fold 1 calibrates, the others train.
CALIBRATION_FOLD = 1
#: Leads are sorted into bins of this many nats per character.
LEAD_STEP = 0.02
LEAD_BINS = 100
#: A prediction that is right less often than this is marked as rejected.
REJECT = 0.5


def _score(batches: Iterator[pa.RecordBatch], model: Tables, languages: Sequence[str]) -> Iterator[pa.RecordBatch]:
    alphabet = Alphabet(letters_only)
    names = np.array([*languages, None], object)
    for batch in batches:
        best, lead = np.full(batch.num_rows, len(languages)), np.zeros(batch.num_rows)
        for row, texts in pieces(batch.column("text"), PIECE):
            n, entropy = model.entropies(texts, alphabet)
            found = np.flatnonzero(n > 0)
            if len(languages) and len(found):
                order = np.argsort(entropy[found], axis=1, kind="stable")
                best[row + found] = order[:, 0]
                if len(languages) > 1:
                    both = np.take_along_axis(entropy[found], order[:, :2], axis=1)
                    lead[row + found] = both[:, 1] - both[:, 0]
                else:
                    lead[row + found] = LEAD_STEP * LEAD_BINS
        others = [batch.column(c) for c in batch.schema.names if c != "text"]
        names_of = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*others, pa.array(names[best], pa.string()), pa.array(lead)], [*names_of, "best", "lead"])


def fold_of(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(FOLDS)).cast("int")


def rising(right: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Shares that never fall with the bin: neighbouring bins that would fall are pooled. Every bin starts with one right in two."""
    pools: list[list[float]] = []
    for r, m in zip(right + 1.0, n + 2.0, strict=True):
        pools.append([r, m, 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] > pools[-1][0] / pools[-1][1]:
            r2, m2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + r2, pools[-1][1] + m2, pools[-1][2] + k2]
    return np.concatenate([np.full(int(k), r / m) for r, m, k in pools])


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, lead, rejected.

    Models count the characters of all documents with a language and an id in the training folds, and keep all grams; the id only
    decides the fold. The score is the share of calibration documents with such a lead whose prediction is right, made to rise with
    the lead; a score below REJECT marks the prediction as rejected.

    A text without a letter (NULL and empty ones too) is ``und`` with score 0, as is every text where there is nothing to learn from. A NULL id
    counts as held out. Equal cross-entropies go to the language first by code point. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), fold_of(F.col(id_column)).alias("fold"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("label")
    )
    training = rows.where((F.col("fold") != 0) & (F.col("fold") != CALIBRATION_FOLD) & F.col("label").isNotNull())
    languages = sorted(r["label"] for r in training.select("label").distinct().collect())
    model = fitted(training.select("label", "text"), partial(count_task, classes=languages, rule=letters_only), len(languages))
    kept = rows.drop("text").schema
    scored = stage(rows.mapInArrow(partial(_score, model=model, languages=languages), schema_of(kept, "best string, lead double")))

    place = F.least(F.floor(F.col("lead") / LEAD_STEP), F.lit(LEAD_BINS - 1)).cast("int")
    tested = scored.where((F.col("fold") == CALIBRATION_FOLD) & F.col("best").isNotNull() & F.col("label").isNotNull())
    right, seen = np.zeros(LEAD_BINS), np.zeros(LEAD_BINS)
    for b in tested.groupBy(place.alias("bin")).agg(F.sum((F.col("best") == F.col("label")).cast("int")).alias("r"), F.count(F.lit(1)).alias("n")).collect():
        right[b["bin"]], seen[b["bin"]] = b["r"], b["n"]
    shares = F.array(*[F.lit(float(x)) for x in rising(right, seen)])
    score = F.when(F.col("best").isNull(), 0.0).otherwise(F.element_at(shares, place + 1))
    return scored.select(
        "doc_id",
        F.coalesce(F.col("fold") == 0, F.lit(True)).alias("held_out"),
        F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"),
        score.alias("score"),
        "lead",
        (score < REJECT).alias("rejected"),
    )


def schema_of(kept, more: str) -> str:
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), more])
