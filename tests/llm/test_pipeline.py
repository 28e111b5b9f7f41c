"""The pipeline's stages against plain versions, each on what the stage before left."""

from __future__ import annotations

from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from isobar.llm import importance, line_dedup, mixing
from isobar.llm.common import table
from isobar.session import stage
from tests.llm import brute, frames
from tests.llm.tables import documents, folder


@pytest.fixture(scope="module")
def stages(spark):
    """The input of the first stage and the output of each."""
    docs = documents(spark)
    out = [docs]
    for _, apply in corpus_pipeline.STAGES:
        out.append(stage(apply(spark, out[-1], folder())))
    return out


def test_columns_are_kept(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality(spark, stages):
    kept = {r.id for r in importance.resample(stages[0], table(spark, folder(), "labels")).collect() if r.kept}
    assert {r.doc_id for r in stages[1].collect()} == kept


def test_lines(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    plain = brute.dedup_lines(rows, line_dedup.WINDOW)
    left = {i: kept for (i, t), (kept, removed) in zip(rows, plain, strict=True) if removed < len(t.split("\n"))}
    got = stages[2].collect()
    assert {r.doc_id: r.text for r in got} == left and all(r.n_chars == len(r.text) for r in got)


def test_near_duplicates(stages):
    rows = {r.doc_id: r.text for r in stages[2].collect()}
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({c for c in brute.components(rows).values()})


def test_mixture(stages):
    copies = {r.id: r.copies for r in mixing.mix(stages[3]).collect()}
    assert Counter(r.doc_id for r in stages[4].collect()) == +Counter(copies)


def test_ids(stages):
    library = Tokenizer.from_file(str(corpus_pipeline.TOKENIZER))
    library.no_truncation()
    library.no_padding()
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    got = stages[5].collect()
    assert len(got) == stages[4].count()
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, library.decode(ids, skip_special_tokens=False))


def test_awkward_rows_pass(spark, tmp_path):
    frames.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    frames.awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    frames.none(spark).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
