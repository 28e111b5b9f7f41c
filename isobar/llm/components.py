"""Connected components by alternating large-star and small-star rounds over edges that each task has merged by itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from isobar.session import stage

#: Edges that a task merges at a time.
MERGE = 1 << 18


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars with the components of some edges: each node but the smallest of its component, and that smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = at[: len(a)], at[len(a) :]
    low = np.arange(len(nodes))
    while (low[one] != low[other]).any():
        roots, others = low[one], low[other]
        np.minimum.at(low, roots, others)
        np.minimum.at(low, others, roots)
        while (low[low] != low).any():
            low = low[low]
    tied = low != np.arange(len(nodes))
    return nodes[tied], nodes[low[tied]]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def merged() -> pa.RecordBatch:
        ends = [np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("a", "b")]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _forest(*ends)], ["a", "b"])

    edges = 0
    for batch in batches:
        held.append(batch)
        edges += batch.num_rows
        if edges >= MERGE:
            yield merged()
            edges = 0
    if held:
        yield merged()


def _merged(edges: DataFrame) -> DataFrame:
    return stage(edges.mapInArrow(_merge, "a bigint, b bigint"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones."""
    ends = edges.select(F.col("a").alias("node"), "b").unionByName(edges.select(F.col("b").alias("node"), F.lit(None).cast("bigint").alias("b")))
    seen = ends.groupBy("node").agg(F.min("b").alias("low"), F.max("b").alias("high"), F.count_if(F.col("b").isNull()).alias("above"))
    return seen.where("low <> high or (low is not null and above > 0)").agg(F.count(F.lit(1))).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    tied = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
    return tied.where("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of an edge of ``edges`` (a, b): comp is the smallest node of its component.

    Each task merges its edges first, so that later rounds have few. Their number grows with the logarithm of the longest chain. Each
    round's edges are written to the shared folder, until they are stars; only whether they are reaches the driver. Loops and repeated
    edges change nothing.
    """
    edges = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b")
    edges = _merged(edges)
    while not _are_stars(edges):
        edges = stage(_small_star(_large_star(edges)))
    tied = edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return stage(tied.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct())
