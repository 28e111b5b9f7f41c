"""Approximate nearest neighbours: inverted lists, scanned with an adaptive number of dimensions.

Vectors are assigned to the nearest of some centroids and rotated at random, so that a few columns of the rotated vectors estimate a
distance. A query probes its nearest lists. Within a list, distances grow by blocks of columns; a candidate is dropped once the partial
distance, scaled to all columns, exceeds the query's k-th best by more than chance explains.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from isobar.session import stage

K = 10
#: Vectors the centroids are fitted on, as a mean. All vectors are indexed.
SAMPLE = 20_000
MOST_LISTS = 4096
#: Share of true neighbours that the probed lists hold, on average over some queries compared with all vectors.
RECALL = 0.96
TRIALS = 256
#: Candidates and queries of one group of rows.
PART = 4096
QUERIES = 256
SLICE = 1024
PAIRS = 1 << 16
COLUMNS = 16
#: Width of the test, in deviations of a partial distance of a rotated vector.
WIDTH = 2.1
ROUNDS = 12
ROW = ("row", "vec_id", "original", "rotated")


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector) of all rows that take part: an id, and a vector of finite numbers that is not zero."""
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where("vec_id IS NOT NULL AND vector IS NOT NULL").where(F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def nearest_lists(x: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centroids of each row, nearest first."""
    d = (centroids**2).sum(1) - 2 * x @ centroids.T
    return np.argsort(d, axis=1, kind="stable")[:, :n]


def fit_centroids(sample: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Centroids of a bounded sample; a list that loses all its vectors starts again at one far from its own centroid."""
    rng = np.random.default_rng(seed)
    different = np.unique(sample, axis=0)
    centroids = different[rng.permutation(len(different))[:lists]]
    for _ in range(ROUNDS):
        d = (centroids**2).sum(1) - 2 * sample @ centroids.T
        own = d.argmin(1)
        n = np.bincount(own, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, own, sample)
        used = n > 0
        centroids[used] = total[used] / n[used, None]
        if not used.all():
            far = np.argsort(-(d[np.arange(len(sample)), own] + (sample**2).sum(1)), kind="stable")
            centroids[~used] = sample[far[: int((~used).sum())]]
    return centroids


def _index(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, rotation: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each vector's list, its bytes, and the bytes of its rotation."""
    for batch in batches:
        for row in range(0, batch.num_rows, 4096):
            part = batch.slice(row, 4096)
            x = _matrix(part.column("vector"), len(rotation))
            turned = (x @ rotation).astype(np.float32)
            own = nearest_lists(x, centroids, 1)[:, 0].astype(np.int32)
            columns = [part.column("vec_id"), pa.array(own), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([v.tobytes() for v in turned], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "list", "original", "rotated"])


def _probe(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, sizes: np.ndarray, probes: int, least: int) -> Iterator[pa.RecordBatch]:
    """The lists each query scans: ``probes``, and more while they hold fewer than ``least`` vectors."""
    width = centroids.shape[1]
    for batch in batches:
        for row in range(0, batch.num_rows, 1024):
            part = batch.slice(row, 1024)
            x = np.frombuffer(b"".join(part.column("original").to_pylist()), np.float64).reshape(-1, width)
            order = nearest_lists(x, centroids, len(centroids))
            held = np.cumsum(sizes[order], axis=1) - sizes[order]
            chosen = (np.arange(len(centroids)) < probes) | (held < least)
            of, at = np.nonzero(chosen & (sizes[order] > 0))
            lists = pa.array(order[of, at].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*[part.column(c).take(pa.array(of)) for c in ROW], lists], [*ROW, "list"])


class _Chunk:
    """Some queries of one list, and the best candidates of each so far."""

    def __init__(self, k: int, width: float):
        self.k, self.width = k, width
        self.rows, self.ids, self.original, self.rotated = np.zeros(0, np.int64), np.zeros(0, np.int64), None, None
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))  # number of the query, candidate, score

    def ask(self, rows: np.ndarray, ids: np.ndarray, original: np.ndarray, rotated: np.ndarray) -> None:
        self.rows = np.concatenate([self.rows, rows])
        self.ids = np.concatenate([self.ids, ids])
        self.original = original if self.original is None else np.concatenate([self.original, original])
        self.rotated = rotated if self.rotated is None else np.concatenate([self.rotated, rotated])

    def _add(self, of: np.ndarray, ids: np.ndarray, originals: np.ndarray) -> None:
        for row in range(0, len(of), PAIRS):
            part = slice(row, row + PAIRS)
            scores = np.sqrt(((originals[part] - self.original[of[part]]) ** 2).sum(1))
            of_, ids_, scores_ = (np.concatenate(x) for x in zip(self.best, (of[part], ids[part], scores), strict=True))
            order = np.lexsort((ids_, scores_, of_))
            of_ = of_[order]
            place = np.arange(len(of_)) - np.searchsorted(of_, of_)
            order = order[place < self.k]
            self.best = (of_[place < self.k], ids_[order], scores_[order])

    def limits(self) -> np.ndarray:
        """The squared k-th best distance of each query, infinite where there are fewer."""
        of, _, scores = self.best
        n = np.bincount(of, minlength=len(self.ids))
        limit = np.full(len(self.ids), np.inf)
        full = n == self.k
        limit[full] = scores[(np.cumsum(n) - 1)[full]] ** 2
        return limit

    def scan(self, numbers: np.ndarray, ids: np.ndarray, originals: np.ndarray, rotated: np.ndarray) -> None:
        """Compare some candidates: the first ones in full, which gives limits, the others by blocks of columns."""
        begin = 4 * self.k if not len(self.best[0]) else 0
        for row, rows in ((0, begin), *((r, SLICE) for r in range(begin, len(ids), SLICE))):
            part = slice(row, row + rows)
            if rows and len(ids[part]) and len(self.ids):
                self._compare(numbers[part], ids[part], originals[part], rotated[part])

    def _compare(self, numbers: np.ndarray, ids: np.ndarray, originals: np.ndarray, rotated: np.ndarray) -> None:
        dims, limit = rotated.shape[1], self.limits()
        slack = 1e-5 * ((self.rotated**2).sum(1)[:, None] + (rotated**2).sum(1))  # rounding of 4-byte floats
        q, c = self.rotated[:, :COLUMNS], rotated[:, :COLUMNS]
        first = (q**2).sum(1)[:, None] + (c**2).sum(1) - 2 * q @ c.T
        seen = min(COLUMNS, dims)
        bound = limit * (1 + self.width / np.sqrt(seen)) ** 2
        of, at = np.nonzero((first * (dims / seen) <= bound[:, None] + slack * (dims / seen)) & (self.rows[:, None] != numbers))
        sums = first[of, at]
        while seen < dims and len(of):
            columns = slice(seen, seen + COLUMNS)
            sums = sums + ((rotated[at, columns] - self.rotated[of, columns]) ** 2).sum(1)
            seen = min(seen + COLUMNS, dims)
            bound = limit * (1 + (self.width / np.sqrt(seen) if seen < dims else 0)) ** 2
            stays = sums * (dims / seen) <= bound[of] + slack[of, at] * (dims / seen)
            of, at, sums = of[stays], at[stays], sums[stays]
        self._add(of, ids[at], originals[at])


def _scan(batches: Iterator[pa.RecordBatch], dims: int, k: int, width: float) -> Iterator[pa.RecordBatch]:
    """The best candidates of each query in each group; rows of a group follow one another, its queries first."""

    def results(chunk: _Chunk) -> Iterator[pa.RecordBatch]:
        of, ids, scores = chunk.best
        if len(of):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (chunk.rows[of], chunk.ids[of], ids, scores)], ["query", "query_id", "vec_id", "score"])

    group, chunk = None, _Chunk(k, width)
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "part", "chunk")], axis=1)
        role, numbers, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("role", "row", "vec_id"))
        original = np.frombuffer(b"".join(batch.column("original").to_pylist()), np.float64).reshape(-1, dims)
        rotated = np.frombuffer(b"".join(batch.column("rotated").to_pylist()), np.float32).reshape(-1, dims)
        cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(ids)], strict=True):
            if group != tuple(keys[a]):
                yield from results(chunk)
                group, chunk = tuple(keys[a]), _Chunk(k, width)
            asked = a + int((role[a:b] == 0).sum())
            chunk.ask(numbers[a:asked], ids[a:asked], original[a:asked], rotated[a:asked])
            chunk.scan(numbers[asked:b], ids[asked:b], original[asked:b], rotated[asked:b])
    yield from results(chunk)


def _exact(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest vectors of one task for each of some queries, with their lists, by comparing all."""
    for batch in batches:
        for row in range(0, batch.num_rows, 4096):
            part = batch.slice(row, 4096)
            x = np.frombuffer(b"".join(part.column("original").to_pylist()), np.float64).reshape(-1, queries.shape[1])
            d = (x**2).sum(1) - 2 * queries @ x.T + (queries**2).sum(1)[:, None]
            d[ids[:, None] == part.column("vec_id").to_numpy(zero_copy_only=False)] = np.inf
            best = np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k]
            of = np.repeat(np.arange(len(queries)), best.shape[1]).astype(np.int32)
            lists = part.column("list").take(pa.array(best.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(of), lists, pa.array(np.take_along_axis(d, best, 1).ravel())], ["query", "list", "d"])


INDEXED = "vec_id bigint, list int, original binary, rotated binary"


class Index:
    """Inverted lists over a table of vectors."""

    def __init__(self, vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", sample: int = SAMPLE, lists: int | None = None):
        """Centroids are fitted on about ``sample`` vectors chosen by a hash of the id; every vector that takes part is indexed."""
        rows = usable(vectors, id_column, vector_column)
        widths = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1).collect()
        self.dims, self.n = (widths[0]["dims"], widths[0]["count"]) if widths else (0, 0)
        if not self.n:
            return
        rows = rows.where(F.size("vector") == self.dims)
        cut = int(2**32 * min(1.0, sample / self.n))
        chosen = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(2**32)) < cut).select("vector").toArrow()["vector"].combine_chunks()
        if not len(chosen):
            chosen = rows.select("vector").limit(K).toArrow()["vector"].combine_chunks()
        wanted = lists or int(min(max(round(np.sqrt(self.n)), 1), MOST_LISTS))
        self.centroids = fit_centroids(_matrix(chosen, self.dims), wanted)
        rotation = np.linalg.qr(np.random.default_rng(11).standard_normal((self.dims, self.dims)))[0]
        indexed = rows.mapInArrow(partial(_index, centroids=self.centroids, rotation=rotation), INDEXED)
        self.rows = stage(indexed.withColumn("row", F.monotonically_increasing_id()))  # written once: the numbers hold from here on
        self.sizes = np.zeros(len(self.centroids), np.int64)
        for r in self.rows.groupBy("list").count().collect():
            self.sizes[r["list"]] = r["count"]

    def probes_for(self, recall: float, k: int) -> int:
        """How many lists to probe: as many as hold ``recall`` of the ``k`` nearest neighbours of ``TRIALS`` vectors, found by comparing
        these with all vectors. Some data need few lists, vectors without clusters many; no fixed share suits both."""
        trials = self.rows.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(TRIALS).select("vec_id", "original").toArrow()
        ids = trials["vec_id"].to_numpy()
        queries = np.frombuffer(b"".join(trials["original"].to_pylist()), np.float64).reshape(-1, self.dims)
        found = self.rows.mapInArrow(partial(_exact, ids=ids, queries=queries, k=k), "query int, list int, d double")
        rank = F.row_number().over(Window.partitionBy("query").orderBy("d", "list"))
        best = found.where(F.col("d") < float("inf")).withColumn("rank", rank).where(F.col("rank") <= k).select("query", "list").toArrow()
        order = nearest_lists(queries, self.centroids, len(self.centroids))
        place = np.argsort(order, axis=1)[best["query"].to_numpy(), best["list"].to_numpy()]
        return int(np.quantile(place, recall, method="higher")) + 1 if len(place) else 1

    def search(self, queries: DataFrame, k: int = K, recall: float = RECALL, width: float = WIDTH) -> DataFrame:
        """(query_id, rank, vec_id, score): the ``k`` nearest found of each indexed row whose id is in ``queries`` (vec_id), the row itself
        left out; the score is the Euclidean distance of the original vectors.

        A list is scanned in parts of about ``PART`` candidates by chunks of about ``QUERIES`` queries, however large it is: the rows
        of a part come once per chunk, those of a chunk once per part. Each part keeps ``k`` per query before the shuffle that merges.
        """
        if not self.n:
            return queries.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
        probes = self.probes_for(recall, k)
        asked = self.rows.join(queries.select("vec_id").distinct(), "vec_id", "left_semi").drop("list")
        probed = stage(asked.mapInArrow(partial(_probe, centroids=self.centroids, sizes=self.sizes, probes=probes, least=4 * k), "row bigint, vec_id bigint, original binary, rotated binary, list int"))
        known = [(i, int(n)) for i, n in enumerate(self.sizes)]
        lists = queries.sparkSession.createDataFrame(known, "list int, size bigint")
        counted = probed.groupBy("list").agg(F.count(F.lit(1)).alias("asked"))
        plan = F.broadcast(lists.join(counted, "list").select("list", F.ceil(F.col("size") / PART).cast("int").alias("parts"), F.ceil(F.col("asked") / QUERIES).cast("int").alias("chunks")))

        def every(n: str):
            return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

        chunk, part = F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int"), F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
        columns = ("list", "part", "chunk", "role", *ROW)
        one = probed.join(plan, "list").withColumn("chunk", chunk).withColumn("part", every("parts")).withColumn("role", F.lit(0))
        two = self.rows.join(plan, "list").withColumn("part", part).withColumn("chunk", every("chunks")).withColumn("role", F.lit(1))
        groups = one.select(*columns).unionByName(two.select(*columns)).repartition("list", "part", "chunk").sortWithinPartitions("list", "part", "chunk", "role")
        found = groups.mapInArrow(partial(_scan, dims=self.dims, k=k, width=width), "query bigint, query_id bigint, vec_id bigint, score double")
        rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, every: int, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding", **limits) -> DataFrame:
    """The ``k`` nearest neighbours of each row whose id is divisible by ``every``, among all other rows.

    Vectors that are NULL, zero, or hold a NULL or non-finite number take no part, nor do rows without an id and vectors of another
    than the commonest length, to which no distance is defined. Rows that repeat an id, with the same vector or another, are queries and
    candidates of their own: such a query has ranks of its own under the shared id. Equal
    distances go to the smaller id. With fewer than ``k`` candidates all are returned; an empty table gives no rows. Other columns are not read.
    """
    asked = vectors.select(F.col(id_column).cast("bigint").alias("vec_id")).where(F.col("vec_id") % every == 0)
    return Index(vectors, id_column, vector_column, **limits).search(asked, k)
