"""Exact similarity join of documents under the Jaccard distance of their word shingles, and its connected components.

Equal shingle sets are one node. Nodes meet near pivots: the cell of a shingle holds the nodes that may have it as their nearest
landmark, which are those with the shingle among the first of theirs in one fixed order; a node with n shingles can differ
from a neighbour in so many of them only, so it lies in few cells, and any two neighbours share one. Sorted by size, a cell falls apart
where sizes differ too much, and the first node of each part is the pivot of a region. A region is joined in one task as long as
it is small. A larger one is cut: all its nodes are measured against several pivots, which links most of a dense group; the
nodes left over go to the Voronoi region of their nearest pivot, together with all nodes in the window of distances that the
triangle inequality leaves for their neighbours.

Before texts are sent to a small region, sketches are: a set folded into bits, each the parity of the shingles that fall on it. Two
sketches differ in no more bits than the sets in shingles, so nodes whose sketch is too far from all others of the region can be left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from isobar.llm.components import connected
from isobar.llm.hashing import mixed, pieces, runs
from isobar.session import stage

SHINGLE = 5
#: Neighbours have 100 * common >= PERCENT * together.
PERCENT = 80
#: Nodes of one join task.
REGION = 512
#: Nodes of one task that compares sketches.
SKETCH_PART = 4096
#: Rows of a batch that goes to Python.
BATCH = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Slots of document ids; bounds what is broadcast to pass over documents that no region asks for.
SLOTS = 1 << 20
#: Pivots of a large region.
PIVOTS = 8
#: Shingles are compared by 64 bits, cells are told apart by 48; equal cells of different shingles only cost comparisons.
CELL_MASK = np.uint64((1 << 48) - 1)
#: A shingle is common if this share of the documents of some stretch of the input has it; common ones come last in the order.
COMMON = 1 / 2048
STRETCH = 32_768
LEAST_COMMON = 4


def shingle_sets(texts, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text its distinct shingles in order; a text with fewer words has one for all of them."""
    words, at = texts.words(lower=True)
    found, found_at = runs(words, at, size)
    for i in range(texts.n):
        n = at[i + 1] - at[i]
        if n >= size:
            yield np.unique(found[found_at[i] : found_at[i + 1]])
        elif n:
            short = words[at[i] : at[i + 1]]
            yield mixed(np.array([hash_of_few(short)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def hash_of_few(words: np.ndarray) -> np.uint64:
    total = np.uint64(len(words))
    with np.errstate(over="ignore"):
        for w in words:
            total = mixed(np.array([total * np.uint64(0x9E3779B97F4A7C15) + w], np.uint64))[0]
    return total


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: two sums of independently mixed elements."""
    a = mixed(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
    b = mixed(s * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


#: Bits of a sketch per shingle, at least; rounded up to a power of two.
SKETCH_BITS = 4


def sketch(s: np.ndarray) -> bytes:
    """The parity of the number of shingles on each of 2^k bits, 64 at the least."""
    bits = max(64, 1 << int(len(s) * SKETCH_BITS - 1).bit_length())
    count = np.bincount((mixed(s) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(sketches: np.ndarray) -> np.ndarray:
    """Sketches of half as many bits."""
    half = sketches.shape[1] // 2
    return sketches[:, :half] ^ sketches[:, half:]


def near_in_sketch(size: np.ndarray, sketches: list[bytes], asks: np.ndarray, group: np.ndarray, percent: int) -> np.ndarray:
    """Which of some nodes may have a neighbour in another group; only pairs with one that ``asks`` are looked at.

    Neighbours differ in (100 - p) / (100 + p) of their shingles at the most, and their sketches in no more bits. Sizes of neighbours
    differ so little that their sketches are equally long, or one twice as long as the other, which is folded then.
    """
    near, bits = np.zeros(len(size), bool), np.array([len(x) for x in sketches])

    def compare(rows: np.ndarray, own: np.ndarray, others: np.ndarray, theirs: np.ndarray) -> None:
        for i, row in zip(rows[asks[rows]], own[asks[rows]], strict=True):
            close = (100 * size[others] >= percent * size[i]) & (100 * size[i] >= percent * size[others]) & (group[others] != group[i])
            at = np.flatnonzero(close)
            if len(at):
                differ = np.bitwise_count(theirs[at] ^ row).sum(1, dtype=np.int64)
                found = others[at[differ * (100 + percent) <= (100 - percent) * (size[i] + size[others[at]])]]
                if len(found):
                    near[i] = True
                    near[found] = True

    held = {}
    for b in np.unique(bits).tolist():
        rows = np.flatnonzero(bits == b)
        held[b] = rows, np.frombuffer(b"".join(sketches[i] for i in rows), np.uint64).reshape(len(rows), -1)
    for b, (rows, own) in held.items():
        compare(rows, own, rows, own)
        if 2 * b in held:
            others, longer = held[2 * b]
            compare(rows, own, others, _folded(longer))
            compare(others, _folded(longer), rows, own)
    return near


def _near_members(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows (region, node) of nodes that may have a neighbour in their part; rows of a part follow one another."""

    def chosen(region: int, rows: list[tuple]) -> pa.RecordBatch:
        nodes, asks, groups, sizes, sketches = zip(*rows, strict=True)
        near = near_in_sketch(np.array(sizes), list(sketches), np.array(asks) > 0, np.array(groups), percent)
        ids = np.unique(np.array(nodes)[near])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), region, np.int64)), pa.array(ids, pa.int64())], ["region", "node"])

    key, rows = None, []
    for batch in batches:
        for region, part, *row in zip(*(batch.column(c).to_pylist() for c in ("region", "part", "node", "role", "comp", "n", "sketch")), strict=True):
            if (region, part) != key:
                if len(rows) > 1:
                    yield chosen(key[0], rows)
                key, rows = (region, part), []
            rows.append(tuple(row))
    if len(rows) > 1:
        yield chosen(key[0], rows)


def slack(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of n may have and a neighbour not."""
    return n - -(-n * percent // 100)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set's size and digest (kind 0), and common shingles of each stretch of documents with their counts (kind 1)."""
    seen, held = 0, []

    def common() -> pa.RecordBatch:
        values = np.concatenate(held) if held else np.zeros(0, np.uint64)
        held.clear()
        values.sort()
        least = max(LEAST_COMMON, math.ceil(seen * COMMON))
        firsts = values[: max(len(values) - least + 1, 0)]
        often = np.unique(firsts[firsts == values[least - 1 :]])
        counts = np.searchsorted(values, often, side="right") - np.searchsorted(values, often)
        nothing = pa.nulls(len(often), pa.int64())
        return _rows(1, nothing, pa.array(counts.astype(np.int64)), pa.array(often.view(np.int64)), nothing)

    def _rows(kind: int, *columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *columns], ["kind", "doc_id", "n", "d1", "d2"])

    for batch in batches:
        ids = batch.column("doc_id")
        for row, texts in pieces(batch.column("text")):
            n, d1, d2 = [], [], []
            for s in shingle_sets(texts):
                n.append(len(s))
                a, b = _digest(s)
                d1.append(a)
                d2.append(b)
                held.append(s[s < np.uint64(1 << 62)])
                seen += 1
            yield _rows(0, ids.slice(row, texts.n), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()))
            if seen >= STRETCH:
                yield common()
                seen, held = 0, []
    if seen:
        yield common()


def _first_shingles(batches: Iterator[pa.RecordBatch], common: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Per document its digest, the cells it lies in, and its sketch."""
    for batch in batches:
        ids = batch.column("doc_id")
        for row, texts in pieces(batch.column("text")):
            n, d1, d2, cells, sketches = [], [], [], [], []
            for s in shingle_sets(texts):
                n.append(len(s))
                a, b = _digest(s)
                d1.append(a)
                d2.append(b)
                often = np.isin(s, common, assume_unique=True) if len(common) else np.zeros(len(s), bool)
                order = np.concatenate([s[~often], s[often]])
                cells.append((order[: slack(len(s), percent) + 1] & CELL_MASK).view(np.int64))
                sketches.append(sketch(s))
            at = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(cells)))
            columns = [ids.slice(row, texts.n), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), lists, pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "d1", "d2", "cells", "sketch"])


# joining the nodes of one region in one task


class _Region:
    """Some nodes' sets, the components they are known to belong to, and the links found between those."""

    def __init__(self, sets: list[np.ndarray], comps: list[int], percent: int):
        self.comps, self.percent = comps, percent
        self.size = np.array([len(s) for s in sets])
        self.tokens, self.starts = np.concatenate(sets), np.concatenate([[0], np.cumsum(self.size)[:-1]])
        _, self.tokens = np.unique(self.tokens, return_inverse=True)
        self.group = np.unique(np.array(comps), return_inverse=True)[1]
        self.links: list[tuple[int, int]] = []
        self.mark = np.zeros(self.tokens.max() + 1, bool)

    def common(self, i: int) -> np.ndarray:
        """The shingles that node i shares with each node."""
        own = self.tokens[self.starts[i] : self.starts[i] + self.size[i]]
        self.mark[own] = True
        shared = np.add.reduceat(self.mark[self.tokens], self.starts, dtype=np.int64)
        self.mark[own] = False
        return shared

    def distances(self, i: int) -> np.ndarray:
        """From node i to all, having linked it with its neighbours."""
        shared = self.common(i)
        union = self.size + self.size[i] - shared
        for j in np.flatnonzero((100 * shared >= self.percent * union) & (self.group != self.group[i])):
            if self.group[j] != self.group[i]:
                self.links.append((self.comps[i], self.comps[j]))
                self.group[self.group == self.group[j]] = self.group[i]
        return 1 - shared / union

    def join(self, rows: np.ndarray, others: np.ndarray) -> None:
        """Link all neighbours i in ``rows`` and j in ``others``, as far as they are not connected.

        The first rows are pivots: a pair whose distances from one of them differ by more than the radius is no link.
        """
        radius, far, measured = 1 - self.percent / 100 + 1e-9, [], 0
        for i in rows:
            possible = others & (self.group != self.group[i])
            possible &= (100 * self.size >= self.percent * self.size[i]) & (100 * self.size[i] >= self.percent * self.size)
            for d in far:
                if not possible.any():
                    break
                possible &= np.abs(d - d[i]) <= radius
            if possible.any():
                d = self.distances(i)
                measured += 1
                if measured <= 4:
                    far.append(d)


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list, list[np.ndarray]]]:
    """Rows of equal (region, part), which follow one another, with the sets of their texts."""
    key, rows, sets = None, [], []
    for batch in batches:
        columns = batch.to_pydict() if not batch.num_rows else {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "text"}
        if not batch.num_rows:
            continue
        found: list[np.ndarray] = []
        for _, texts in pieces(batch.column("text")):
            found += shingle_sets(texts)
        for i, s in enumerate(found):
            here = (columns["region"][i], columns["part"][i])
            if here != key:
                if rows:
                    yield key, rows, sets
                key, rows, sets = here, [], []
            if (columns["d1"][i], columns["d2"][i]) == _digest(s):  # else another row with the same id
                rows.append({c: columns[c][i] for c in columns})
                sets.append(s)
    if rows:
        yield key, rows, sets


LINKS = "a bigint, b bigint"


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["a", "b"])


def _distinct(rows: list, sets: list) -> tuple[list, list]:
    first: dict[int, int] = {}
    for i, r in enumerate(rows):
        if r["node"] not in first or (r["role"] > rows[first[r["node"]]]["role"]):
            first[r["node"]] = i
    keep = sorted(first.values())
    return [rows[i] for i in keep], [sets[i] for i in keep]


def _join_parts(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of each part, between comps. Role 2 meets all others (pivots come first), role 1 meets 1 and 2, role 0 meets 2 only."""
    for _, rows, sets in _regions(batches):
        rows, sets = _distinct(rows, sets)
        if len(rows) < 2:
            continue
        region = _Region(sets, [r["comp"] for r in rows], percent)
        role = np.array([r["role"] for r in rows])
        region.join(np.flatnonzero(role == 2), np.ones(len(rows), bool))
        region.join(np.flatnonzero(role == 1), role == 1)
        if region.links:
            yield _link_batch(region.links)


def _measure_parts(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The distance of each node of a part from each pivot of its region (role 2), as an array in the order of pivot nodes."""
    for (region, _), rows, sets in _regions(batches):
        pivots = sorted({r["node"]: i for i, r in enumerate(rows) if r["role"] == 2}.items())
        measured = _Region(sets, list(range(len(rows))), percent)
        d = []
        for _, i in pivots:
            shared = measured.common(i)
            d.append(1 - shared / (measured.size + measured.size[i] - shared))
        inside = [i for i, r in enumerate(rows) if r["role"] != 2]
        columns = [pa.array([region] * len(inside), pa.int64()), pa.array([rows[i]["node"] for i in inside], pa.int64()), pa.array([[float(x[i]) for x in d] for i in inside], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["region", "node", "distances"])


def _whole(members: DataFrame) -> DataFrame:
    """Regions (region, node, comp) as one part each, all of whose nodes meet."""
    return members.select("region", F.lit(0).cast("bigint").alias("part"), F.lit(1).alias("role"), "node", "comp")


def _crowded(rows: DataFrame, most: int) -> DataFrame:
    """(region, size) of the regions with more than ``most`` rows: so few that a join with them seldom needs a shuffle of the rows."""
    return stage(rows.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > most))


def _against(some: DataFrame, every: DataFrame, most: int, group: Column) -> DataFrame:
    """Parts in which some nodes (role 1) meet every node (role 0) of their region and group, in blocks of about half of ``most`` nodes
    of either kind. Both frames have n_rest and n_all, the numbers of nodes."""
    blocks = [F.ceil(F.col(n) * 2 / F.lit(most)).cast("int") for n in ("n_rest", "n_all")]
    own = [F.pmod(F.xxhash64("node", F.lit(i)), b).cast("int") for i, b in enumerate(blocks)]
    each = [F.explode(F.sequence(F.lit(0), b - 1)) for b in blocks]
    part = (group.cast("bigint") * 2**56 + F.col("a").cast("bigint") * 2**28 + F.col("b")).alias("part")
    left = some.withColumn("a", own[0]).withColumn("b", each[1]).select("region", part, F.lit(1).alias("role"), "node", "comp")
    right = every.withColumn("b", own[1]).withColumn("a", each[0]).select("region", part, F.lit(0).alias("role"), "node", "comp")
    return left.unionByName(right)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python in batches of ``BATCH`` at the most: a batch of texts is held by the executor and by Python, in each once or twice."""
    before = spark.conf.get(_BATCH_ROWS)
    rows = int(before)
    spark.conf.set(_BATCH_ROWS, str(min(rows, BATCH) if rows > 0 else BATCH))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


class Join:
    """The similarity join of one table of documents (doc_id, text)."""

    def __init__(self, docs: DataFrame, percent: int = PERCENT, region: int = REGION, pivots: int = PIVOTS):
        self.docs, self.percent, self.region, self.pivots = docs.select("doc_id", "text"), percent, region, pivots

    def common_shingles(self, survey: DataFrame) -> np.ndarray:
        """Shingles of many documents. A shingle counts if it was named for one in 4096 of all documents, so there are at most 4096 times
        the mean number that a document has in the quarter of shingles surveyed, a bound that does not grow with the input."""
        n = survey.where("kind = 0").count()
        often = survey.where("kind = 1").groupBy("d1").agg(F.sum("n").alias("n")).where(F.col("n") >= max(LEAST_COMMON, n * COMMON / 2))
        return np.sort(often.select("d1").toArrow()["d1"].to_numpy().astype(np.int64).view(np.uint64))

    def nodes(self, common: np.ndarray) -> DataFrame:
        """One row per distinct shingle set: node, smallest doc_id, size, digest, cells, sketch."""
        schema = "doc_id bigint, n bigint, d1 bigint, d2 bigint, cells array<bigint>, sketch binary"
        found = self.docs.mapInArrow(partial(_first_shingles, common=common, percent=self.percent), schema)
        equal = [F.first(c).alias(c) for c in ("n", "cells", "sketch")]
        sets = found.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), *equal)
        return stage(sets.withColumn("node", F.monotonically_increasing_id()))

    def members(self, nodes: DataFrame) -> DataFrame:
        """(region, node): a region is named after its pivot, the first node of a part of a cell."""
        cells = nodes.select("node", "n", F.explode("cells").alias("cell"))
        order = Window.partitionBy("cell").orderBy("n", "node")
        apart = 100 * F.lag("n").over(order) < self.percent * F.col("n")
        begins = F.when(F.coalesce(apart, F.lit(True)), F.col("node"))
        pivot = F.last(begins, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        pairs = cells.select("node", pivot.alias("region")).where("node <> region")
        return stage(pairs.select("region", F.explode(F.array("node", "region")).alias("node")).distinct())

    def near(self, nodes: DataFrame, rows: DataFrame) -> DataFrame:
        """(region, node) of those of the rows (region, part, role, node, comp) that may have a neighbour of another comp in their part, by
        their sketches. Rows of role 1 are compared with all."""
        full = rows.join(nodes.select("node", "n", "sketch"), "node")
        sorted_ = full.repartition("region", "part").sortWithinPartitions("region", "part")
        return stage(sorted_.mapInArrow(partial(_near_members, percent=self.percent), "region bigint, node bigint").distinct())

    def texts(self, nodes: DataFrame, members: DataFrame) -> DataFrame:
        """The texts of the members, once each.

        Documents none of whose hash slots is wanted are passed over before the shuffle; there are ``SLOTS`` slots, so what is
        broadcast has that many rows at the most.
        """
        wanted = stage(members.select("node").distinct().join(nodes.select("node", "rep", "d1", "d2"), "node"))

        def slot(key: str) -> Column:
            return F.pmod(F.xxhash64(key), F.lit(SLOTS)).alias("slot")

        slots = wanted.select(slot("rep")).distinct()
        docs = self.docs.select("doc_id", "text", slot("doc_id")).join(F.broadcast(slots), "slot", "left_semi")
        return stage(docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"])).select("node", "d1", "d2", "text"))

    def _run(self, rows: DataFrame, texts: DataFrame, work: Callable, schema: str) -> DataFrame:
        """``work`` over the rows (region, part, role, node, comp) with their texts, a part in one task, pivots first."""
        full = rows.join(texts, "node").repartition("region", "part").sortWithinPartitions("region", "part", F.desc("role"), "node")
        return full.mapInArrow(partial(work, percent=self.percent), schema)

    def components(self, nodes: DataFrame) -> DataFrame:
        """(node, d1, d2, rep, comp): nodes of one component have the same comp."""
        members = self.members(nodes).withColumn("comp", F.col("node"))
        big = _crowded(members, SKETCH_PART // 2)
        dealt = self._parts(members.join(big, "region"), SKETCH_PART).withColumn("role", (F.col("role") == 2).cast("int"))
        near = self.near(nodes, _whole(members.join(big, "region", "left_anti")).unionByName(dealt)).withColumn("comp", F.col("node"))
        crowded = _crowded(near, self.region)
        rows = _whole(near.join(crowded, "region", "left_anti")).unionByName(self._parts(near.join(crowded, "region"), self.region))
        comps = connected(stage(self._run(rows, self.texts(nodes, near), _join_parts, LINKS)))
        known = nodes.select("node", "d1", "d2", "rep").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        if big.isEmpty() and crowded.isEmpty():
            return known
        columns, left = ("region", "node"), crowded.join(big, "region", "left_anti")
        large = members.join(big, "region").select(*columns).unionByName(near.join(left, "region").select(*columns))
        open_ = self.open_members(nodes, large, comps)
        if open_ is None:
            return known
        merged = connected(self.rest_links(nodes, open_)).select(F.col("node").alias("comp"), F.col("comp").alias("with"))
        return known.join(merged, "comp", "left").withColumn("comp", F.coalesce("with", "comp")).drop("with")

    def _parts(self, rows: DataFrame, most: int) -> DataFrame:
        """Rows (region, node, comp, size) of role 1 dealt out to parts of about half of ``most`` nodes, with the region's pivots in every
        part as role 2. Pivots are a few nodes chosen by a hash. Nodes near to a pivot, and those that meet in a part, show most links
        of a dense group for one look at each node."""
        counted = rows.withColumn("parts", F.ceil(F.col("size") * 2 / F.lit(most)).cast("int"))
        rank = F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64("node"), "node"))
        pivots = counted.withColumn("rank", rank).where(F.col("rank") <= self.pivots)
        part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
        own = counted.select("region", part, F.lit(1).alias("role"), "node", "comp")
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        return own.unionByName(pivots.select("region", every, F.lit(2).alias("role"), "node", "comp"))

    def open_members(self, nodes: DataFrame, large: DataFrame, comps: DataFrame) -> DataFrame | None:
        """Of regions that are not one component yet, the nodes that may still have a neighbour of another component: (region, node,
        comp, rest), ``rest`` for nodes outside the region's largest component. Every such pair has one of these."""
        labelled = stage(large.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
        counts = labelled.groupBy("region", "comp").agg(F.count(F.lit(1)).alias("n"))
        main = counts.groupBy("region").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all")).where(F.col("top.n") < F.col("all"))
        main = stage(main.select("region", F.col("top.comp").alias("main"), (F.col("all") - F.col("top.n")).alias("n_rest"), F.col("all").alias("n_all")))
        still = labelled.join(main, "region").withColumn("rest", F.col("comp") != F.col("main"))
        rows = stage(_against(still.where("rest"), still, SKETCH_PART, F.lit(0)))  # if they are few, sketches need no shuffle
        near = self.near(nodes, rows)
        open_ = stage(near.join(still.select("region", "node", "comp", "rest"), ["region", "node"]))
        return None if open_.isEmpty() else open_

    def rest_links(self, nodes: DataFrame, open_: DataFrame) -> DataFrame:
        """Links of the open nodes, between components: of a region in one task if it has few of them, else by Voronoi regions."""
        texts, crowded = self.texts(nodes, open_), _crowded(open_, self.region)
        rows = _whole(open_.join(crowded, "region", "left_anti"))
        if not crowded.isEmpty():
            rows = rows.unionByName(self.window_parts(open_.join(crowded, "region"), texts))
        return stage(self._run(rows, texts, _join_parts, LINKS))

    def window_parts(self, open_: DataFrame, texts: DataFrame) -> DataFrame:
        """Parts for the links of the nodes outside their region's main component, by Voronoi regions and windows.

        A node goes to its nearest pivot. Its neighbours are at distances from that pivot that differ from its own by the radius at
        most, so every node in the window around the distances of a Voronoi region's own nodes comes there as well.
        """
        radius = 1 - self.percent / 100 + 1e-9
        rows = stage(self._parts(open_, self.region))
        measured = self._run(rows, texts, _measure_parts, "region bigint, node bigint, distances array<double>")
        known = stage(measured.join(open_.drop("size"), ["region", "node"]).select("region", "node", "comp", "rest", "distances"))
        nearest = F.array_position("distances", F.array_min("distances")).cast("int")
        own = F.element_at("distances", F.col("home"))
        near = known.where("rest").withColumn("home", nearest).withColumn("d", own)
        reach = near.groupBy("region", "home").agg(
            (F.min("d") - radius).alias("low"), (F.max("d") + radius).alias("high"), F.count(F.lit(1)).alias("n_rest")
        )
        inside = known.join(reach, "region").where(own.between(F.col("low"), F.col("high")))
        inside = inside.select("region", "home", "node", "comp", (F.col("rest") & (nearest == F.col("home"))).alias("mine"), "n_rest")
        n = inside.groupBy("region", "home").agg(F.count(F.lit(1)).alias("n_all"))
        inside = stage(inside.join(n, ["region", "home"]))
        return _against(inside.where("mine"), inside, self.region, F.col("home")).withColumn("role", F.col("role") * 2)

    def classes(self) -> DataFrame:
        """One row per document: doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id (smallest reachable)."""
        with _small_batches(self.docs.sparkSession):
            survey = stage(self.docs.mapInArrow(_survey, "kind int, doc_id bigint, n bigint, d1 bigint, d2 bigint"))
            nodes = self.nodes(self.common_shingles(survey))
            reps = self.components(nodes)
        smallest = reps.groupBy("comp").agg(F.min("rep").alias("component_id"))
        known = stage(reps.join(smallest, "comp").select("d1", "d2", F.col("rep").alias("class_id"), "component_id"))
        joined = survey.where("kind = 0").join(known, ["d1", "d2"], "left")
        alone = F.col("n") == 0
        return joined.select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text", **limits: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id and component_id. See the module for the method.

    Texts are lower-cased (A-Z) and cut at white space. A document with fewer than five words has one shingle, its words; one
    without words, or with a NULL text, has none and is alone. Rows that repeat an id are documents of their own, which share the
    id in the result. A NULL id joins like any other and is the largest. An empty table gives no rows. Other columns are not read.
    """
    return Join(docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")), percent, **limits).classes()
