"""A Merkle manifest of a table, and proofs that climb it in a recursive query.

Every row is a leaf. The leaves of a source, by id, are hashed sixteen at a time until one digest is left, the subroot; subroots, by
source, are hashed alike to the root. The built levels are stored as node rows that name their parent. A recursive query then starts at
the lowest nodes and climbs to the root: each step joins the parent, appends the digests beside the node to the proof, and folds the
digest that a possibly altered leaf has given so far. The leaves under one lowest node share all siblings above it, so they
climb in one row with an array of folded digests and one proof.

Order: NULL sources and ids first, then ascending (sources by their UTF-8 bytes); rows of one id by their leaf digest. A NULL value is
hashed as ``-``; a NULL id is never altered. Equal rows are leaves of their own. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isobar.llm.common import empty_to
from isobar.llm.order import places
from isobar.session import stage

#: Nodes under a parent, and characters of a digest.
FAN = 16
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose id's CRC-32 this number divides are altered in the check.
ALTERED = 5
#: The tree of subroots.
TOP = -1
#: Copies of a node that the climb meets by turns, at most, and of all nodes on a level of the tree of subroots.
MOST_COPIES = 4096
LEVEL_COPIES = 1 << 16
UP = ("up_tree", "up_level", "up_pos", "up_copies")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf(values: list[Column]) -> Column:
    """The digest of a row: of each value the bytes in UTF-8, a colon and the value, or ``-`` for NULL."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def _leaves(docs: DataFrame) -> DataFrame:
    altered = F.crc32(F.col("doc_id").cast("string")) % ALTERED == 0
    changed = {"text": F.translate("text", _UPPER, _UPPER.lower())}
    tampered = F.when(altered & F.col("text").rlike("[A-Z]"), leaf([changed.get(c, F.col(c)) for c in FIELDS]))
    hashed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf([F.col(c) for c in FIELDS]).alias("leaf"), tampered.alias("tampered"))
    return hashed.withColumn("tampered", empty_to(F.col("tampered"), F.col("leaf")))


def _parents(level: DataFrame) -> DataFrame:
    """The nodes above ``level`` (tree, pos, hash, n), where n is the number of nodes of the tree on the level."""
    runs = level.groupBy("tree", "n", F.expr(f"pos div {FAN}").alias("parent")).agg(F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("run"))
    joined = F.array_join(F.col("run.hash"), "")
    return runs.select("tree", F.col("parent").alias("pos"), F.sha2(joined, 256).alias("hash"), joined.alias("joined"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"))


def _built(level: DataFrame) -> list[DataFrame]:
    """All levels above the leaves of some trees, each written once."""
    levels = []
    most = level.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(stage(_parents((levels[-1] if levels else level).where("n > 1").select("tree", "pos", "hash", "n"))))
        most = -(-most // FAN)
    return levels


def _copies_below(level: int) -> int:
    """One for each sixteen of the lowest nodes that can be below a node: all levels then have about as many rows, and none is met in one task."""
    return min(MOST_COPIES, FAN ** max(level - 2, 0))


def _copies_top(level: int, trees: int) -> int:
    return max(1, min(MOST_COPIES, LEVEL_COPIES // -(-trees // FAN**level)))


def _linked(levels: list[DataFrame], trees: int, top: bool = False) -> DataFrame:
    """Node rows with the name of their parent; the last node of a tree names its parent in the tree of ``trees`` subroots, if there is one."""
    rows, joins = [], not top and trees > 1
    for k, level in enumerate(levels, 1):
        copies = [_copies_top(i, trees) if top else _copies_below(i) for i in (k, k + 1)]
        last = F.col("n") == 1
        up = [F.when(~last, F.col("tree")), F.when(~last, F.lit(k + 1)), F.when(~last, F.expr(f"pos div {FAN}")), F.when(~last, F.lit(copies[1]))]
        if joins:
            up = [F.coalesce(u, o) for u, o in zip(up, (F.lit(TOP), F.lit(1), F.expr(f"tree div {FAN}"), F.lit(_copies_top(1, trees))), strict=True)]
        slot = F.when(last, F.col("tree")).otherwise(F.col("pos")) % FAN
        cells = [*[u.cast("bigint").alias(c) for u, c in zip(up, UP, strict=True)], slot.alias("slot"), F.lit(copies[0]).cast("bigint").alias("copies")]
        rows.append(level.select("tree", F.lit(k).cast("bigint").alias("level"), "pos", "hash", "joined", (last & F.lit(joins)).alias("is_subroot"), *cells))
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more)
    return whole


#: A row starts under its parent's name and ends at the root, which has no parent.
CLIMB = f"""
WITH RECURSIVE climb(tree, run, up_tree, up_level, up_pos, up_copies, slot, folded, above, hash, subroot) AS (
  SELECT tree, run, up_tree, up_level, up_pos, up_copies, slot, folded, '' AS above, hash, subroot FROM {{starts}}
  UNION ALL
  SELECT c.tree, c.run, p.up_tree, p.up_level, p.up_pos, p.up_copies, p.slot,
    transform(c.folded, f -> sha2(concat(substr(p.joined, 1, int(c.slot * {HEX})), f, substr(p.joined, int(c.slot * {HEX} + {HEX + 1}))), 256)),
    concat(c.above, substr(p.joined, 1, int(c.slot * {HEX})), substr(p.joined, int(c.slot * {HEX} + {HEX + 1}))),
    p.hash, CASE WHEN p.is_subroot THEN p.hash ELSE c.subroot END
  FROM climb c JOIN {{nodes}} p ON c.up_tree = p.tree AND c.up_level = p.level AND c.up_pos = p.pos
    AND p.turn = (c.tree + c.run) % c.up_copies
)
SELECT tree, run, folded, above, hash AS root, subroot FROM climb WHERE up_level IS NULL"""
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def climbed(starts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every row of ``starts`` at the root. The recursion's limit on rows is lifted meanwhile: it climbs for the whole table."""
    spark = starts.sparkSession
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        above = nodes.where(f"tree = {TOP} OR level > 1").withColumn("turn", F.explode(F.expr("sequence(0L, copies - 1)")))
        return stage(spark.sql(CLIMB, starts=starts, nodes=above))
    finally:
        spark.conf.set(_ROW_LIMIT, before) if before is not None else spark.conf.unset(_ROW_LIMIT)


class Manifest:
    """The stored tree over a table: ``leaves`` (doc_id, source, leaf, tampered, tree, pos, n) and ``nodes``, rows linked to their parents."""

    def __init__(self, docs: DataFrame):
        hashed = stage(_leaves(docs))
        sizes = stage(hashed.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
        trees = places(sizes, [], [F.col("source").asc_nulls_first()], "tree").withColumnRenamed("source", "of")
        placed = places(hashed, ["source"], [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("tampered")])
        self.leaves = stage(placed.join(trees, F.col("source").eqNullSafe(F.col("of"))).drop("of"))
        levels = _built(self.leaves.select("tree", "pos", F.col("leaf").alias("hash"), "n"))
        subroots = self.leaves.where("n = 1").select("tree", F.col("leaf").alias("hash"))
        for level in levels:
            subroots = subroots.unionByName(level.where("n = 1").select("tree", "hash"))
        n_trees = sizes.count()
        top = _built(stage(subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "hash", F.lit(n_trees).cast("bigint").alias("n"))))
        self.nodes = None
        self.trees = n_trees
        parts = ([_linked(levels, n_trees)] if levels else []) + ([_linked(top, n_trees, top=True)] if top else [])
        for part in parts:
            self.nodes = part if self.nodes is None else self.nodes.unionByName(part)
        if self.nodes is not None:
            self.nodes = stage(self.nodes)

    def _starts(self) -> DataFrame:
        """A row per lowest node, with the digests its leaves give; a lone leaf of a source starts as its own subroot."""
        run = F.array_sort(F.collect_list(F.struct("pos", "leaf", "tampered")))
        held = self.leaves.groupBy("tree", "n", F.expr(f"pos div {FAN}").alias("run")).agg(run.alias("held"))
        joined = F.array_join(F.col("held.leaf"), "")
        fold = F.transform("held", lambda x, i: F.sha2(F.concat(F.substr("joined", F.lit(1), i * HEX), x.tampered, F.substr("joined", i * HEX + (HEX + 1))), 256))
        many = held.where("n > 1").withColumn("joined", joined).select("tree", "run", fold.alias("folded"))
        first = self.nodes.where("level = 1 AND tree >= 0").select("tree", F.col("pos").alias("run"), *UP, "slot", "hash", F.when(F.col("is_subroot"), F.col("hash")).alias("subroot"))
        up = [F.lit(TOP).cast("bigint").alias("up_tree"), F.lit(1).cast("bigint").alias("up_level")]
        lone = held.where("n = 1").select("tree", "run", *up, F.expr(f"tree div {FAN}").alias("up_pos"), F.lit(_copies_top(1, self.trees)).cast("bigint").alias("up_copies"), (F.col("tree") % FAN).alias("slot"), F.col("held.leaf")[0].alias("hash"), F.col("held.leaf")[0].alias("subroot"), F.col("held.tampered").alias("folded"))
        return stage(many.join(first, ["tree", "run"]).unionByName(lone))

    def proofs(self) -> DataFrame:
        """Per leaf: doc_id, source, leaf, subroot, root, proof_sha256 (of the siblings from the leaf's to the root's children), the root
        folded from the altered leaf and the original siblings, and whether it is the root."""
        if self.nodes is None:  # no leaf, or one that is the root
            same = self.leaves.select("doc_id", "source", "leaf", F.col("leaf").alias("subroot"), F.col("leaf").alias("root"), F.sha2(F.lit(""), 256).alias("proof_sha256"), F.col("tampered").alias("folded_root"))
            return same.withColumn("verified", F.col("folded_root") == F.col("root"))
        # where there is one source, its subroot is the root, and no step has marked it
        top = climbed(self._starts(), self.nodes).withColumn("subroot", F.coalesce("subroot", "root"))
        family = self.leaves.groupBy("tree", F.expr(f"pos div {FAN}").alias("run")).agg(F.array_sort(F.collect_list(F.struct("pos", "doc_id", "source", "leaf", "n"))).alias("held"))
        met = family.join(top, ["tree", "run"]).withColumn("joined", F.array_join(F.col("held.leaf"), ""))
        rows = met.select("joined", "above", "folded", "root", "subroot", F.posexplode("held").alias("i", "x"))
        beside = F.concat(F.substr("joined", F.lit(1), F.col("i") * HEX), F.substr("joined", F.col("i") * HEX + (HEX + 1)))
        folded = F.col("folded")[F.col("i")]
        return rows.select("x.doc_id", "x.source", "x.leaf", "subroot", "root", F.sha2(F.concat(beside, "above"), 256).alias("proof_sha256"), folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))
