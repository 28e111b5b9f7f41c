"""Interpolated Kneser-Ney models of characters, one per class, in sorted arrays that all classes share.

A gram of up to four characters is a 64-bit code, 16 bits per character, the last one lowest; so its context is the code without the
lowest 16 bits and its suffix the code without the highest character. Characters beyond U+FFFF share the codes of surrogates, which no
text holds, and of the private-use characters up to U+F8FF, 125 characters to a code; so they are told from every other letter and from space.

A model has every gram of its documents. Spark counts the grams of all orders and works out their probabilities; they pass through the
driver a partition at a time into files in the shared folder, which workers map.
"""

from __future__ import annotations

import mmap
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack
from functools import cached_property, lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, functions as F

from isobar.llm.hashing import Texts, pieces, sums
from isobar.session import shared_folder, stage

ORDER = 4
BITS = 16
SPACE = 0x20
#: The codes that characters beyond U+FFFF share.
SHARED, SHARED_END = 0xD800, 0xF900
#: Bytes of text handled at a time.
PIECE = 1 << 20
#: Probability of a character of which nothing is known.
UNKNOWN = 2.0**-16


def letters_only(c: str) -> int:
    """Letters in lower case, anything else a space."""
    return ord(c.lower()[0]) if c.isalpha() else SPACE


def any_character(c: str) -> int:
    return ord(c)


def sixteen_bits(points: np.ndarray) -> np.ndarray:
    return np.where(points > 0xFFFF, SHARED + points % (SHARED_END - SHARED), points)


class Alphabet:
    """Maps code points, each asked for once per worker."""

    def __init__(self, rule: Callable[[str], int]):
        self.rule, self.table = rule, np.full(0x110000, -1, np.int32)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.table[points]
        if (found < 0).any():
            for p in np.unique(points[found < 0]).tolist():
                self.table[p] = self.rule(chr(p))
            found = self.table[points]
        return sixteen_bits(found)


def grams(texts: Texts, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """The code of four characters that ends at each character, and per text the number of its first.

    A text begins and ends with a space, runs of spaces are one, and before it there are spaces. A text without other characters has none.
    """
    points = np.frombuffer(texts.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])[texts.offsets]
    chars = alphabet(points)
    # a space before every text and one after it
    edges = np.concatenate([begins[:-1], begins[1:]])
    chars = np.insert(chars, edges, SPACE)
    starts = begins[:-1] + 2 * np.arange(texts.n)
    ends = begins[1:] + 2 * np.arange(texts.n) + 1
    space = chars == SPACE
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[starts] = True
    place = np.cumsum(keep) - 1
    chars = chars[keep].astype(np.uint64)
    first = place[starts]
    at = np.concatenate([first, [len(chars)]])
    length = np.diff(at)
    depth = np.arange(len(chars)) - np.repeat(first, length)
    code = chars.copy()
    for k in range(1, ORDER):
        before = np.full(len(chars), SPACE, np.uint64)
        before[k:] = np.where(depth[k:] >= k, chars[:-k], np.uint64(SPACE))
        code |= before << np.uint64(BITS * k)
    # a text's first space is context only, and a text of nothing else has no characters
    real = np.repeat(length > 2 if len(length) else np.zeros(0, bool), length) & (depth > 0)
    counts = np.where(length > 2, length - 1, 0)
    return code[real], np.concatenate([[0], np.cumsum(counts)])


def count_task(batches: Iterator[pa.RecordBatch], classes: Sequence[str], rule: Callable[[str], int]) -> Iterator[pa.RecordBatch]:
    """Rows (class number, code, n) of one task from the columns ``label`` and ``text``."""
    alphabet, number = Alphabet(rule), {c: i for i, c in enumerate(classes)}
    held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in classes]

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        codes, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return codes, np.bincount(place, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)

    for batch in batches:
        label = np.array([number.get(x, -1) for x in batch.column("label").to_pylist()])
        for row, texts in pieces(batch.column("text"), PIECE):
            codes, at = grams(texts, alphabet)
            of = np.repeat(label[row : row + texts.n], np.diff(at))
            for k in np.unique(of[of >= 0]).tolist():
                held[k].append(np.unique(codes[of == k], return_counts=True))
                if len(held[k]) > 16:
                    held[k] = [merged(held[k])]
    for k, parts in enumerate(held):
        if parts:
            codes, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), k, np.int32)), pa.array(codes.view(np.int64)), pa.array(n)], ["k", "code", "n"])


def counted(docs: DataFrame, task: Callable) -> DataFrame:
    """The counts of all grams of all documents: (k, code, n), k the number of the class."""
    return stage(docs.mapInArrow(task, "k int, code bigint, n bigint").groupBy("k", "code").agg(F.sum("n").alias("n")))


def _mask(order: int) -> int:
    """The bits of ``order`` characters, as a signed number."""
    return (1 << (BITS * order)) - 1 if order < ORDER else -1


class Tables:
    """Log probabilities of grams and log weights of their contexts, per order and class.

    Each table is sorted by code, with a row (code, class, value) per class that has it: that of grams of order o is number o - 1, that of
    their contexts ORDER + o - 1. Codes are in the order of signed numbers.
    """

    classes: int
    tables: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def _rows(self, table: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number in ``codes``, the class and the value of each row of a table that has one of ``codes``."""
        keys, classes, values = self.tables[table]
        begin = np.searchsorted(keys, codes)
        n = np.searchsorted(keys, codes, side="right") - begin
        at = np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)
        return np.repeat(np.arange(len(codes)), n), classes[at], values[at]

    def _logs(self, codes: np.ndarray) -> np.ndarray:
        """Per code of four characters and class the log probability of the last one: of the longest gram known, and for each longer context
        that is known its weight."""
        out = np.full((len(codes), self.classes), np.log(UNKNOWN))
        for order in range(1, ORDER + 1):
            gram = codes & np.uint64(_mask(order) % 2**64)
            row, k, weight = self._rows(ORDER + order - 1, (gram >> np.uint64(BITS)).view(np.int64))
            out[row, k] += weight
            row, k, value = self._rows(order - 1, gram.view(np.int64))
            out[row, k] = value
        return out

    def entropies(self, texts: Texts, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
        """Per text its number of characters and, per class, the mean negative log probability of one."""
        codes, at = grams(texts, alphabet)
        n = np.diff(at)
        different, place = np.unique(codes, return_inverse=True)
        logs, total = self._logs(different), np.zeros((texts.n, self.classes))
        for c in range(self.classes):
            total[:, c] = sums(logs[place, c], at)
        return n, -total / np.maximum(n, 1)[:, None]


class Model(Tables):
    """Tables worked out in memory, for few grams; ``fitted`` does the same in Spark."""

    def __init__(self, k: np.ndarray, codes: np.ndarray, n: np.ndarray, classes: int, least_context: int = 1):
        """A context with fewer than ``least_context`` occurrences in a class is dropped there, and a shorter one used."""
        self.classes = classes
        found: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in range(2 * ORDER)]
        for c in range(classes):
            orders = [(codes[k == c], n[k == c].astype(float))]  # from order 4 down; below the top a gram counts the characters seen before it
            for order in range(ORDER - 1, 0, -1):
                suffix, place = np.unique(orders[-1][0] & np.uint64(_mask(order)), return_inverse=True)
                orders.append((suffix, np.bincount(place, minlength=len(suffix)).astype(float)))
            shorter, lower = np.zeros(1, np.uint64), np.full(1, UNKNOWN)
            for order, (gram, times) in enumerate(reversed(orders), 1):
                once, twice = (times == 1).sum(), (times == 2).sum()
                discount = once / (once + 2 * twice) if once else 0.5
                context, of = np.unique(gram >> np.uint64(BITS), return_inverse=True)
                total, kinds = np.bincount(of, times, len(context)), np.bincount(of, minlength=len(context))
                used = total >= (least_context if order > 1 else 1)
                weight = np.where(used, discount * kinds / np.maximum(total, 1), 1.0)
                by = np.argsort(shorter)
                suffix = by[np.searchsorted(shorter, gram & np.uint64(_mask(order - 1)), sorter=by)] if len(gram) else np.zeros(0, int)
                p = np.where(used[of], np.maximum(times - discount, 0) / total[of], 0) + weight[of] * lower[suffix]
                for table, key, value in ((order - 1, gram, p), (ORDER + order - 1, context, weight)):
                    found[table].append((key.view(np.int64), np.full(len(key), c), np.log(value).astype(np.float32)))
                shorter, lower = gram, p
        joined = [[np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, int), np.zeros(0, np.float32)), *t, strict=True)] for t in found]
        self.tables = [tuple(x[np.argsort(t[0], kind="stable")] for x in t) for t in joined]


#: The files of a model: a row of all tables, one after another, has an item in each.
FILES = {"code": np.dtype(np.int64), "k": np.dtype(np.int32), "value": np.dtype(np.float32)}


@lru_cache(maxsize=1)
def _mapped(root: str) -> dict[str, np.ndarray]:
    """The files of a model. Those that are not in a folder of this machine are first copied to files that have no name."""
    files, top = FileSystem.from_uri(root)
    out = {}
    for name, kind in FILES.items():
        with ExitStack() as held:
            if isinstance(files, LocalFileSystem):
                file = held.enter_context(open(f"{top}/{name}", "rb"))
            else:
                file = held.enter_context(tempfile.TemporaryFile())
                shutil.copyfileobj(held.enter_context(files.open_input_stream(f"{top}/{name}")), file, 1 << 20)
                file.flush()
            size = file.seek(0, 2)
            out[name] = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ) if size else b"", kind)
    return out


class Shared(Tables):
    """Tables in files of the shared folder; table i is rows ``bounds[i]`` to ``bounds[i + 1]``. Only their place is sent to workers."""

    def __init__(self, root: str, bounds: list[int], classes: int, seen: int):
        """``seen``: how many of the classes have any gram."""
        self.root, self.bounds, self.classes, self.seen = root, bounds, classes, seen

    @cached_property
    def tables(self) -> list[tuple[np.ndarray, ...]]:
        files = _mapped(self.root)
        return [tuple(files[name][a:b] for name in FILES) for a, b in zip(self.bounds, self.bounds[1:], strict=False)]

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "tables"}


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch as one row of arrays."""
    kinds = {"part": np.dtype(np.int32), **FILES}
    for batch in batches:
        if batch.num_rows:
            data = [batch.column(c).to_numpy(zero_copy_only=False).astype(kind).tobytes() for c, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in data], list(kinds))


def _shared(rows: DataFrame, classes: int, seen: int) -> Shared:
    """Files of the rows (part, code, k, value), written in order; the driver holds one partition of them at a time."""
    root, count = shared_folder(rows.sparkSession), np.zeros(2 * ORDER, np.int64)
    files, top = FileSystem.from_uri(root)
    files.create_dir(top, recursive=True)
    parts = rows.orderBy("part", "code", "k").mapInArrow(_packed, "part binary, code binary, k binary, value binary")
    with ExitStack() as held:
        out = {name: held.enter_context(files.open_output_stream(f"{top}/{name}")) for name in FILES}
        for r in parts.toLocalIterator():
            count += np.bincount(np.frombuffer(r["part"], np.int32), minlength=2 * ORDER)
            for name, file in out.items():
                file.write(bytes(r[name]))
    return Shared(root, np.concatenate([[0], np.cumsum(count)]).tolist(), classes, seen)


def fitted(docs: DataFrame, task: Callable, classes: int, least_context: int = 1) -> Shared:
    """The model of all grams of all documents. ``least_context`` is as for ``Model``.

    What reaches the driver at once is two numbers per class and order, and a partition of the tables.
    """
    orders = {ORDER: counted(docs, task)}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("code").bitwiseAND(F.lit(_mask(order))).alias("code")
        orders[order] = stage(orders[order + 1].groupBy("k", suffix).agg(F.count(F.lit(1)).alias("n")))

    def often(n: int) -> Column:
        return F.sum((F.col("n") == n).cast("bigint"))

    kinds = [rows.groupBy("k").agg(often(1).alias("once"), often(2).alias("twice")).withColumn("o", F.lit(order)) for order, rows in orders.items()]
    discounts = reduce(DataFrame.unionByName, kinds).withColumn("d", F.when(F.col("once") > 0, F.col("once") / (F.col("once") + 2 * F.col("twice"))).otherwise(0.5))
    discounts = stage(discounts.select("o", "k", "d"))

    lower, tables = None, []
    for order in range(1, ORDER + 1):
        gram = orders[order].withColumn("context", F.shiftrightunsigned("code", BITS))
        around = gram.groupBy("k", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        around = around.where(F.col("total") >= (least_context if order > 1 else 1)).join(discounts.where(F.col("o") == order).drop("o"), "k")
        around = stage(around.withColumn("weight", F.col("d") * F.col("kinds") / F.col("total")))
        known = gram.join(around, ["k", "context"], "left")
        if lower is None:
            known = known.withColumn("lower", F.lit(UNKNOWN))
        else:
            known = known.withColumn("suffix", F.col("code").bitwiseAND(F.lit(_mask(order - 1))))
            known = known.join(lower.select("k", F.col("code").alias("suffix"), F.col("p").alias("lower")), ["k", "suffix"])
        own = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
        p = F.when(F.col("weight").isNull(), F.col("lower")).otherwise(own + F.col("weight") * F.col("lower"))
        lower = stage(known.select("k", "code", p.alias("p")))
        for table, rows, code, value in ((order - 1, lower, "code", "p"), (ORDER + order - 1, around, "context", "weight")):
            tables.append(rows.select(F.lit(table).alias("part"), F.col(code).alias("code"), "k", F.log(value).cast("float").alias("value")))
    seen = discounts.select("k").distinct().count()
    return _shared(reduce(DataFrame.unionByName, tables), classes, seen)
