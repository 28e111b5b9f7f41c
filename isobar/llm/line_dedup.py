"""Remove repeated runs of lines: chunks cut where the content says so, extended over the lines around them.

A line begins a new chunk where the rolling hash of the lines from it on is smaller than that of the line before and not larger than
that of the line after. That depends on nearby lines alone, so insertions elsewhere do not shift the cuts, and it keeps cuts two
lines apart: every chunk of a text with two or more lines has two or more lines. Of the chunks with the same bytes all but the
first are removed.

A passage rarely begins and ends at a cut. So pairs of neighbouring lines are compared as well: pairs that repeat beside a repeated chunk extend
it, and those that touch each other make up passages too short to hold a chunk. No repeated passage of two lines or more is missed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.llm.common import let, trimmed, word_count
from isobar.session import stage

#: Lines under the rolling hash.
WINDOW = 2
#: A line of more words than this is a run by itself.
LONG = 50
KEYS = ("id", "salt")
#: Bits of the filter that keeps documents without a match out of shuffles. It is broadcast, in rows of 16 bytes for 64 bits.
SLOTS = 1 << 25


def rolling(lines: Column, window: int) -> Column:
    """A hash per line, of it and the following ones."""
    hashed = F.transform(lines, lambda line: F.md5(line))
    if window == 1:
        return hashed
    return let(hashed, lambda h: F.transform(h, lambda _, i: F.md5(F.array_join(F.slice(h, i + 1, window), ""))))


def chunk_starts(lines: Column, window: int = WINDOW) -> Column:
    """The numbers, from 0, of the lines that begin a chunk."""

    def cuts(h: Column) -> Column:
        def is_cut(i: Column) -> Column:
            inner = (F.element_at(h, i + 1) < F.element_at(h, i)) & (F.element_at(h, i + 1) <= F.element_at(h, i + 2))
            return (i == 0) | ((i + 1 < F.size(h)) & inner)

        return F.filter(F.sequence(F.lit(0), F.size(h) - 1), is_cut)

    return let(rolling(lines, window), cuts)


def chunk_spans(lines: Column, window: int) -> Column:
    """First line and number of lines of the chunks of two or more lines that hold more than space."""

    def spans(starts: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(starts) - 1),
            lambda k: _span(F.element_at(starts, k), F.element_at(starts, k + 1) - F.element_at(starts, k), True),
        )

    found = let(F.concat(chunk_starts(lines, window), F.array(F.size(lines))), spans)
    return F.filter(found, lambda s: (s["n"] > 1) & F.exists(F.slice(lines, s["start"] + 1, s["n"]), lambda line: trimmed(line) != ""))


def unit_spans(lines: Column) -> Column:
    """The smallest runs that count, as ``chunk_spans``: from a line that holds more than space to the next such line, and a line of
    more than ``LONG`` words. Each longer run is a chain of them."""

    def chain(filled: Column) -> Column:
        after = F.slice(filled, 2, F.greatest(F.size(filled) - 1, F.lit(0)))
        pairs = F.transform(after, lambda i, k: _span(F.get(filled, k), i - F.get(filled, k) + 1, False))
        long = F.filter(filled, lambda i: word_count(F.get(lines, i)) > LONG)
        return F.concat(pairs, F.transform(long, lambda i: _span(i, F.lit(1), False)))

    return let(F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: trimmed(F.get(lines, i)) != ""), chain)


def _span(start: Column, n: Column, whole: bool) -> Column:
    return F.struct(start.alias("start"), n.alias("n"), F.lit(whole).alias("whole"))


def span_text(lines: Column, span: Column) -> Column:
    return F.array_join(F.slice(lines, span["start"] + 1, span["n"]), "\n")


def _slots(rows: DataFrame) -> DataFrame:
    slot = F.pmod(F.xxhash64(*KEYS), F.lit(SLOTS))
    return rows.withColumn("word", F.floor(slot / 64)).withColumn("bit", (slot % 64).cast("int"))


def key_bits(keys: DataFrame) -> DataFrame:
    """One bit per slot of a hash of the documents' keys, in at most ``SLOTS`` / 64 rows whatever the number of documents."""
    return stage(_slots(keys).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))


def may_hold(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """``rows`` with ``hit``: false only for documents that are not among the keys behind ``bits``."""
    met = _slots(rows).join(F.broadcast(bits), "word", "left")
    return met.withColumn("hit", F.coalesce(F.getbit("bits", F.col("bit")) == 1, F.lit(False))).drop("word", "bit", "bits")


def later_copies(rows: DataFrame, spans: Callable[[Column], Column]) -> DataFrame:
    """Key, first line, number of lines and ``whole`` of each span that an earlier place holds too, and that place: ``of``, ``of_salt``
    and ``shift`` to its first line. A copy that overlaps the earliest one is none. Hashes and positions alone are shuffled."""

    def hashed(lines: Column) -> Column:
        def mark(s: Column) -> Column:
            text = span_text(lines, s)
            return F.struct(s["start"].alias("start"), s["n"].alias("n"), s["whole"].alias("whole"), F.xxhash64(text).alias("h"), F.hash(text).alias("g"))

        return F.transform(spans(lines), mark)

    known = rows.where("body IS NOT NULL").select(*KEYS, F.explode(let(F.split("body", "\n"), hashed)).alias("mark"))
    marks = stage(known.select(*KEYS, "mark.*"))
    groups = marks.groupBy("h", "g").agg(F.min(F.struct(*KEYS, "start")).alias("first"), F.count(F.lit(1)).alias("times"))
    places = stage(groups.where("times > 1").select("h", "g", *[F.col(f"first.{c}").alias(to) for c, to in (("id", "of"), ("salt", "of_salt"), ("start", "at"))]))
    apart = (F.col("id") != F.col("of")) | (F.col("salt") != F.col("of_salt")) | (F.col("at") + F.col("n") <= F.col("start"))
    return marks.join(places, ["h", "g"]).where(apart).select(*KEYS, "start", "n", "whole", "of", "of_salt", (F.col("at") - F.col("start")).alias("shift"))


def runs_of(copies: DataFrame) -> DataFrame:
    """The copies of a document, chained into runs where they touch and have the same source at the same distance.

    Copies inside a repeated chunk add nothing and go first; so does a run inside another one at the end. Equal copies, which rows
    equal in id and text bring, are met before the shuffle. The windows follow one document's lines.
    """
    packed = copies.groupBy(*KEYS).agg(F.collect_set(F.struct("start", "n", "whole", "of", "of_salt", "shift")).alias("copies"))
    line = packed.select(*KEYS, F.explode("copies").alias("c")).select(*KEYS, "c.*").withColumn("end", F.col("start") + F.col("n"))
    before = Window.partitionBy(*KEYS).orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.coalesce(F.max(F.when(F.col("whole"), F.col("end"))).over(before), F.lit(0))
    line = line.withColumn("covered", covered).where(F.col("whole") | (F.col("end") > F.col("covered")))

    source = (*KEYS, "of", "of_salt", "shift")
    chain = Window.partitionBy(*source).orderBy("start", "end")
    reach = F.max("end").over(chain.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > F.col("reach"), F.lit(True)).cast("int")
    line = line.withColumn("reach", reach).withColumn("run", F.sum(opens).over(chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = line.groupBy(*source, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))

    outer = Window.partitionBy(*KEYS).orderBy("start", F.desc("end"), "of", "of_salt", "shift").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("outer", F.coalesce(F.max("end").over(outer), F.lit(0))).where(F.col("end") > F.col("outer"))
    return runs.select(*KEYS, "start", (F.col("end") - F.col("start")).alias("n"), "of", "of_salt", (F.col("start") + F.col("shift")).alias("at"))


def repeated(rows: DataFrame, spans: Callable[[Column], Column]) -> DataFrame:
    """Per document (id, salt) the runs of ``spans`` that repeat, in order: first line, number of lines, and the bytes at the source.

    The bytes of a source are cut once from its document, of which the others stay where they are, and sent to each repetition. A span that very
    many documents share is counted before its rows are shuffled; its repetitions meet it in joins of two scans, which adaptive execution splits.
    """
    runs = stage(runs_of(later_copies(rows, spans)))
    wanted = runs.select(F.col("of").alias("id"), F.col("of_salt").alias("salt"), F.struct("at", "n").alias("piece"))
    wanted = stage(wanted.groupBy(*KEYS).agg(F.collect_set("piece").alias("pieces")))

    def texts(lines: Column) -> Column:
        def text(p: Column) -> Column:
            return F.struct(p["at"].alias("at"), p["n"].alias("n"), F.array_join(F.slice(lines, p["at"] + 1, p["n"]), "\n").alias("chunk"))

        return F.transform("pieces", text)

    sources = may_hold(rows, key_bits(wanted.select(*KEYS))).where("hit").join(wanted, list(KEYS))
    found = sources.select(F.col("id").alias("of"), F.col("salt").alias("of_salt"), F.explode(let(F.split("body", "\n"), texts)).alias("p")).select("of", "of_salt", "p.*")
    place = ["of", "of_salt", "at", "n"]
    sent = runs.join(stage(found.groupBy(*place).agg(F.min("chunk").alias("chunk"))), place)
    return sent.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("start", "n", "chunk"))).alias("repeats"))


def merged(spans: Column) -> Column:
    """The lines of ``spans``, of which both begins and ends ascend, as spans that do not overlap."""

    def ends(s: Column) -> Column:
        def end(x: Column) -> Column:
            return x["start"] + x["n"]

        begin = F.filter(s, lambda x, k: (k == 0) | (x["start"] >= end(F.get(s, k - 1))))
        last = F.filter(s, lambda x, k: (k == F.size(s) - 1) | (F.get(s, k + 1)["start"] >= end(x)))
        return F.zip_with(begin, last, lambda b, e: F.struct(b["start"].alias("start"), (end(e) - b["start"]).alias("n")))

    return let(spans, ends)


def without(lines: Column, spans: Column) -> Column:
    """``lines`` without the lines of ``spans``, which are in order and do not overlap."""

    def gaps(s: Column) -> Column:
        def gap(k: Column) -> Column:
            begin = F.when(k == 0, 0).otherwise(F.get(s, k - 1)["start"] + F.get(s, k - 1)["n"])
            end = F.when(k == F.size(s), F.size(lines)).otherwise(F.get(s, k)["start"])
            return F.slice(lines, begin + 1, end - begin)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(s)), gap))

    return let(spans, gaps)


def dedup_lines(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``row`` (all their columns, packed), the text that stays, n_lines and n_removed.

    A chunk is removed where a document earlier by id, or an earlier place of the same document that does not overlap, holds the same
    bytes. So is every other run of lines that stands at such a place: two neighbouring lines that hold more than space, with the blank ones
    between them, or one line of more than ``LONG`` words. Each line that is removed stays somewhere; where two runs overlap, their
    copies that stay may lie in different documents. A run whose bytes differ from its source's, which takes equal hashes, stays.

    Chunks of white space are left alone. A NULL text stays NULL with 0 lines, an empty one has one line. Rows equal in id
    and text count as one document and are treated alike; a NULL id counts as the smallest. ``id_column`` and ``text_column`` are
    read, other columns pass through whatever their names. An empty table gives no rows.
    """
    return _cut(docs, lambda lines: F.concat(chunk_spans(lines, window), unit_spans(lines)), id_column, text_column)


def dedup_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """As ``dedup_lines``, without chunks: blank lines go inside a run only."""
    return _cut(docs, unit_spans, id_column, text_column)


def _cut(docs: DataFrame, spans: Callable[[Column], Column], id_column: str, text_column: str) -> DataFrame:
    """``docs`` without the later copies of ``spans``. Documents without one are not shuffled."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    body = F.col("row")[text_column]
    known = F.coalesce(F.col("row")[id_column].cast("bigint"), F.lit(-(2**63)).cast("bigint"))
    salt = F.coalesce(F.conv(F.substring(F.md5(body), 1, 15), 16, 10).cast("bigint"), F.lit(-1).cast("bigint"))
    rows = rows.select(known.alias("id"), salt.alias("salt"), body.alias("body"), "row")
    repeats = stage(repeated(rows.drop("row"), spans))
    sieved = may_hold(rows.drop("body"), key_bits(repeats.select(*KEYS)))
    joined = sieved.where("hit").join(repeats, list(KEYS), "left").select("row", "repeats")
    joined = joined.unionByName(sieved.where("NOT hit").select("row", F.lit(None).cast(repeats.schema["repeats"].dataType).alias("repeats")))

    def verified(lines: Column) -> Column:
        same = F.filter(F.col("repeats"), lambda r: span_text(lines, r) == r["chunk"])
        return F.struct(lines.alias("lines"), merged(F.transform(same, lambda r: F.struct(r["start"].alias("start"), r["n"].alias("n")))).alias("spans"))

    checked = joined.select("row", F.when(F.col("repeats").isNotNull(), let(F.split(body, "\n"), verified)).alias("cut"))
    left = let(F.col("cut"), lambda c: F.array_join(without(c["lines"], c["spans"]), "\n"))
    removed = F.aggregate("cut.spans", F.lit(0), lambda total, s: total + s["n"])
    return checked.select(
        "row",
        F.when(F.col("cut").isNotNull(), left).otherwise(body).alias("kept_text"),
        F.coalesce(F.size(F.split(body, "\n")), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("bigint").alias("n_removed"),
    )
