"""Sharding by histogram sort: exact byte counts below candidate boundaries, refined until every splitter is found.

DataFrame functions alone. The rows' keys (no texts) are laid down once; each round then counts, over all partitions, the
exact bytes and rows in the bins of the intervals that still hold a splitter. A bin is as wide as a power of two, so any 64-bit ids will do, and a round
narrows an interval ``BINS`` times at least by half. At most ``(shards - 1) * BINS`` counts reach the driver. When all splitters are found, the rows are exchanged once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable

#: Bins into which one round cuts an interval at most.
BINS = 512
#: Above every place of a row, and below every key.
END, LEAST = (1 << 63) - 1, -(1 << 63)


@dataclass(frozen=True, order=True)
class Splitter:
    """Rows at or above ``(known, key, at)`` are above the boundary; counts of what is below it. Rows without a key are not ``known``, have key 0 and come first."""

    known: bool
    key: int
    at: int
    size_below: int
    rows_below: int


@dataclass(frozen=True, order=True)
class Interval:
    """Rows of keys ``lo`` to ``hi`` (``key`` is None), or of one key (or none, not ``known``) at the places ``lo`` to ``hi``."""

    known: bool
    key: int | None
    lo: int
    hi: int

    @property
    def first(self) -> tuple[bool, int, int]:
        return (self.known, self.lo, 0) if self.key is None else (self.known, self.key, self.lo)

    @property
    def shift(self) -> int:
        """Bits of a bin's width: the least that make ``BINS`` bins or fewer, bins being aligned."""
        s = 0
        while (self.hi >> s) - (self.lo >> s) >= BINS:
            s += 1
        return s

    def bin(self, j: int) -> tuple[int, int]:
        s = self.shift
        a = (self.lo >> s) + j
        return max(self.lo, a << s), min(self.hi, ((a + 1) << s) - 1)

    def at(self, value: int) -> tuple[bool, int, int]:
        """The boundary just below ``value``."""
        return (self.known, value, 0) if self.key is None else (self.known, self.key, value)

    def after(self, value: int) -> tuple[bool, int, int]:
        """The boundary just above ``value``."""
        return (self.known, value, END) if self.key is None else (self.known, self.key, value + 1)


def _long(x: int) -> Column:
    return F.lit(x).cast("long") if x != LEAST else F.expr("bigint('-9223372036854775808')")


def _at_or_above(x: tuple[bool, int, int]) -> Column:
    """Rows (known, key, at) at or above ``x``."""
    known, key, at = x
    later = (F.col("key") > _long(key)) | ((F.col("key") == _long(key)) & (F.col("at") >= _long(at)))
    return F.col("known") & later if known else F.col("known") | later


def _tree(lows: list, below: Callable[[object], Column]) -> Column:
    """How many of the ascending ``lows`` are at or below a row, as a balanced tree of comparisons; ``below(x)``: x is."""

    def tree(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        m = (a + b) // 2
        return F.when(below(lows[m]), tree(m + 1, b)).otherwise(tree(a, m))

    return tree(0, len(lows))


def _round(keys: DataFrame, intervals: list[Interval]) -> dict[int, dict[int, tuple[int, int]]]:
    """Exact (size, rows) in each bin of each interval; intervals are disjoint and ascending."""
    each = lambda xs, kind="long": F.element_at(F.array(*[_long(x).cast(kind) for x in xs]), F.col("i"))
    placed = keys.withColumn("i", _tree([x.first for x in intervals], _at_or_above)).where("i > 0")
    placed = placed.withColumns({
        "over_keys": each([x.key is None for x in intervals], "boolean"), "shift": each([x.shift for x in intervals], "int"), "lo": each([x.lo >> x.shift for x in intervals]),
        "hi": each([x.hi for x in intervals]), "own": each([x.key or 0 for x in intervals]), "of": each([x.known for x in intervals], "boolean"),
    })
    placed = placed.withColumn("v", F.when(F.col("over_keys"), F.col("key")).otherwise(F.col("at")))
    placed = placed.where((F.col("known") == F.col("of")) & (F.col("v") <= F.col("hi")) & (F.col("over_keys") | (F.col("key") == F.col("own"))))
    bins = placed.groupBy("i", (F.call_function("shiftright", F.col("v"), F.col("shift")) - F.col("lo")).alias("bin"))
    out: dict[int, dict[int, tuple[int, int]]] = {}
    for r in bins.agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect():  # len(intervals) * BINS counts at most
        out.setdefault(r.i - 1, {})[r.bin] = (r.s, r.n)
    return out


def splitters(keys: DataFrame, shards: int, tolerance: int = 0) -> list[Splitter]:
    """``shards - 1`` boundaries over rows (known, key, at, size); (known, key, at) is unique.

    Boundary j lies between rows, where the bytes below it are nearest to ``total * j / shards`` (ties to the lower), or where they are first
    found within ``tolerance`` bytes of that. Rows of one key are told apart by ``at``.
    """
    groups = {r.known: r for r in keys.groupBy("known").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"), F.max("at").alias("at")).collect()}
    if not groups:
        return []
    last = max(r.at for r in groups.values())
    s0, n0 = (groups[False].s, groups[False].n) if False in groups else (0, 0)
    total = s0 + (groups[True].s if True in groups else 0)
    goals = [-(-total * j // shards) for j in range(1, shards)]
    keyed = (Interval(True, None, groups[True].lo, groups[True].hi) if True in groups else None, s0, n0)
    state = [(Interval(False, 0, 0, last), 0, 0) if goal < s0 else keyed for goal in goals]
    done: list[Splitter | None] = [None if x else Splitter(True, LEAST, 0, s, n) for x, s, n in state]
    while open_ := [k for k, d in enumerate(done) if d is None]:
        spans = sorted({state[k][0] for k in open_}, key=lambda x: x.first)
        counts = _round(keys, spans)
        for k in open_:
            span, s, n = state[k]
            bins, goal = counts.get(spans.index(span), {}), goals[k]
            for j in sorted(bins):
                size, rows = bins[j]
                start, end = span.bin(j)
                if abs(goal - s) <= tolerance or s >= goal:
                    done[k] = Splitter(*span.at(start), s, n)
                elif s + size <= goal:
                    s, n = s + size, n + rows
                    continue
                elif rows == 1:  # the boundary goes to the side of the row that is nearer to the goal
                    done[k] = Splitter(*span.at(start), s, n) if 2 * (goal - s) <= size else Splitter(*span.after(end), s + size, n + 1)
                elif start < end:
                    state[k] = (Interval(span.known, span.key, start, end), s, n)
                else:  # rows of one key
                    state[k] = (Interval(span.known, start, 0, last), s, n)
                break
            else:
                done[k] = Splitter(*span.after(span.hi), s, n)
    return [d for d in done if d is not None]


def shard_by_bytes(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 500_000, tolerance: int = 0) -> DataFrame:
    """Every row with size, text_crc32, shard and slot, in ascending id order across and within shards.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 8. Each boundary is the one between rows that is
    nearest to its share of the bytes, so shards differ by about one row's size at most. Ids may be any 64-bit numbers; a null id sorts before all of them. Rows of one id keep
    their input order, so an id that a third of the rows share, or no id, is split like any other. A text of any length is one row, whose bytes may
    make its shard larger than its share. ``slot`` counts from 0 within a shard. Rows are exchanged into ranges of about ``rows_per_range`` rows, one task each (``shards`` at least), whose
    bases come from counts. An empty table gives an empty result. Other columns are not carried; join by (id, slot) or write by shard for that.
    """
    text, known = F.col(text_col).cast("string"), F.col(id_col).isNotNull()
    keys = durable(
        docs.select(
            F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("crc"),
            F.monotonically_increasing_id().alias("at"), known.alias("known"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("key"),
        )
    )
    n = keys.count()
    bounds = splitters(keys.select("known", "key", "at", "size"), shards, tolerance)
    order = ["known", "key", "at"]
    dealt = keys.withColumn("shard", _tree([(b.known, b.key, b.at) for b in bounds], _at_or_above))
    ranges = max(shards, -(-n // rows_per_range))
    laid = durable(dealt.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("id", "size", "crc", "shard"))
    placed = laid.withColumns({"range": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    counts = placed.groupBy("shard", "range").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    base = F.sum("rows").over(Window.partitionBy("shard").orderBy("range")) - F.col("rows")
    bases = counts.select("shard", "range", (base - F.col("first")).alias("base"))  # a row for each range and shard that meet: ranges + shards
    return placed.join(F.broadcast(bases), ["shard", "range"]).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("place") + F.col("base")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
