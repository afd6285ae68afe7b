"""Line dedup over overlapping three-line windows, with DataFrame functions alone.

A text's lines are trimmed; blank lines take no part in windows. Every ``width`` consecutive other lines make a window,
known by 128 bits of hash. Of a window that occurs more than once in the corpus, the first occurrence (by document id,
hash of the row and line) stays; the lines that later occurrences cover are removed, overlapping windows merging into one stretch. Only
window hashes and row keys are shuffled to find repeats; texts meet the list of their own repeats once.

The table is read twice, for the windows and for the texts, and the second reading may be split or ordered in another way than the first.
So rows are known by what they hold: a row's key is 128 bits of hash of its id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, row_key

#: Keys of repeated rows up to which they are broadcast (16 bytes each).
BROADCAST_ROWS = 1_000_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trim(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def _full_lines(text: Column) -> Column:
    return F.filter(F.transform(_lines(text), lambda x: _trim(x)), lambda x: x != "")


def repeated_windows(docs: DataFrame, width: int = 3) -> tuple[DataFrame, DataFrame]:
    """(k0, k1, starts): for each distinct row, by its key, the windows that repeat an earlier one; and (k0, k1) of rows that occur more than once.

    ``docs``: id, text. ``starts`` counts lines that are not blank, from 0. Equal rows count as one here.
    """
    w = docs.select("id", *row_key("id", "text"), _full_lines(F.col("text")).alias("full")).where(F.size("full") >= width)
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("full") - width),
        lambda i: F.struct(*[F.xxhash64(F.lit(k), *[F.get("full", i + j) for j in range(width)]).alias(f"h{k}") for k in (0, 1)]),
    )
    # laid down: numbers alone, read by the counts and by the join; outer, or a filter on the hashes is pushed down and splits the text again for each
    w = durable(w.select("id", "k0", "k1", F.posexplode_outer(hashes).alias("start", "h")).where("start is not null").select("id", "k0", "k1", "start", "h.h0", "h.h1"))
    again = durable(w.where("start = 0").groupBy("k0", "k1").count().where("count > 1").select("k0", "k1"))
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", "k0", "k1", "start")
    twice = w.groupBy("h0", "h1").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = w.join(twice, ["h0", "h1"]).where(place != F.col("first"))  # equal rows are in one place
    return later.groupBy("k0", "k1").agg(F.sort_array(F.collect_set("start")).alias("starts")), again


def _with_copies(rows: DataFrame, again: DataFrame, width: int) -> DataFrame:
    """``rows`` (id, text, k0, k1, starts) where of equal rows all but one lose every window: the first of them has them all."""
    many = again.count()
    if not many:
        return rows
    again = F.broadcast(again) if many <= BROADCAST_ROWS else again
    one = rows.join(again, ["k0", "k1"], "left_anti")
    # equal rows are counted in this reading and dealt out again
    same = rows.join(again, ["k0", "k1"], "left_semi").groupBy("k0", "k1").agg(*[F.first(c).alias(c) for c in ("id", "text", "starts")], F.count("*").alias("n"))
    chunk = F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div 65536"))
    same = same.withColumn("chunk", F.explode(chunk))
    same = same.withColumn("copy", F.explode(F.sequence(F.col("chunk") * 65536, F.least(F.col("n") - 1, F.col("chunk") * 65536 + 65535))))
    every = F.sequence(F.lit(0), F.size(_full_lines(F.col("text"))) - width)
    return one.unionByName(same.withColumn("starts", F.when(F.col("copy") == 0, F.col("starts")).otherwise(every)).select(one.columns))


def line_dedup(docs: DataFrame, *, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as doc_id, text without repeated lines, n_lines, n_removed.

    ``n_lines`` counts all lines of the text (an empty one has one, a null one none); ``n_removed`` those removed. A removed
    stretch takes the blank lines inside it along; other blank lines stay. Rows may become empty but none is dropped. Null
    text stays null. A null id comes before all others; rows of one id come in the order of a hash of their texts, whatever the input's
    order or partitions. Of equal rows all but one lose their windows. Texts of fewer than ``width`` full lines are left alone; lines and texts of any length are
    hashed whole. Other columns are
    not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    lost, again = repeated_windows(rows, width)
    joined = _with_copies(rows.select("id", "text", *row_key("id", "text")).join(lost, ["k0", "k1"], "left"), again, width)
    lines = _lines(F.col("text"))
    # place of each line among the full ones, and the full lines that a later window covers
    full_at = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: _trim(F.get("lines", i)) != "")
    joined = joined.withColumn("lines", lines)
    # a stretch: windows that share a line
    first = F.filter("starts", lambda s, i: (i == 0) | (s - F.get("starts", i - 1) >= width))
    last = F.filter("starts", lambda s, i: (i == F.size("starts") - 1) | (F.get("starts", i + 1) - s >= width))
    spans = F.zip_with(first, last, lambda a, b: F.struct(F.get("full_at", a).alias("a"), F.get("full_at", b + (width - 1)).alias("b")))
    joined = joined.withColumn("full_at", F.when(F.col("starts").isNotNull(), full_at)).withColumn("spans", F.when(F.col("starts").isNotNull(), spans))
    n = F.coalesce(F.size("lines"), F.lit(0))
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(n)
    removed = F.coalesce(F.aggregate("spans", F.lit(0), lambda s, x: s + x["b"] - x["a"] + 1), F.lit(0))
    # what stays: the stretches between spans
    lows = F.concat(F.array(F.lit(0)), F.transform("spans", lambda x: x["b"] + 1))
    highs = F.concat(F.transform("spans", lambda x: x["a"]), F.array(F.size("lines")))
    kept = F.array_join(F.flatten(F.zip_with(lows, highs, lambda a, b: F.slice("lines", a + 1, F.greatest(b - a, F.lit(0))))), "\n")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept)
    return joined.select(F.col("id").alias("doc_id"), text.alias("text"), n.alias("n_lines"), removed.alias("n_removed"))
