"""Benchmark decontamination with DataFrame functions alone.

A document is held against a benchmark item in windows of as many words as the item has. A window and an item are compared by

1. SimHash: 64-bit fingerprints of their five-word shingles. A shingle that occurs c times votes c times, by a hash of its own for each
   occurrence, so fingerprints of weighted sets lie as near as those of sets of equal similarity;
2. a multi-index of ``radius + 1`` blocks of those bits over all items of the window's size: two fingerprints within ``radius`` differ in at most ``radius``
   blocks, so they agree in one whole block, and an equi-join on the blocks finds every pair within the radius;
3. the exact weighted similarity of their shingles: sum of the lesser counts over sum of the greater counts.

Not every window is made: with ``m`` and ``a`` shingles and similarity ``t``, window and item have at least ``t (a + m) / (1 + t)`` in common, so
a start is left out if no item of that size has so many of its shingles there. That is found by one join of the documents' shingles with the
benchmark's and loses nothing; which of the items of its size a window matches is for the index to say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

#: Sizes up to which a side is broadcast, checked by a count first; beyond them the join shuffles.
BROADCAST_SHINGLES, BROADCAST_DOCS, BROADCAST_ITEMS = 1_000_000, 200_000, 50_000


def normal_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", -1), lambda w: w != "")


def shingle_hashes(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words; none if there are fewer words."""
    n = F.size(words) - width
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))).otherwise(F.array().cast("array<long>"))


def fingerprint(hashes: Column, wide: bool = False) -> Column:
    """64 bits; bit b is 1 if over half of the hashes, repeats included, have it.

    Bits are counted in lanes of a long, four of 16 bits or, if ``wide``, two of 32: no lane overflows below 65,536 hashes.
    """
    lane = 32 if wide else 16
    mask = sum(1 << k for k in range(0, 64, lane))
    zero = F.struct(*[F.lit(0).cast("long").alias(f"c{j}") for j in range(lane)])
    counts = F.aggregate(hashes, zero, lambda s, h: F.struct(*[(s[f"c{j}"] + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(mask).cast("long"))).alias(f"c{j}") for j in range(lane)]))
    n = F.size(hashes).cast("long")
    whole = F.struct(counts.alias("c"), n.alias("n"))

    # the counts are computed once, as the only element of an array
    def majority(x: Column) -> Column:
        out = F.lit(0).cast("long")
        for b in range(64):
            count = F.shiftrightunsigned(x["c"][f"c{b % lane}"], lane * (b // lane)).bitwiseAND(F.lit((1 << lane) - 1).cast("long"))
            out = out.bitwiseOR(F.when(count * 2 > x["n"], F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
        return out

    return F.get(F.transform(F.array(whole), majority), F.lit(0))


def votes(hashes: Column) -> Column:
    """The hashes, with every occurrence after a hash's first as a hash of its own: a weighted set as a plain one."""
    put = F.sort_array(hashes)
    nth = F.transform(put, lambda h, i: F.struct(h.alias("h"), (i + 1 - F.array_position(put, h)).cast("int").alias("n")))
    apart = F.transform(nth, lambda x: F.when(x["n"] == 0, x["h"]).otherwise(F.xxhash64(x["h"], x["n"])))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), hashes).otherwise(apart)


def blocks(fp: Column, radius: int) -> Column:
    """The fingerprint's ``radius + 1`` blocks of near-equal width, as (number, value)."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("value")) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))])


def _maybe_broadcast(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def contaminated(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, radius: int = 24, width: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, mark, item_id, start, n_words, hamming, similarity): each document and item it holds, by its best window.

    ``mark`` is the text's xxhash64, which tells rows of one id apart.

    ``start`` counts the document's normalised words (lower-cased runs of letters and digits) from 0, ``n_words`` is the item's
    length; of equal similarities the earliest window counts. Items of fewer than ``width`` words have shingles of all their words;
    items without words match nothing, null texts hold nothing, a document shorter than an item is one window. Rows that are equal
    in id and text give one result, as do items equal in id and text; a null id stays null. A document that is null, empty or has
    fewer words than the shingles' width can't match. An empty table gives an empty result. Only the columns named are read.

    A window similar at the threshold is found if its fingerprint lies within ``radius``: at similarity 0.8 the expected distance is about 10 of
    64 bits with a deviation of 3, and 12 at most where windows have few shingles, so the default of 24 leaves out one in ten thousand at worst, at the threshold
    itself, and none of exact copies.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), normal_words(F.col(item_text).cast("string")).alias("words")).distinct().where(F.size("words") > 0)
    items = items.withColumns({"k": F.least(F.size("words"), F.lit(width)), "n_words": F.size("words")})
    by_width = F.coalesce(*[F.when(F.col("k") == k, shingle_hashes(F.col("words"), k)) for k in range(1, width + 1)])
    items = durable(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "k", "n_words", by_width.alias("shingles")))
    facts = items.agg(F.collect_set("k").alias("ks"), F.max(F.size("shingles")).alias("most"), F.sum(F.size("shingles")).alias("n")).first()
    empty = F.lit(None)
    out_cols = ["doc_id", "mark", "item_id", "start", "n_words", "hamming", "similarity"]
    if not facts.ks:
        return docs.limit(0).select(F.col(id_col).alias("doc_id"), empty.cast("long").alias("mark"), empty.cast(benchmark.schema[item_col].dataType).alias("item_id"), empty.cast("int").alias("start"), empty.cast("int").alias("n_words"), empty.cast("int").alias("hamming"), empty.cast("double").alias("similarity"))
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    # a row is known by id and text; equal rows are one
    doc_key = ["doc_id", "mark"]
    marked = named.select("doc_id", F.xxhash64("text").alias("mark"), normal_words(F.col("text")).alias("words"))
    wanted = items.select("item", "k", F.size("shingles").alias("m"), F.explode("shingles").alias("h"))
    shared = None
    for k in sorted(facts.ks):
        own = marked.select(*doc_key, shingle_hashes(F.col("words"), k).alias("hs")).select(*doc_key, F.size("hs").alias("n"), F.posexplode_outer("hs").alias("at", "h")).where("at is not null")  # outer: no filter on ``hs`` is pushed down, where it would be computed again
        mine = wanted.where(F.col("k") == k).select("item", "m", "h").distinct()
        hit = own.join(F.broadcast(mine) if facts.n <= BROADCAST_SHINGLES else mine, "h").select(*doc_key, "n", "at", "item", "m", F.lit(k).alias("k"))
        shared = hit if shared is None else shared.unionAll(hit)
    # the places of an item's shingles in a document; a document holds as many as it has words at most
    places = shared.groupBy(*doc_key, "n", "item", "m", "k").agg(F.sort_array(F.collect_set("at")).alias("ats"))
    size = F.least("m", "n")
    places = places.withColumns({"size": size, "need": F.greatest(F.lit(1), F.ceil(F.lit(threshold) * (F.col("m") + size) / (1 + threshold) - 1e-9)).cast("int")})
    # runs of ``need`` places inside one window, as intervals of starts
    i = F.sequence(F.lit(0), F.size("ats") - F.col("need"))
    ends = F.transform(F.when(F.size("ats") >= F.col("need"), i).otherwise(F.array().cast("array<int>")), lambda j: F.struct(
        F.greatest(F.get("ats", j + F.col("need") - 1) - F.col("size") + 1, F.lit(0)).alias("lo"), F.least(F.get("ats", j), F.col("n") - F.col("size")).alias("hi")))
    starts = F.array_distinct(F.flatten(F.transform(F.filter(ends, lambda e: e["lo"] <= e["hi"]), lambda e: F.sequence(e["lo"], e["hi"]))))
    places = places.select(*doc_key, "k", "m", "size", starts.alias("starts")).where(F.size("starts") > 0)
    # from here on a window is of a size, not of an item
    n_items = items.count()
    marks = durable(items.select("item", "item_id", "k", "n_words", F.size("shingles").alias("m"), fingerprint(votes(F.col("shingles")), facts.most > 65_000).alias("item_fp")))
    few = F.broadcast(marks) if n_items <= BROADCAST_ITEMS else marks
    windows = durable(places.groupBy(*doc_key, "k", "m", "size").agg(F.array_distinct(F.flatten(F.collect_set("starts"))).alias("starts")))
    # the windows' own shingles: their documents are read again
    hit_docs = durable(windows.select(*doc_key).distinct())
    back = marked.join(_maybe_broadcast(hit_docs.withColumnsRenamed({"doc_id": "_d", "mark": "_m"}), BROADCAST_DOCS), (F.col("mark") == F.col("_m")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi").dropDuplicates(doc_key)
    hs = F.coalesce(*[F.when(F.col("k") == k, shingle_hashes(F.col("words"), k)) for k in sorted(facts.ks)])
    w = windows.withColumnsRenamed({"doc_id": "_d", "mark": "_m"}).join(back, (F.col("mark") == F.col("_m")) & F.col("doc_id").eqNullSafe(F.col("_d"))).withColumn("hs", hs)
    cut = F.transform("starts", lambda s: F.struct(s.alias("start"), F.slice("hs", s + 1, F.col("size")).alias("own")))
    w = w.select(*doc_key, "k", "m", F.explode(cut).alias("w")).select(*doc_key, "k", "m", "w.start", "w.own")
    w = durable(w.withColumn("fp", fingerprint(votes(F.col("own")), facts.most > 65_000)))
    near = w.select(*doc_key, "k", "m", "start", "fp", F.explode(blocks(F.col("fp"), radius)).alias("b")).select(*doc_key, "k", "m", "start", "fp", "b.block", "b.value")
    index = marks.select("item", "k", "m", "item_fp", F.explode(blocks(F.col("item_fp"), radius)).alias("b")).select("item", "k", "m", "item_fp", "b.block", "b.value")
    index = F.broadcast(index) if n_items <= BROADCAST_ITEMS // (radius + 1) else index
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    # a pair is taken at the first block in which it agrees
    first = F.array_position(F.transform(blocks(apart, radius), lambda b: b["value"]), F.lit(0).cast("long")) - 1
    near = near.join(index, ["k", "m", "block", "value"]).where((F.bit_count(apart) <= radius) & (F.col("block") == first)).select(*doc_key, "item", "k", "m", "start", F.bit_count(apart).cast("int").alias("hamming"))
    # exact similarity of the candidates
    key = [*doc_key, "item", "start"]
    other = near.withColumnsRenamed({"doc_id": "_d", "mark": "_w", "k": "_k", "m": "_m", "start": "_s"})
    same = (F.col("mark") == F.col("_w")) & (F.col("k") == F.col("_k")) & (F.col("m") == F.col("_m")) & (F.col("start") == F.col("_s"))
    cand = w.join(other, F.col("doc_id").eqNullSafe(F.col("_d")) & same)
    cand = cand.select(*key, "hamming", "own")
    mine = cand.select(*key, "hamming", F.size("own").alias("a"), F.explode("own").alias("h")).groupBy(*key, "hamming", "a", "h").agg(F.count("*").alias("c"))
    theirs = items.select("item", F.size("shingles").alias("m"), F.explode("shingles").alias("h")).groupBy("item", "m", "h").agg(F.count("*").alias("d"))
    theirs = F.broadcast(theirs) if facts.n <= BROADCAST_SHINGLES else theirs
    both = mine.join(theirs, ["item", "h"]).groupBy(*key, "hamming", "a", "m").agg(F.sum(F.least("c", "d")).alias("i"))
    scored = both.withColumn("similarity", F.col("i") / (F.col("a") + F.col("m") - F.col("i"))).where(F.col("similarity") >= threshold)
    best = scored.groupBy(*doc_key, "item").agg(F.max_by(F.struct("start", "hamming", "similarity"), F.struct("similarity", (-F.col("start")).alias("s"))).alias("b"))
    return best.join(few.select("item", "item_id", "n_words"), "item").select("doc_id", "mark", "item_id", "b.start", "n_words", "b.hamming", "b.similarity").select(*out_cols)
