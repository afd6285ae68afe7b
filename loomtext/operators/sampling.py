"""Weighted resampling, reservoir samples, bounded shuffles and splits, reproducible by seed."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..functions.text import split_bucket

STRATEGIES = ("upsample", "downsample", "both")


def copies(weight: Column, draw: Column, strategy: str) -> Column:
    """How often a row of this weight is taken, given a draw from [0, 1)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown weighting strategy {strategy!r}: expected one of {', '.join(STRATEGIES)}")
    w = F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0))
    whole, part = F.floor(w), w - F.floor(w)
    more = F.when((part > 0) & (draw < part), 1).otherwise(0)
    once = F.when(draw < w, 1).otherwise(0)
    if strategy == "upsample":
        return F.greatest(whole, F.lit(1)) + F.when(w > 1, more).otherwise(0)
    if strategy == "downsample":
        return F.when(w >= 1, 1).otherwise(once)
    return F.when(w < 1, once).otherwise(F.greatest(whole, F.lit(1)) + more)


def hash_draw(seed: int, key: Column) -> Column:
    """A draw from [0, 1) that depends on the seed and the row's key alone: the first four bytes of sha256(seed:key)."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("long") / float(1 << 32)


def resample(docs: DataFrame, strategy: str, *, weight: str = "final_weight", key: str = "doc_id", seed: int = 42) -> DataFrame:
    """Each row as often as its weight says, ``copy`` counting from 0. Draws are hashes of the keys: no order, no shuffle."""
    d = text.once(docs, _w=F.col(weight).cast("double"), _draw=hash_draw(seed, F.col(key)))  # the number of copies names both many times
    n = copies(F.col("_w"), F.col("_draw"), strategy).cast("int")
    return d.withColumn("_n", n).where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n", "_w", "_draw")


def totals(before: DataFrame, after: DataFrame, weight: str = "final_weight") -> DataFrame:
    """One row: documents in and out of a resampling, their mean weight and the expansion; no documents count as one."""
    w = F.coalesce(F.sum(F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))), F.lit(0.0))
    both = before.agg(F.count("*").alias("docs_in"), w.alias("total_weight")).crossJoin(after.agg(F.count("*").alias("docs_out")))  # one row each
    n = F.greatest(F.col("docs_in"), F.lit(1))
    return both.select("docs_in", "docs_out", "total_weight", (F.col("total_weight") / n).alias("avg_weight"), (F.col("docs_out") / n).alias("expansion"))


def resample_in_order(docs: DataFrame, strategy: str, *, weight: str = "final_weight", seq: str = "seq", seed: int = 42) -> DataFrame:
    """As ``resample`` with the draws of one Mersenne Twister, in order of ``seq``: for corpora whose draws fit the driver.

    Which rows take a draw depends on the weight alone, so the n-th such row takes the n-th draw. Rows are counted by ranges of
    ``seq`` first, so the running count needs no single task.
    """
    copies(F.lit(1.0), F.lit(0.0), strategy)
    w = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    takes = {"upsample": (w > 1) & (w > F.floor(w)), "downsample": w < 1, "both": (w < 1) | (w > F.floor(w))}[strategy]
    d = docs.withColumn("_takes", takes.cast("int")).withColumn("_part", F.expr(f"{seq} div 65536"))
    parts = d.groupBy("_part").agg(F.sum("_takes").alias("n")).orderBy("_part").collect()  # a row for 65,536 documents
    rng, draws = random.Random(seed), []
    for p in parts:
        draws.append((p["_part"], [rng.random() for _ in range(p.n)]))
    table = docs.sparkSession.createDataFrame(draws, "_part long, draws array<double>")
    at = F.sum("_takes").over(Window.partitionBy("_part").orderBy(seq)) - 1
    d = d.withColumn("_at", at).join(table, "_part").withColumn("_draw", F.when(F.col("_takes") == 1, F.get("draws", F.col("_at").cast("int"))).otherwise(F.lit(1.0)))
    n = copies(F.col(weight), F.col("_draw"), strategy).cast("int")
    return d.withColumn("_n", n).where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n", "_takes", "_part", "_at", "_draw", "draws")


def reservoir_slots(n: int, k: int, seed: int = 42) -> list[int]:
    """Ordinals that reservoir sampling of ``k`` out of ``n`` rows ends with, then shuffled; depends on n, k and seed alone."""
    rng, slots = random.Random(seed), list(range(min(n, k)))
    for i in range(k, n):
        j = rng.randrange(i + 1)
        if j < k:
            slots[j] = i
    rng.shuffle(slots)
    return slots


def buffer_order(n: int, buffer: int, seed: int = 42) -> list[int]:
    """Ordinals in the order in which a shuffle through a bounded buffer lets ``n`` rows out."""
    rng, held, out = random.Random(seed), [], []
    for i in range(n):
        held.append(i)
        if len(held) >= buffer:
            out.append(held.pop(rng.randrange(len(held))))
    while held:
        out.append(held.pop(rng.randrange(len(held))))
    return out


def ordinals(docs: DataFrame, seq: str, name: str) -> DataFrame:
    """``name``: how many rows come before a row by ``seq``. Ranges of ``seq`` are counted first, then each range is numbered by itself."""
    d = docs.withColumn("_part", F.expr(f"{seq} div 65536"))
    counts = d.groupBy("_part").count()
    base = counts.withColumn("_base", F.sum("count").over(Window.orderBy("_part")) - F.col("count")).select("_part", "_base")  # a row for 65,536 values of seq
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(seq)) - 1
    return d.withColumn("_in", inner).join(base, "_part").withColumn(name, F.col("_base") + F.col("_in")).drop("_part", "_in", "_base")


def _by_ordinal(docs: DataFrame, order: list[int], seq: str, name: str) -> DataFrame:
    numbered = ordinals(docs, seq, "_ordinal")
    places = docs.sparkSession.createDataFrame([(o, i) for i, o in enumerate(order)], f"_ordinal long, {name} int")
    return numbered.join(places, "_ordinal").drop("_ordinal")


def reservoir_sample(docs: DataFrame, k: int, *, seq: str = "seq", seed: int = 42) -> DataFrame:
    """``k`` rows with their ``place``, the sample of a sequential reservoir. The driver holds ``k`` ordinals."""
    return _by_ordinal(docs, reservoir_slots(docs.count(), k, seed), seq, "place")


def hash_sample(docs: DataFrame, k: int, *, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """``k`` rows by the smallest hash of their keys: each task keeps k rows at most."""
    return docs.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(k)


def buffer_shuffle(docs: DataFrame, buffer: int, *, seq: str = "seq", seed: int = 42) -> DataFrame:
    """All rows with their ``place`` after a shuffle through a buffer. The driver holds an ordinal for each row."""
    return _by_ordinal(docs, buffer_order(docs.count(), buffer, seed), seq, "place")


def shard_order(names: list[str], seed: int) -> list[str]:
    out = sorted(names)
    random.Random(seed).shuffle(out)
    return out


def split(docs: DataFrame, fraction: float, *, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """``bucket`` of the key's hash and ``part``: val below the fraction of a million, else train."""
    d = docs.withColumn("bucket", split_bucket(F.col(key), seed))
    return d.withColumn("part", F.when(F.col("bucket") < int(fraction * 1_000_000), "val").otherwise("train"))
