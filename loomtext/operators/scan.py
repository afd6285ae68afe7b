"""Scans in an order that no single task has to hold: running sums by levels, and a rolling gate over runs of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from .graph import durable

#: A level's ranges hold ``2 ** BITS`` places of the level below.
BITS = 12


def _up(name: str, bits: int) -> Column:
    return F.call_function("shiftright", F.col(name), F.lit(bits))


def levels_for(least: int, most: int, bits: int = BITS) -> int:
    """Levels of ranges above places ``least`` to ``most`` until one range's width holds all ranges of the last level."""
    n = 1
    while (most >> (bits * n)) - (least >> (bits * n)) >= 1 << bits:
        n += 1
    return n


def running_sums(df: DataFrame, value: Column, *, part: str, seq: str, name: str = "start", bits: int = BITS, levels: int | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all earlier rows of the same ``part``; ``seq`` is a whole number, different for each row of a part.

    Sums of ranges of ``2 ** bits`` places, sums of ranges of those, and so on: at every level a window holds one range. ``levels`` is read off the
    places if it isn't given.
    """
    if levels is None:
        edge = df.agg(F.min(seq).alias("a"), F.max(seq).alias("z")).first()
        levels = levels_for(edge.a or 0, edge.z or 0, bits)
    d = df.withColumns({"_n": value.cast("long"), "_place": F.col(seq).cast("long"), "_range": _up(seq, bits)})

    def bases(sums: DataFrame, level: int) -> DataFrame:
        """(part, _range, _base) from (part, _range, s)."""
        if level == levels:
            over = Window.partitionBy(part).orderBy("_range")
            return sums.select(part, "_range", (F.sum("s").over(over) - F.col("s")).alias("_base"))
        sums = sums.withColumn("_above", _up("_range", bits))
        above = bases(sums.groupBy(part, F.col("_above").alias("_range")).agg(F.sum("s").alias("s")), level + 1)
        inner = F.sum("s").over(Window.partitionBy(part, "_above").orderBy("_range")) - F.col("s")
        return sums.withColumn("_inner", inner).join(above.select(F.col(part).alias("_part"), F.col("_range").alias("_top"), F.col("_base").alias("_b")), F.col(part).eqNullSafe(F.col("_part")) & (F.col("_above") == F.col("_top"))).select(part, "_range", (F.col("_inner") + F.col("_b")).alias("_base"))

    base = bases(d.groupBy(part, "_range").agg(F.sum("_n").alias("s")), 1).select(F.col(part).alias("_part"), F.col("_range").alias("_r"), "_base")
    inner = F.sum("_n").over(Window.partitionBy(part, "_range").orderBy("_place")) - F.col("_n")
    out = d.withColumn("_in", inner).join(base, F.col(part).eqNullSafe(F.col("_part")) & (F.col("_range") == F.col("_r")))
    return out.withColumn(name, F.col("_base") + F.col("_in")).drop("_n", "_place", "_range", "_in", "_part", "_r", "_base")


def rolling_gate(pages: DataFrame, *, domain: str = "domain", seq: str = "seq", score: str = "score", window: int = 20, least: int = 10, threshold: float = 0.35, rows_per_run: int = 200_000) -> DataFrame:
    """The rows and columns of ``signals.signal_gate``, for domains of any size.

    Rows are dealt by ranges of (domain, seq) into runs. A run tells of its first and its last domain how many rows it has and their last ``window - 1`` scores; what runs before
    it say of its first domain is merged into what it begins with. A domain's stop is the least of its runs' stops, and goes back to its runs.
    A null score counts as a page, but not in a mean. Null domains are one domain, null places come first; rows of one place keep no order of their own.
    """
    runs = max(1, -(-pages.count() // rows_per_run))
    order, tail = [domain, seq], window - 1
    laid = durable(pages.repartitionByRange(runs, *order).sortWithinPartitions(*order)).withColumn("_run", F.spark_partition_id())
    fields = laid.columns
    at_domain, at_score, at_run = fields.index(domain), fields.index(score), fields.index("_run")

    def segments(batch: pa.RecordBatch) -> Iterator[tuple[object, int, int]]:
        """(domain, a, b) of each stretch of one domain."""
        names = batch.column(at_domain).dictionary_encode()
        code = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(code[1:] != code[:-1]) + 1, [len(code)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield names.dictionary[int(code[a])].as_py() if code[a] >= 0 else None, a, b

    def scores(batch: pa.RecordBatch, a: int, b: int) -> np.ndarray:
        return batch.column(at_score).slice(a, b - a).cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: not a number

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, kind, seen = None, None, []  # the first and the last domain: [domain, count, tail]
        for batch in batches:
            for name, a, b in segments(batch) if batch.num_rows else ():
                run, kind = batch.column(at_run)[0].as_py(), batch.column(at_domain).type
                if not seen or seen[-1][0] != name:
                    seen = [*seen[:1], [name, 0, np.zeros(0)]]
                seen[-1][1] += b - a
                seen[-1][2] = np.concatenate([seen[-1][2], scores(batch, a, b)])[-tail:] if tail else np.zeros(0)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([run] * len(seen), pa.int32()), pa.array([s[0] for s in seen], kind), pa.array([s[1] for s in seen], pa.int64()), pa.array([s[2].tolist() for s in seen], pa.list_(pa.float64()))], names=["_run", "_domain", "n", "tail"])

    kind = laid.schema[domain].dataType.simpleString()
    told = durable(laid.mapInArrow(tell, f"_run int, _domain {kind}, n long, tail array<double>"))  # two rows a run
    earlier = Window.partitionBy("_domain").orderBy("_run")
    # every run that has the domain has a row of it, so the last ``tail`` runs hold the last ``tail`` scores
    before = told.select(
        "_run", "_domain", (F.sum("n").over(earlier) - F.col("n")).alias("before"),
        F.flatten(F.collect_list("tail").over(earlier.rowsBetween(-max(tail, 1), -1))).alias("scores"),
    ).where("before > 0")
    carried = before.select(F.col("_run").alias("_r"), F.struct(F.col("_domain").alias("d"), "before", F.slice(F.reverse("scores"), 1, max(tail, 1)).alias("s")).alias("_carry"))
    carried = F.broadcast(carried) if runs <= 100_000 else carried
    started = laid.join(carried, F.col("_run") == F.col("_r"), "left").drop("_r")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, count, last, begun = None, 0, np.zeros(0), False
        for batch in batches:
            if not batch.num_rows:
                continue
            carry = batch.column(len(fields))[0].as_py()
            numbers, signals = [], []
            for d, a, b in segments(batch):
                if not begun or d != name:
                    name, count, last = d, 0, np.zeros(0)
                    if not begun and carry is not None and carry["d"] == d:
                        count, last = carry["before"], np.array(carry["s"][::-1], float)
                    begun = True
                x = np.concatenate([np.full(tail - len(last), np.nan), last, scores(batch, a, b)])
                total, n = np.zeros(b - a), np.zeros(b - a, np.int64)
                for k in range(window):  # oldest first, as a window adds
                    y = x[k : k + b - a]
                    ok = ~np.isnan(y)
                    total, n = total + np.where(ok, y, 0.0), n + ok
                numbers.append(count + 1 + np.arange(b - a))
                signals.append(np.where(n > 0, total / np.maximum(n, 1), np.nan))
                count, last = count + b - a, x[len(x) - tail :]
            signal = np.concatenate(signals)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(fields)], pa.array(np.concatenate(numbers).astype(np.int32)), pa.array(signal, mask=np.isnan(signal))], names=[*fields, "page_no", "signal"])

    schema = StructType([*laid.schema.fields, StructField("page_no", IntegerType()), StructField("signal", DoubleType())])
    done = durable(started.select(*fields, "_carry").mapInArrow(go, schema))
    low = done.where((F.col("page_no") >= least) & (F.col("signal") < threshold))
    stop = low.groupBy(F.col(domain).alias("_d")).agg(F.min("page_no").alias("_stop"))
    held = done.select(F.col(domain).alias("_own"), F.col("_run").alias("_r")).distinct()  # runs and domains
    spread = held.join(stop, F.col("_own").eqNullSafe(F.col("_d"))).select("_d", "_r", "_stop")
    out = done.join(spread, F.col(domain).eqNullSafe(F.col("_d")) & (F.col("_run") == F.col("_r")), "left")
    return out.where(F.col("_stop").isNull() | (F.col("page_no") <= F.col("_stop"))).drop("_run", "_d", "_r", "_stop")
