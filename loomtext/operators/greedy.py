"""Greedy representatives for groups of any size.

Rows come in order of ``seq``. A row that is similar enough to a slot's representative takes that slot if it is strictly heavier and goes otherwise; a row similar to none founds a
slot. Rows that are never similar don't touch, so the components of the similarity graph are worked off side by side, and each in blocks of its rows: one
task holds a block, and of the representatives so far those that are similar to one of its rows. What is carried from block to block, and in a stream from batch to batch, is
the table of representatives.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import components, durable, small

#: Rows of one group that one task works off at a time.
BLOCK_ROWS = 20_000

#: Replay of one block: (seq, weight, class) of its rows in order, (founder, seq, weight, class) of the slots so far, the classes' values; gives (slot, seq) of all slots.
Replay = Callable[[np.ndarray, np.ndarray, np.ndarray, list[list], dict[int, np.ndarray]], list[list]]


def replay_sets(threshold: float) -> Replay:
    """Slots in the order they were founded; a row meets the first that is similar enough by Jaccard. Values are ascending hashes."""

    def prefix(g: np.ndarray) -> list[int]:
        return g[: len(g) - int(np.ceil(threshold * len(g) - 1e-9)) + 1].tolist()

    def run(seq: np.ndarray, weight: np.ndarray, cls: np.ndarray, slots: list[list], values: dict[int, np.ndarray]) -> list[list]:
        index: dict[int, set[int]] = {}
        known: dict[tuple[int, int], bool] = {}

        def hold(k: int, c: int) -> None:
            for g in prefix(values[c]):
                index.setdefault(g, set()).add(k)

        def similar(c: int, d: int) -> bool:
            if c == d:
                return True
            if (c, d) not in known:
                both = len(np.intersect1d(values[c], values[d], assume_unique=True))
                known[c, d] = both / (len(values[c]) + len(values[d]) - both) >= threshold - 1e-12
            return known[c, d]

        for k, s in enumerate(slots):
            hold(k, s[3])
        for i in range(len(seq)):
            c = int(cls[i])
            may = set().union(*[index.get(g, ()) for g in prefix(values[c])])
            for k in sorted(may):
                if similar(c, slots[k][3]):
                    if weight[i] > slots[k][2]:
                        for g in prefix(values[slots[k][3]]):
                            index[g].discard(k)
                        slots[k][1:] = [int(seq[i]), float(weight[i]), c]
                        hold(k, c)
                    break
            else:
                slots.append([int(seq[i]), int(seq[i]), float(weight[i]), c])
                hold(len(slots) - 1, c)
        return slots

    return run


def replay_vectors(threshold: float, slack: float) -> Replay:
    """A row meets the most similar slot, of equally similar ones the first. Values are unit vectors."""

    def run(seq: np.ndarray, weight: np.ndarray, cls: np.ndarray, slots: list[list], values: dict[int, np.ndarray]) -> list[list]:
        d = len(next(iter(values.values())))
        held = np.zeros((len(slots) + len(seq), d))
        for k, s in enumerate(slots):
            held[k] = values[s[3]]
        for i in range(len(seq)):
            v = values[int(cls[i])]
            if slots:
                s = held[: len(slots)] @ v
                k = int(np.argmax(s >= s.max() - 1e-12))
                if s[k] >= threshold - slack:
                    if weight[i] > slots[k][2]:
                        slots[k][1:] = [int(seq[i]), float(weight[i]), int(cls[i])]
                        held[k] = v
                    continue
            held[len(slots)] = v
            slots.append([int(seq[i]), int(seq[i]), float(weight[i]), int(cls[i])])
        return slots

    return run


def representatives(rows: DataFrame, values: DataFrame, pairs: DataFrame, replay: Replay, *, before: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(slot, seq, weight, cls): the representatives after ``rows``; ``slot`` is the seq of the row that founded it.

    ``rows``: seq, weight, cls, where rows of one class have equal values; ``values``: cls, value; ``pairs``: (a, b), the pairs of different classes that are similar enough, at least one of the
    two a class of ``rows``; ``before``: the representatives so far, all earlier than ``rows``. Copies need no pairs of their own. A task holds ``block_rows`` rows of one component and the
    representatives similar to them.
    """
    rows = durable(rows.select("seq", F.col("weight").cast("double").alias("weight"), "cls"))
    shape = "slot long, seq long, weight double, cls long"
    before = rows.sparkSession.createDataFrame([], shape) if before is None else before.select("slot", "seq", "weight", "cls")
    pairs = durable(pairs.select("a", "b"))
    both = durable(pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    comp = components(pairs)
    every = durable(rows.select("cls", F.lit(1).alias("n")).unionAll(before.select("cls", F.lit(1).alias("n"))).groupBy("cls").agg(F.sum("n").alias("n")))
    # a class of one row without a pair is its own slot
    root = durable(every.join(comp, F.col("cls") == F.col("node"), "left").where(F.col("root").isNotNull() | (F.col("n") > 1)).select("cls", F.coalesce("root", "cls").alias("root")))
    single = rows.join(root, "cls", "left_anti").select(F.col("seq").alias("slot"), "seq", "weight", "cls")
    touched_never = before.join(root, "cls", "left_anti")
    place = F.row_number().over(Window.partitionBy("root").orderBy("seq")) - 1
    inside = rows.join(root, "cls")
    large = inside.groupBy("root").count().where(F.col("count") > block_rows).select("root")
    if large.limit(1).count():  # only components of more than one block are numbered
        numbered = inside.join(large, "root", "left_semi").withColumn("block", F.floor(place / block_rows).cast("int"))
        inside = inside.join(large, "root", "left_anti").withColumn("block", F.lit(0)).unionByName(numbered)
    else:
        inside = inside.withColumn("block", F.lit(0))
    inside = durable(inside)
    last = inside.agg(F.max("block").alias("b")).first().b
    held = before.join(root, "cls")
    for block in range(-1 if last is None else last + 1):
        now = inside.where(F.col("block") == block)
        # the rows of one block are few: pairs, values and slots are not exchanged for them
        classes = small(now.select("cls", "root").distinct())
        near = classes.unionAll(both.join(classes, F.col("a") == F.col("cls")).select(F.col("b").alias("cls"), "root")).distinct()  # the classes a block's rows may meet
        met = durable(held.join(small(near.select("cls").distinct()), "cls", "left_semi").select("root", "slot", "seq", "weight", "cls"))
        work = now.select("root", F.lit(None).cast("long").alias("slot"), "seq", "weight", "cls").unionAll(met)
        needed = values.join(small(work.select("root", "cls").distinct()), "cls").select("root", F.col("cls").alias("cls"), "value")

        def run(t: pa.Table, v: pa.Table) -> pa.Table:
            t = t.sort_by([("slot", "ascending"), ("seq", "ascending")])  # slots first, as they were founded; null slots, which are rows, last
            seq, weight, cls = [t.column(c).to_numpy() for c in ("seq", "weight", "cls")]
            n = t.num_rows - t.column("slot").null_count
            slot = t.column("slot").slice(0, n).to_numpy()
            slots = [[int(slot[k]), int(seq[k]), float(weight[k]), int(cls[k])] for k in range(n)]
            by = dict(zip(v.column("cls").to_pylist(), [x.values.to_numpy(zero_copy_only=False) for x in v.column("value")], strict=True))
            out = replay(seq[n:], weight[n:], cls[n:], slots, by)
            return pa.table({"root": pa.array([t.column("root")[0].as_py()] * len(out), pa.int64())} | {name: pa.array([s[k] for s in out], kind) for k, (name, kind) in enumerate((("slot", pa.int64()), ("seq", pa.int64()), ("weight", pa.float64()), ("cls", pa.int64())))})

        work = work.select(*[F.col(c).alias(c) for c in work.columns])
        made = work.groupBy("root").cogroup(needed.groupBy("root")).applyInArrow(run, "root long, slot long, seq long, weight double, cls long")
        rest = held.join(met.select("slot"), "slot", "left_anti")
        held = durable(rest.select("root", "slot", "seq", "weight", "cls").unionAll(made))
    return single.unionAll(touched_never.select("slot", "seq", "weight", "cls")).unionAll(held.select("slot", "seq", "weight", "cls"))
