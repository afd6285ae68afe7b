"""Connected components: links are contracted part by part, then alternating large-star and small-star steps join the parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import tidy
from .common import durable, forget

#: Links that one task contracts at a time.
PART_LINKS = 200_000


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links (a, b) that are not the smallest they can reach, and for each the smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    parent = np.arange(len(nodes))
    while len(x):
        p, q = parent[x], parent[y]
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up
        apart = parent[x] != parent[y]
        x, y = x[apart], y[apart]
    low = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[low], nodes[parent[low]]


def _contracted(edges: DataFrame, parts: int) -> DataFrame:
    """The links dealt to ``parts`` tasks; of each task's links, every node's link to the smallest node it reaches there."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 2
        for batch in batches:
            both = [np.concatenate([held[k], batch.column(k).to_numpy(zero_copy_only=False)]) for k in (0, 1)]
            held = list(least_reached(*both)) if len(both[0]) > 2 * PART_LINKS else both
        a, b = least_reached(*held)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return (edges.repartition(parts) if parts > 1 else edges.coalesce(1)).mapInArrow(run, "a long, b long")


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (large star) or no-larger (small star) neighbours to the smallest node next to it."""
    if large:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): root is the smallest node that can be reached.

    Rows with a null end and loops are ignored. Each task first contracts its share of the links, ``PART_LINKS`` or so; where one share is all, that is
    the result. Else rounds of stars follow: a round halves the depth of trees at least, so their number is the logarithm of the longest
    shortest path; each is laid down in the shared folder. An empty table gives no rows.
    """
    given = durable(edges.where("a <> b").select("a", "b"))
    parts = max(1, -(-given.count() // PART_LINKS))
    e = durable(_contracted(given, parts))
    forget(given)
    mark = None
    for _ in range(max_rounds if parts > 1 else 0):
        before, e = e, durable(_stars(_stars(e, True), False))
        forget(before)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        if parts > 1:
            raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
