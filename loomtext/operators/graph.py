"""Connected components of an edge table, by least labels and pointer jumping, for the similarity graphs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names; a local session may make its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a shared folder")
            d = tempfile.mkdtemp(prefix="loomtext-")
        sc.setCheckpointDir(d)
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, uri: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a few numbers up to which they are broadcast.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """``df``, laid down, to be broadcast if it is small: what it is joined with then stays where it is."""
    df = durable(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once, into the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Edges that a task contracts at a time.
PIECE = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): each node of these edges with the smallest it is connected to by them, that one aside."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = list(range(len(nodes)))
    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
        while up[x] != x:
            up[x] = x = up[up[x]]
        while up[y] != y:
            up[y] = y = up[up[y]]
        if x < y:
            up[y] = x
        else:
            up[x] = y
    root = np.array(up, np.int64)
    while (root[root] != root).any():
        root = root[root]
    own = root != np.arange(len(nodes))
    return nodes[root[own]], nodes[own]


def contracted(edges: DataFrame) -> DataFrame:
    """(a, b): edges that connect what ``edges`` connect; of each piece no more than it has nodes. No exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append([c.to_numpy() for c in batch.columns])
                n += batch.num_rows
            if n and (batch is None or n >= PIECE):
                a, b = forest(*[np.concatenate(x) for x in zip(*held, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                held, n = [], 0

    return edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of (a, b); root is the smallest node reached. Rounds: logarithmic in the longest path."""
    e = durable(contracted(edges.select("a", "b").where("a <> b")).distinct())
    both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = durable(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("n"))
        step = label.join(near, "node").select("node", F.least("root", "n").alias("root"))
        up = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
        after = durable(step.join(up, "root").select("node", F.col("up").alias("root")))
        changed = after.withColumnRenamed("root", "new").join(label, "node").where("new <> root").limit(1).count()
        label = after
        if not changed:
            return label
