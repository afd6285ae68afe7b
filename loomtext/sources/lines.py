"""Lines of text files with their numbers in the file, however the files are split."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _splits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    meta = lambda c: F.col(f"_metadata.{c}")
    d = spark.read.text(path).select("value", meta("file_path").alias("file"), meta("file_block_start").alias("block"))
    return d.withColumn("split", F.xxhash64("file", "block"))


def numbered_where(spark: SparkSession, path: str | list[str], reason: Column) -> DataFrame:
    """(file, line, reason, text): the lines of ``path`` for which ``reason``, an expression of ``value``, isn't null; line numbers count from 1.

    A line's number is its place in its split, counted as the split is read, and the lines of the file's earlier splits, from counts a split. Only the
    lines asked for leave the task that reads them.
    """
    d = _splits(spark, path)
    counts = d.groupBy("split", "file", "block").agg(F.count("*").alias("n"))
    before = counts.select(F.col("split").alias("s"), "file", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, 0
        for batch in batches:
            split = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(split[1:] != split[:-1]) + 1, [len(split)]]) if len(split) else np.zeros(1, np.int64)
            at = np.zeros(len(split), np.int64)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if split[a] != now:
                    now, seen = split[a], 0
                at[a:b] = seen + 1 + np.arange(b - a)
                seen += b - a
            asked = pa.array(np.flatnonzero(np.asarray(batch.column(1).is_valid())))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(asked), pa.array(at).take(asked), batch.column(1).take(asked), batch.column(2).take(asked)], names=["split", "at", "reason", "text"])

    marked = d.withColumn("reason", reason).select("split", "reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("text"))
    found = marked.mapInArrow(place, "split long, at long, reason string, text string")
    return found.join(before, F.col("split") == F.col("s")).select("file", (F.col("before") + F.col("at")).alias("line"), "reason", "text")


def _record(schema: str) -> Column:
    """A line's record, with ``_bad`` set where a field of it can't be read."""
    return F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})


def accepted_json(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """The records of the lines that can be read whole, whichever of their columns are wanted later."""
    d = spark.read.text(path).select(_record(schema).alias("r")).where(F.col("r").isNotNull() & F.col("r._bad").isNull())
    return d.select("r.*").drop("_bad")


def rejected_json(spark: SparkSession, path: str | list[str], schema: str, *, needs: tuple[str, ...] = ()) -> DataFrame:
    """(file, line, reason, text): JSON lines that can't be read with ``schema`` (``malformed``) or lack a field of ``needs`` (``no <field>``). Blank lines are none."""
    record = _record(schema)
    why = F.when(F.trim("value") == "", None).when(record.isNull() | record["_bad"].isNotNull(), "malformed")
    for name in needs:
        why = why.when(record[name].isNull(), f"no {name}")
    return numbered_where(spark, path, why)
