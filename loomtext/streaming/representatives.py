"""Greedy near-duplicate representatives over a stream of documents.

The representatives so far are a table with an index of their sets' prefixes, one version for each micro-batch. A batch joins the index by its own prefixes
only, is worked off as ``operators.greedy`` does, and its version is put in place by one rename; a batch whose version is there already changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators import dedup, greedy
from ..operators.graph import durable

STATE = "slot long, seq long, weight double, h0 long, h1 long, value array<long>"
INDEX = "cls long, n int, gram long"


def _fs(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@dataclass
class Representatives:
    """The table of representatives in a folder that driver and executors share."""

    folder: str
    threshold: float = 0.92
    keep: int = 2

    def versions(self, spark: SparkSession) -> list[int]:
        """Batches whose versions are whole, ascending; the last ``keep`` are kept."""
        path, fs = _fs(spark, self.folder)
        if not fs.exists(path):
            return []
        return sorted(int(n[1:]) for n in (s.getPath().getName() for s in fs.listStatus(path)) if n.startswith("v") and n[1:].isdigit())

    def _read(self, spark: SparkSession, part: str, schema: str, version: int | None = None) -> DataFrame:
        last = (self.versions(spark) or [None])[-1] if version is None else version
        return spark.createDataFrame([], schema) if last is None else spark.read.schema(schema).parquet(f"{self.folder}/v{last}/{part}")

    def table(self, spark: SparkSession) -> DataFrame:
        """(slot, seq, weight): the rows that are representatives now; ``slot`` is the seq of the row that founded the slot."""
        return self._read(spark, "rows", STATE).select("slot", "seq", "weight")

    def advance(self, batch: DataFrame, batch_id: int, *, seq: str = "seq", text: str = "text", weight: str = "final_weight") -> None:
        """Work off one batch: rows that come after all earlier ones by ``seq``. A batch that has its version, or an earlier one, changes nothing."""
        spark = batch.sparkSession
        done = self.versions(spark)
        if done and batch_id <= done[-1]:
            return
        state, index = self._read(spark, "rows", STATE), self._read(spark, "index", INDEX)
        common = np.sort(np.array([r.gram for r in self._read(spark, "common", "gram long").collect()], np.int64))  # COMMON_GRAMS at most
        rows = batch.select(F.col(seq).cast("long").alias("seq"), F.col(weight).cast("double").alias("weight"), dedup.trigram_hashes(F.col(text)).alias("value"))
        rows = durable(rows.withColumns({f"h{k}": F.xxhash64(F.lit(k), "value") for k in (0, 1)}))
        edge = rows.agg(F.min("seq").alias("a")).first().a
        last = state.agg(F.greatest(F.max("seq"), F.max("slot")).alias("z")).first().z
        if edge is not None and last is not None and edge <= last:
            raise ValueError(f"batch {batch_id} begins at {edge}, but rows up to {last} have been worked off")
        full = rows.where(F.size("value") > 0)
        if not done:
            common = dedup.common_grams(full.select(F.col("seq").alias("cls"), "value"))
        # classes of equal sets are known by their first row among representatives and batch; those without grams stay by themselves
        kept_ = state.where(F.size("value") > 0)
        heads = durable(kept_.select("seq", "h0", "h1").unionByName(full.select("seq", "h0", "h1")).groupBy("h0", "h1").agg(F.min("seq").alias("cls")))
        new = durable(full.join(heads, ["h0", "h1"]).select("seq", "weight", "cls"))
        before = durable(kept_.join(heads, ["h0", "h1"]).select("slot", "seq", "weight", "cls"))
        fresh = full.join(heads.select(F.col("cls").alias("seq")), "seq").select(F.col("seq").alias("cls"), "value")  # classes that the batch begins
        fresh_index = durable(dedup.prefixes(fresh, self.threshold, common))
        held = index.join(before.select("cls").distinct(), "cls", "left_semi")
        values = kept_.join(heads.select(F.col("cls").alias("seq")), "seq").select(F.col("seq").alias("cls"), "value").unionByName(fresh)
        pairs = dedup.pairs_by_prefix(held.unionByName(fresh_index), values, self.threshold, new=new)
        after = greedy.representatives(new, values, pairs, greedy.replay_sets(self.threshold), before=before)
        # a representative's own row has its hashes and set
        own = kept_.select("seq", "h0", "h1", "value").unionByName(full.select("seq", "h0", "h1", "value"))
        empty = state.where(F.size("value") == 0).unionByName(rows.where(F.size("value") == 0).withColumn("slot", F.col("seq")).select("slot", "seq", "weight", "h0", "h1", "value"))
        after = durable(after.select("slot", "seq", "weight").join(own, "seq").select("slot", "seq", "weight", "h0", "h1", "value").unionByName(empty))
        heads_now = durable(after.where(F.size("value") > 0).groupBy("h0", "h1").agg(F.min("seq").alias("cls")).select("cls"))
        known = held.select("cls").unionByName(fresh_index.select("cls")).distinct()
        missing = heads_now.join(known, "cls", "left_anti").join(after.select(F.col("seq").alias("cls"), "value"), "cls")  # classes whose first row is no longer a representative
        index_now = held.unionByName(fresh_index).join(heads_now, "cls", "left_semi").unionByName(dedup.prefixes(missing, self.threshold, common))
        staging = f"{self.folder}/staging-{batch_id}-{uuid.uuid4().hex}"
        after.write.parquet(f"{staging}/rows")
        index_now.write.parquet(f"{staging}/index")
        spark.createDataFrame([(int(g),) for g in common.tolist()], "gram long").write.parquet(f"{staging}/common")
        (src, fs), (dst, _) = _fs(spark, staging), _fs(spark, f"{self.folder}/v{batch_id}")
        if not fs.rename(src, dst):
            raise OSError(f"version {batch_id} could not be put in place")
        for old in self.versions(spark)[: -self.keep]:
            fs.delete(_fs(spark, f"{self.folder}/v{old}")[0], True)


def representatives_stream(docs: DataFrame, state: Representatives, checkpoint: str, **columns: str) -> DataStreamWriter:
    """A writer, ready to start, that works off ``docs`` batch by batch into ``state``. Restarts go on from its last whole version."""
    return docs.writeStream.foreachBatch(lambda batch, k: state.advance(batch, k, **columns)).option("checkpointLocation", checkpoint)
