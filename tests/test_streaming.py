from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomtext.operators import dedup, signals
from loomtext.streaming import gates


def drain(df, name, mode="append", seconds=120):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(seconds)
    q.stop()
    return df.sparkSession.table(name)


def test_dedup_equals_batch(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stream = spark.readStream.schema(docs.schema).option("pathGlobFilter", "documents.parquet").parquet(sf)
    got = drain(gates.exact_dedup(stream), "deduped").count()
    assert got == dedup.first_of(docs.withColumn("seq", F.col("doc_id")), dedup.normal_key(F.col("text"))).count()


@pytest.mark.parametrize("forget_ms", [None, 3_600_000])
def test_gate_equals_batch(spark, tmp_path, forget_ms):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", gates.STATE_STORE)
    r = random.Random(2)
    rows = [(f"d{d}", s, r.random() * (0.5 if d % 2 else 1)) for d in range(6) for s in range(50)]
    kind = "domain string, seq long, score double"
    for a in (0, 25):  # two files, two batches in order
        spark.createDataFrame([x for x in rows if a <= x[1] < a + 25], kind).coalesce(1).write.mode("append").parquet(str(tmp_path))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    got = sorted((x.domain, x.seq) for x in drain(gates.signal_gate(stream, forget_ms=forget_ms), f"gated{forget_ms}", seconds=25 if forget_ms else 120).collect())
    assert got == sorted((x.domain, x.seq) for x in signals.signal_gate(spark.createDataFrame(rows, kind)).collect())


def test_event_windows(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    assert drain(gates.event_counts(stream), "windows").count() > 0
