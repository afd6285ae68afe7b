"""Structured Streaming forms: exact dedup, the rolling signal gate, and windowed counts of events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions import text as T


def exact_dedup(docs: DataFrame, *, text: str = "text", within: tuple[str, str] | None = None) -> DataFrame:
    """The first row of each normalised text. State holds every hash seen; ``within`` = (time column, delay) bounds it."""
    h = docs.withColumn("_h", F.sha2(T.collapse(F.lower(F.col(text))), 256))
    if within:
        return h.withWatermark(*within).dropDuplicatesWithinWatermark(["_h"]).drop("_h")
    return h.dropDuplicates(["_h"]).drop("_h")


class _Gate(StatefulProcessor):
    """Per domain: the last scores, how many pages there were, and whether it has been abandoned."""

    def __init__(self, domain: str, seq: str, score: str, window: int, least: int, threshold: float, ttl_ms: int | None):
        self.domain = domain
        self.seq, self.score, self.window, self.least, self.threshold, self.ttl_ms = seq, score, window, least, threshold, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("gate", "scores array<double>, n long, gone boolean", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        scores, count, gone = self.state.get() if self.state.exists() else ([], 0, False)
        scores, out = list(scores), []
        for r in pd.concat(list(rows)).sort_values(self.seq).itertuples(index=False):
            if gone:
                break
            out.append((key[0], getattr(r, self.seq), getattr(r, self.score)))
            scores, count = [*scores, float(getattr(r, self.score))][-self.window :], count + 1
            gone = bool(count >= self.least and sum(scores) / len(scores) < self.threshold)
        self.state.update((scores, count, gone))
        yield pd.DataFrame(out, columns=[self.domain, self.seq, self.score])

    def close(self) -> None:
        pass


#: ``signal_gate`` keeps its state in this store: set it as spark.sql.streaming.stateStore.providerClass before the stream starts.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def signal_gate(pages: DataFrame, *, domain: str = "domain", seq: str = "seq", score: str = "score", window: int = 20, least: int = 10, threshold: float = 0.35, forget_ms: int | None = None) -> DataFrame:
    """(domain, seq, score) of pages before their domain is abandoned; state per domain: the last ``window`` scores, a count, a flag.

    Rows of one batch are taken in order of ``seq``; batches in order of arrival. A domain without a page for ``forget_ms`` milliseconds of
    processing time is forgotten, and begins anew; without it state stays. Needs the state store ``STATE_STORE``.
    """
    rows = pages.select(F.col(domain).cast("string").alias(domain), F.col(seq).cast("long").alias(seq), F.col(score).cast("double").alias(score))
    kind = StructType([StructField(domain, StringType()), StructField(seq, LongType()), StructField(score, DoubleType())])
    gate = _Gate(domain, seq, score, window, least, threshold, forget_ms)
    return rows.groupBy(domain).transformWithStateInPandas(gate, kind, "Append", "processingTime" if forget_ms else "none")


def event_counts(events: DataFrame, *, ts: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by kind in windows of time; rows later than ``late`` behind the newest are left out."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, width), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def append_metrics(metrics: DataFrame, folder: str, checkpoint: str):
    """Metric lines appended to a table as they come; a writer ready to start."""
    return metrics.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append")
