"""Session defaults and table loading shared by the library, the bench and the tests."""

from __future__ import annotations

import heapq
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings that hold at any size; sizes of partitions are left to the cluster and to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app: str = "loomtext", cores: int | str | None = None, **more: str) -> SparkSession:
    """A single-JVM session for tests and benches."""
    n = str(cores or os.cpu_count() or 8)
    conf = DEFAULTS | {"spark.sql.shuffle.partitions": n, "spark.driver.memory": "8g"} | more
    s = SparkSession.builder.master(f"local[{n}]").appName(app).config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``, read by Spark alone so that any store will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of a partition that rows are dealt to, at most about so many.
DEALT_ROWS = 20_000


def longest(rows: list[int], cores: int) -> int:
    """Rows that the busiest of ``cores`` works off if each split goes to whoever has the least, the largest first."""
    busy = [0] * cores
    for n in sorted(rows, reverse=True):
        heapq.heapreplace(busy, busy[0] + n)
    return max(busy)


def spread(df: DataFrame) -> DataFrame:
    """``df``, its rows dealt anew if its splits keep some core busy for a quarter longer than an even share; else as it is.

    What counts is the rows of each split, not the number of splits: a Parquet row group lies in one split, and the others that its file is cut into are empty.
    Counting reads no column.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("k")).count().collect()]  # a row for each split
    total = sum(rows)
    return df.repartition(n * max(1, -(-total // (n * DEALT_ROWS)))) if total and 4 * n * longest(rows, n) > 5 * total else df
