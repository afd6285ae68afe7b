"""What the operators of this subpackage share: reading, durable cuts of lineage, files in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local master may do without the setting; it then gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if d is None:
        d = sc.getCheckpointDir()
    if d is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="loomtext-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


#: Rows and bytes of an Arrow batch while texts are worked on: the session's defaults make batches of many megabytes on both sides.
BATCH_ROWS, BATCH_BYTES = 2048, 4 << 20


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of ``rows`` rows and ``BATCH_BYTES`` bytes at most while an action runs; the session's settings are put back after it."""
    most = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    before = {}
    for name, limit in most.items():
        now = spark.conf.get(name)
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= limit:
            before[name] = now
            spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


#: Tables laid down inside a ``swept`` block.
_LAID: ContextVar[list[DataFrame] | None] = ContextVar("laid", default=None)


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder; later stages outlive the loss of executors."""
    shared_dir(df.sparkSession)
    with small_batches(df.sparkSession):
        out = df.checkpoint(eager=True)
    if (laid := _LAID.get()) is not None:
        laid.append(out)
    return out


def forget(laid: DataFrame) -> None:
    """Delete what ``durable`` laid down, once no result still rests on it."""
    path = laid._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if path.isDefined():
        remove_folder(laid.sparkSession, path.get())


@contextmanager
def swept() -> Iterator[None]:
    """Delete at the end all that was laid down inside the block; for blocks that write their result themselves."""
    mark = _LAID.set([])
    try:
        yield
    finally:
        laid = _LAID.get() or []
        _LAID.reset(mark)
        for df in laid:
            forget(df)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, uri: str) -> None:
    """Delete a folder of the shared store through Spark's file system layer."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """A name for a working column from each of ``names``, none of which is a column of ``df`` in any case form."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = "_" + name.replace(" ", "_").lower()
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def row_key(id_col: str, text_col: str) -> list[Column]:
    """(k0, k1): 128 bits of hash by which a row is known, from its id and text, however the table is split or ordered when it is read again."""
    return [F.xxhash64(F.lit(k), F.col(id_col).isNull(), F.col(id_col), F.col(text_col)).alias(f"k{k}") for k in (0, 1)]


def text_key(text: Column) -> list[Column]:
    """128 bits of hash by which a text is known; a null text has a key of its own."""
    return [F.xxhash64(F.lit(k), text) for k in (0, 1)]


def training_row(doc_id: Column | str = "doc_id") -> Column:
    """True for rows that labels may be learned from: crc32 of the id's decimal text, mod 5, is not 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True where that remainder is 0; false for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))
