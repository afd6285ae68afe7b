"""Rolling signal gate, page caps and other per-key ordered operators, as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scan import BITS, levels_for


def signal_gate(pages: DataFrame, *, domain: str = "domain", seq: str = "seq", score: str = "score", window: int = 20, least: int = 10, threshold: float = 0.35) -> DataFrame:
    """Rows fetched before their domain is abandoned, with ``page_no`` and the rolling mean ``signal``.

    A domain is abandoned for good once it has ``least`` pages and the mean of its last ``window`` scores is below the threshold; the page that
    brings the mean down is still in.
    """
    order = Window.partitionBy(domain).orderBy(seq)
    d = pages.withColumn("page_no", F.row_number().over(order)).withColumn("signal", F.avg(score).over(order.rowsBetween(1 - window, 0)))
    low = (F.col("page_no") >= least) & (F.col("signal") < threshold)
    return d.withColumn("_stop", F.min(F.when(low, F.col("page_no"))).over(Window.partitionBy(domain))).where(F.col("_stop").isNull() | (F.col("page_no") <= F.col("_stop"))).drop("_stop")


def page_cap(pages: DataFrame, cap: int, *, keys: list[str], seq: str = "seq") -> DataFrame:
    """The first ``cap`` rows by ``seq`` of each key."""
    return pages.withColumn("page_no", F.row_number().over(Window.partitionBy(*keys).orderBy(seq))).where(F.col("page_no") <= cap)


def domain_snapshot(pages: DataFrame, *, domain: str = "domain", seq: str = "seq", score: str = "score", window: int = 20, least: int = 10, threshold: float = 0.35) -> DataFrame:
    """(domain, avg_score of the last ``window`` pages, count, abandoned) over the rows that the gate lets through."""
    d = signal_gate(pages, domain=domain, seq=seq, score=score, window=window, least=least, threshold=threshold)
    last = d.groupBy(domain).agg(F.max_by("signal", "page_no").alias("avg_score"), F.count("*").alias("count"))
    return last.withColumn("abandoned", (F.col("count") >= least) & (F.col("avg_score") < threshold)).select(F.col(domain).alias("domain"), "avg_score", "count", "abandoned")


def latest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in an order."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def source_status(enabled: Column, documents: Column, errors: Column, skipped: Column, limited: Column) -> Column:
    return (
        F.when(~enabled, "DISABLED").when(limited > 0, "RATE_LIMITED").when((documents > 0) & (errors > 0), "PARTIAL").when(documents > 0, "SUCCESS")
        .when(errors > 0, "FAILED").when(skipped > 0, "SKIPPED").otherwise("EMPTY")
    )


def throughput(count: Column, seconds: Column) -> Column:
    return F.when(count.isNull() | (seconds <= 0), None).otherwise(F.round(count / seconds, 3))


def http_buckets(codes: DataFrame, status: str = "status") -> DataFrame:
    s = F.col(status)
    n = lambda a, b: F.sum(F.when(s.between(a, b), 1).otherwise(0)).alias(f"http_{a // 100}xx")
    return codes.agg(n(200, 299), n(400, 499), n(500, 599))


def one_or_many(value: Column, none: str = "unknown") -> Column:
    """An aggregate: the only distinct value, a sorted list of several as text, or ``none``."""
    s = F.sort_array(F.collect_set(value))
    return F.when(F.size(s) == 0, F.lit(none)).otherwise(F.array_join(s, ","))


def stage_counts(before: DataFrame, after: DataFrame, text: str = "text") -> DataFrame:
    """Documents and words in and out of a stage."""
    from ..functions.text import n_words

    count = lambda d, p: d.agg(F.count("*").alias(f"{p}document_count"), F.coalesce(F.sum(n_words(F.col(text))), F.lit(0)).alias(f"{p}word_count"))
    both = count(before, "input_").crossJoin(count(after, ""))  # one row each
    return both.withColumn("removed_count", F.greatest(F.lit(0), F.col("input_document_count") - F.col("document_count")))


def content_fold(rows: DataFrame, source: str, text: str, seq: str, *, bits: int = BITS) -> DataFrame:
    """One order-sensitive hash per source: a Merkle fold of its texts' hashes in order of ``seq``, which differs for each row of a source.

    Ranges of ``2 ** bits`` places are folded into one hash each, ranges of those again, as many levels as the places need: no list is longer than a range is wide.
    """
    edge = rows.agg(F.min(seq).alias("a"), F.max(seq).alias("z")).first()
    h = rows.select(F.col(source).alias("source"), F.col(seq).cast("long").alias("place"), F.sha2(F.col(text), 256).alias("h"))
    fold = lambda: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "h"))), lambda x: x["h"]), ""), 256)
    for _ in range(levels_for(edge.a or 0, edge.z or 0, bits)):
        h = h.groupBy("source", F.call_function("shiftright", "place", F.lit(bits)).alias("above")).agg(fold().alias("h")).withColumnRenamed("above", "place")
    return h.groupBy(F.col("source").alias(source)).agg(fold().alias("content_sha256"))
