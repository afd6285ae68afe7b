"""Reports: data set statistics, stage reports, token totals, progress, source manifests, secrets out of logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Stages by how far they have come; the last that is there speaks for the data set.
STAGES = ["04_weighted", "03_deduped", "02_cleaned", "01_crawled"]
SOURCE_FIELDS = ["kind", "identifier", "revision", "license", "raw_source_sha256", "dataset_group"]


def dataset_stats(files: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """One row: files and bytes of ``files`` (path, length), documents and words of the furthest of ``stages``."""
    size = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    last = next((stages[s] for s in STAGES if s in stages), None)
    if last is None:
        return size.withColumns({"documents": F.lit(0).cast("long"), "words": F.lit(0).cast("long")})
    return size.crossJoin(last.agg(F.count("*").alias("documents"), F.coalesce(F.sum(T.n_words(F.col("text"))), F.lit(0)).alias("words")))  # one row each


def stage_report(counts: DataFrame, seconds: Column, name: str) -> DataFrame:
    """Counts of a stage with its throughput, and all of it as JSON."""
    rate = F.when(seconds > 0, F.round(F.col("document_count") / seconds, 3))
    d = counts.withColumns({"stage": F.lit(name), "docs_per_second": rate})
    return d.withColumn("report", F.to_json(F.struct(*[F.col(c) for c in d.columns])))


def token_total(files: DataFrame) -> DataFrame:
    """Tokens by part of shard files (name, size, dtype); the width comes from the type, not from a habit."""
    width = F.when(F.col("dtype").rlike("4$|32$"), 4).otherwise(2)
    return files.withColumn("tokens", F.expr("size") / width).groupBy(F.regexp_extract("name", "^([a-z]+)", 1).alias("part")).agg(F.sum(F.floor("tokens")).alias("tokens"))


def progress(steps: DataFrame) -> DataFrame:
    """``percent`` and ``eta_seconds`` of runs (step, total_steps, elapsed_seconds); no step yet, no estimate."""
    s, n = F.col("step"), F.col("total_steps")
    share = F.when(n > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), s / n)))
    return steps.withColumns({"percent": F.round(share * 100, 2), "eta_seconds": F.when(s > 0, F.round(F.col("elapsed_seconds") * F.greatest(n - s, F.lit(0)) / s, 3))})


def source_manifest(docs: DataFrame) -> DataFrame:
    """One row per (kind, identifier, group), the first by ``seq``: what a corpus came from."""
    key = ["kind", "identifier", "dataset_group"]
    return docs.groupBy(*key).agg(*[F.min_by(c, "seq").alias(c) for c in ("revision", "license", "raw_source_sha256")]).select(*SOURCE_FIELDS)


def manifest_faults(sources: DataFrame, group: str) -> DataFrame:
    """(kind, identifier, fault) of manifest entries: missing fields, another group, a hash that is none."""
    missing = [F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(f"missing {c}")) for c in SOURCE_FIELDS]
    other = F.when(~F.col("dataset_group").eqNullSafe(F.lit(group)), F.lit("wrong group"))
    bad = F.when(~F.coalesce(F.col("raw_source_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), F.lit("bad hash"))
    return sources.select("kind", "identifier", F.explode(F.array_compact(F.array(*missing, other, bad))).alias("fault"))


def without_secrets(text: Column, secrets: list[str]) -> Column:
    """Each secret replaced by [REDACTED], the longest first; empty ones are ignored."""
    return reduce(lambda t, s: F.replace(t, F.lit(s), F.lit("[REDACTED]")), sorted((s for s in secrets if s), key=len, reverse=True), text)


def json_number(value: Column) -> Column:
    """A JSON scalar as a number: truth values count as 1 and 0, what is no number is null."""
    return F.coalesce(value.try_cast("double"), F.when(F.lower(F.trim(value)) == "true", 1.0).when(F.lower(F.trim(value)) == "false", 0.0))


def json_text(value: Column) -> Column:
    """A value as JSON text, nulls kept; a null value is the text null."""
    return F.coalesce(F.to_json(value, {"ignoreNullFields": "false"}), F.lit("null"))


def json_bool(value: Column) -> Column:
    """Truth of a JSON scalar as text: 'true' or a number other than 0."""
    return F.coalesce((F.lower(F.trim(value)) == "true") | F.coalesce(value.try_cast("double") != 0, F.lit(False)), F.lit(False))
