"""Corpus contract: which documents a data set accepts and why others are turned away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed, text as T


def gate(text: Column, quality: Column, tags: Column, *, least_words: int = 30, least_quality: float = 0.35) -> Column:
    """Enough words, no exclusion tag, enough quality: in order of cost, and what fails one is not asked the next."""
    return F.when(T.n_words(text) < least_words, False).when(F.size(tags) > 0, False).otherwise(F.coalesce(quality, F.lit(0.0)) >= least_quality)


def identity_complete(source: Column, url: Column, identity: Column) -> Column:
    """Whether a map of identity values names the source's required keys; web rows need a URL."""
    out = F.lit(True)
    for kind, keys in fixed.IDENTITY_KEYS.items():
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.coalesce(F.try_element_at(identity, F.lit(k)) != "", F.lit(False))
        out = F.when(source == kind, whole).otherwise(out)
    return F.when(source == "web", F.coalesce(url != "", F.lit(False))).otherwise(out & identity.isNotNull())


def bind_profiles(profiles: DataFrame, groups: DataFrame, *, profile_id: str = "dataset_id", group_id: str = "group_id") -> DataFrame:
    """Profiles with the group each names (its columns but the key). A profile or group that comes twice, or a profile whose group is missing, fails the read."""
    once = lambda d, key, what: d.withColumn("_n", F.count("*").over(Window.partitionBy(key))).withColumn(key, F.when(F.col("_n") == 1, F.col(key)).otherwise(F.raise_error(F.concat(F.lit(f"{what} occurs more than once: "), F.col(key).cast("string"))))).drop("_n")
    p, g = once(profiles, profile_id, "profile"), once(groups, group_id, "group").withColumn("_there", F.lit(True))
    d = p.join(g, group_id, "left")
    there = F.coalesce(F.col("_there"), F.lit(False))
    return d.withColumn(group_id, F.when(there, F.col(group_id)).otherwise(F.raise_error(F.concat(F.lit("unknown group: "), F.coalesce(F.col(group_id).cast("string"), F.lit("none")))))).drop("_there")


def decide(docs: DataFrame, group: str, exclusions: list[str] | None = None, *, kinds: list[str] = fixed.SOURCE_KINDS) -> DataFrame:
    """Rows with ``reason`` (null: accepted). Precedence: duplicate id, group, source kind, exclusions or quality, identity.

    ``docs``: seq, doc_id, text, url, source, dataset_group, quality_signal, source_identity map<string,string>.
    """
    tags = T.exclusion_tags(F.col("text"), exclusions)
    first = docs.groupBy("doc_id").agg(F.min("seq").alias("_first"))
    d = docs.join(first, "doc_id", "left").withColumn("_tags", tags).withColumn("_again", F.coalesce(F.col("seq") > F.col("_first"), F.lit(False))).drop("_first")
    reason = (
        F.when(F.col("_again"), "duplicate_document_id").when(~F.col("dataset_group").eqNullSafe(F.lit(group)), "dataset_group_mismatch")
        .when(~F.coalesce(F.col("source").isin(kinds), F.lit(False)), "unsupported_source").when(F.size("_tags") > 0, F.array_join("_tags", ","))
        .when(~gate(F.col("text"), F.col("quality_signal"), F.col("_tags")), "quality_gate")
        .when(~identity_complete(F.col("source"), F.col("url"), F.col("source_identity")), "missing_source_identity")
    )
    return d.withColumn("reason", reason).drop("_tags", "_again")


def report(decided: DataFrame) -> DataFrame:
    """One row: rows, accepted, rejected, rights_unknown, reasons as a map. Reasons are tags and fixed names, so the map is small."""
    known = F.coalesce(F.col("license_status").isin(fixed.KNOWN_RIGHTS), F.lit(False))
    by = decided.groupBy(F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"), F.sum((~known).cast("long")).alias("unknown"))
    ok = F.col("reason") == ""
    pairs = F.collect_list(F.when(~ok, F.struct("reason", "n")))
    return by.agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("accepted"), F.coalesce(F.sum(F.when(~ok, F.col("n"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(ok, F.col("unknown"))), F.lit(0)).alias("rights_unknown"), F.map_from_entries(F.sort_array(pairs)).alias("reasons"),
    )
