"""Sources: JSON lines, local files, page tables, offline crawl replay, dumps of code hosts, papers, data sets and searches."""

from __future__ import annotations

import hashlib
import ipaddress
import json
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..operators.graph import durable
from . import lines, parsers

DOCUMENT = (
    "doc_id string, url string, source string, text string, title string, language string, content_type string, code_language string, domain string, "
    "domain_weight double, content_type_weight double, quality_score double, final_weight double, stars long, citations long, word_count long, char_count long, "
    "crawl_depth int, flagged boolean, clean_action string, clean_score double, embedding array<float>, dedup_cluster_id string, meta map<string,string>"
)
DEFAULTS = {"language": "en", "content_type": "unknown", "domain_weight": 1.0, "content_type_weight": 1.0, "quality_score": 1.0, "final_weight": 1.0, "stars": 0, "citations": 0, "crawl_depth": 0, "flagged": False, "clean_action": "", "clean_score": 0.0}


def rejected_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, reason, text): the lines that ``read_jsonl`` refuses, or leaves out where it isn't strict."""
    return lines.rejected_json(spark, path, DOCUMENT, needs=("doc_id",))


def read_jsonl(spark: SparkSession, path: str, *, strict: bool = True) -> DataFrame:
    """Documents of JSON-lines files. Unknown keys are dropped, blank lines skipped.

    A malformed line, or one without doc_id, is an error that names its file and line, raised by a first pass over the lines; where ``strict`` is false such lines are left out.
    """
    if strict and (bad := rejected_documents(spark, path).orderBy("file", "line").limit(1).collect()):
        raise ValueError(f"{bad[0].file}, line {bad[0].line}: {bad[0].reason}")
    d = spark.read.schema(DOCUMENT).option("mode", "FAILFAST").json(path) if strict else lines.accepted_json(spark, path, DOCUMENT)
    d = d.where(F.col("doc_id").isNotNull())
    for c in d.columns:
        if c in DEFAULTS:
            d = d.withColumn(c, F.coalesce(c, F.lit(DEFAULTS[c])))
    blank = {c: F.coalesce(F.col(c), F.lit("")) for c in ("url", "source", "text", "title", "code_language", "domain", "dedup_cluster_id")}
    d = d.withColumns(blank)
    w, n = F.coalesce(F.col("word_count"), F.lit(0)), F.coalesce(F.col("char_count"), F.lit(0))
    return d.withColumns({"word_count": F.when(w == 0, T.n_words(F.col("text"))).otherwise(w).cast("long"), "char_count": F.when(n == 0, F.char_length("text")).otherwise(n).cast("long")})


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Metric lines; lines that can't be read are skipped (``lines.rejected_json`` tells which)."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_manifests(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(glob)


def read_yaml(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The list under ``key`` of a small YAML file, one row per entry: index and entry as JSON."""
    raw = "\n".join(r.value for r in spark.read.text(path, wholetext=True).limit(1).collect())
    rows = (yaml.safe_load(raw) or {}).get(key, [])
    return spark.createDataFrame([(i, json.dumps(r, sort_keys=True)) for i, r in enumerate(rows)], "idx int, entry string")


def local_files(spark: SparkSession, roots: list[str], *, extensions: list[str], most_files: int = 10_000, most_bytes: int = 10_000_000) -> DataFrame:
    """Documents of files: sorted by path, of an allowed ending, not empty and not too large, the first of paths that differ in case alone.

    Columns: doc_id (sha256 of url, NUL, the file's hash), url, text, title, content_type, file_sha256, error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    ending = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    meta = files.select("path", "length").where(ending.isin([e.lower() for e in extensions]) & (F.col("length") > 0) & (F.col("length") <= most_bytes))
    first = meta.withColumn("r", F.row_number().over(Window.partitionBy(F.lower("path")).orderBy("path"))).where("r = 1")
    chosen = first.orderBy("path").limit(most_files).select("path")
    d = files.select("path", "content").join(F.broadcast(chosen), "path")  # most_files paths
    return parsed(d.withColumn("file_sha256", F.sha2("content", 256)).withColumn("url", F.col("path"))).withColumn("doc_id", F.sha2(F.concat(F.col("url"), F.lit("\x00"), F.col("file_sha256")), 256))


def ingest(spark: SparkSession, roots: list[str], target: str, *, most_files: int = 10_000, most_bytes: int = 50 << 30) -> DataFrame:
    """Copy all files under ``roots`` to ``target``; a row per file: name, size, sha256. More files or bytes than allowed are an error before any is copied.

    A file's name at the target is its hash and its own name, so equal files meet and different ones don't. Empty files are left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    n = files.select("length").agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    if n.n > most_files or n.b > most_bytes:
        raise ValueError(f"{n.n} files of {n.b} bytes; allowed are {most_files} files and {most_bytes} bytes")

    def copy(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for p in parts:
            rows = []
            for r in p.itertuples():
                raw = bytes(r.content)
                store, path = fs.FileSystem.from_uri(target if "://" in target else f"file://{target}")
                digest = hashlib.sha256(raw).hexdigest()
                name = f"{digest[:16]}-{r.path.rsplit('/', 1)[-1]}"
                store.create_dir(path, recursive=True)
                with store.open_output_stream(f"{path}/{name}") as f:
                    f.write(raw)
                rows.append((name, len(raw), digest))
            yield pd.DataFrame(rows, columns=["name", "size", "sha256"])

    return durable(files.select("path", "content").mapInPandas(copy, "name string, size long, sha256 string"))


def parsed(files: DataFrame) -> DataFrame:
    """Adds text, title, content_type, links and error of ``content`` by the ending of ``url``; unknown kinds give an error, no text."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame([parsers.parse_or_error(bytes(c), u) for c, u in zip(p["content"], p["url"], strict=True)])

    def udf(content: pd.Series, url: pd.Series) -> pd.DataFrame:
        return next(run(iter([pd.DataFrame({"content": content, "url": url})])))

    udf.__annotations__ = {"content": pd.Series, "url": pd.Series, "return": pd.DataFrame}
    out = F.pandas_udf(udf, "text string, title string, content_type string, links array<string>, error string")
    return files.withColumn("_p", out("content", "url")).select("*", "_p.*").drop("_p", "content")


def page_documents(pages: DataFrame, *, seq: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Documents of pages: id by URL, host as domain, title, text without tags, type by URL, else 'html', else by text."""
    t = T.normalise(T.strip_tags(F.col(html)))
    kind = T.classify_url(F.col(url))
    return pages.select(
        F.col(seq).alias("seq"), F.sha2(F.col(url), 256).alias("doc_id"), F.col(url).alias("url"), F.lit("web").alias("source"), T.host(F.col(url)).alias("domain"),
        T.page_title(F.col(html)).alias("title"), t.alias("text"), F.when(kind != "unknown", kind).otherwise("html").alias("content_type"), T.code_language(F.col(url)).alias("code_language"),
    )


def without_fragment(url: Column) -> Column:
    return F.split_part(url, F.lit("#"), F.lit(1))


def allowed(url: Column, allow: list[str] = (), block: list[str] = ()) -> Column:
    """http or https, no local name, no address literal that is not global, not blocked and, if there is a list, allowed."""
    h = F.regexp_replace(F.regexp_replace(T.host(url), "^.*@", ""), ":\\d+$", "")
    local = (h == "") | h.rlike(r"^localhost\.?$|\.(local|localhost|internal)\.?$")
    literal = h.rlike(r"^\[|^[0-9a-fx.]*[0-9]$|^[0-9]+$")  # numbers in any notation, or in brackets
    ok = url.rlike("^https?://") & ~local & F.when(literal, _global_address(h)).otherwise(F.lit(True))
    for p in block:
        ok = ok & ~url.rlike(p)
    if allow:
        any_ = F.lit(False)
        for p in allow:
            any_ = any_ | url.rlike(p)
        ok = ok & any_
    return ok


def _global_address(host: Column) -> Column:
    """Whether an address literal is one that all the world can reach; what is no plain literal is none."""

    def one(x: str | None) -> bool:
        try:
            return ipaddress.ip_address((x or "").strip("[]")).is_global
        except ValueError:
            return False

    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "boolean")(host)


def joined_url(base: Column, link: Column) -> Column:
    """A link as its page means it: absolute ones as they are, others joined to the page's URL; without fragment."""

    def run(b: pd.Series, x: pd.Series) -> pd.Series:
        return pd.Series([None if y is None else urljoin(p or "", y) for p, y in zip(b, x, strict=True)])

    run.__annotations__ = {"b": pd.Series, "x": pd.Series, "return": pd.Series}
    whole = link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:")
    return without_fragment(F.when(whole, link).otherwise(F.pandas_udf(run, "string")(F.when(~whole, base), F.when(~whole, link))))


def replay_crawl(pages: DataFrame, links: DataFrame, seeds: DataFrame | list[str], *, depth: int = 2, domain_cap: int = 50, same_domain: bool = True, allow: list[str] = (), block: list[str] = ()) -> DataFrame:
    """(url, crawl_depth): the pages that a breadth-first crawl from ``seeds`` (URLs, or a table of them) over a table of pages and (url, link) reaches.

    Each depth is one join; relative links are joined to their page; seen URLs are taken out by an anti join. Of a domain the first ``domain_cap`` URLs (by depth,
    then URL) are fetched, and only links of fetched pages are followed. What a site's robots file forbids is given as ``block``.
    """
    spark = pages.sparkSession
    links = links.select("url", joined_url(F.col("url"), F.col("link")).alias("link"))

    def capped(new: DataFrame, seen: DataFrame | None) -> DataFrame:
        d = new.withColumn("_host", T.host(F.col("url"))).withColumn("_n", F.row_number().over(Window.partitionBy("_host").orderBy("url")))
        d = d.where(F.col("_n") <= domain_cap)
        if seen is not None:
            d = d.join(seen.groupBy(T.host(F.col("url")).alias("_host")).agg(F.count("*").alias("_before")), "_host", "left").where(F.col("_n") + F.coalesce("_before", F.lit(0)) <= domain_cap)
        return d.select("url")

    have = pages.select("url").distinct()
    start = seeds if isinstance(seeds, DataFrame) else spark.createDataFrame([(u,) for u in dict.fromkeys(seeds)], "url string")
    frontier = start.select(without_fragment(F.col("url")).alias("url")).where(allowed(F.col("url"), allow, block)).distinct()
    seen = durable(capped(frontier.join(have, "url"), None).withColumn("crawl_depth", F.lit(0)))
    last = seen
    for d in range(1, depth + 1):
        out = links.join(last.select("url"), "url").select(F.col("url").alias("parent"), without_fragment(F.col("link")).alias("url")).where(allowed(F.col("url"), allow, block))
        if same_domain:
            out = out.where(T.host(F.col("parent")) == T.host(F.col("url")))
        new = out.select("url").distinct().join(seen.select("url"), "url", "left_anti").join(have, "url")
        last = durable(capped(new, seen).withColumn("crawl_depth", F.lit(d)))
        seen = seen.unionByName(last)
    return seen


def dataset_rows(rows: DataFrame, *, repo: str, revision: str, split: str, fields: list[str], most: int, seq: str = "row_index", license_field: str | None = None, licenses: list[str] | None = None) -> DataFrame:
    """Documents of a data set's rows, numbered from 0 by ``seq``. The first ``most`` rows are taken before any is filtered; rows without text, or of a licence not allowed, go."""
    d = rows.where(F.col(seq) < most)
    d = d.withColumn("text", T.field_text(fields)).where("text <> ''")
    if license_field:
        lic = F.lower(F.trim(F.col(license_field).cast("string")))
        d = d.withColumn("license", lic).where((F.col("license") != "") & (F.lit(True) if licenses is None else F.col("license").isin([x.strip().lower() for x in licenses])))
    return d.withColumn("doc_id", F.concat_ws(":", F.lit("hf"), F.lit(repo), F.lit(revision), F.lit(split), F.col(seq).cast("string")))


def repositories(dump: DataFrame, *, least_stars: int = 0, most: int = 1000) -> DataFrame:
    """Repositories of a dump (url, stars, spdx, text): one per URL, starred enough, the most starred first."""
    one = dump.withColumn("_r", F.row_number().over(Window.partitionBy("url").orderBy(F.desc("stars")))).where("_r = 1").drop("_r")
    known = ~F.coalesce(F.upper("spdx"), F.lit("")).isin("", "NOASSERTION", "OTHER")
    return one.where(F.col("stars") >= least_stars).withColumn("license_status", F.when(known, "verified").otherwise("unknown")).orderBy(F.desc("stars"), "url").limit(most)


def papers(spark: SparkSession, path: str, *, most: int = 200) -> DataFrame:
    """Papers of an Atom dump: arxiv_id, version, title and text with white space collapsed; the ``most`` last by id, one a version."""
    d = spark.read.format("xml").option("rowTag", "entry").schema("id string, title string, summary string").load(path)
    v = F.regexp_extract("id", r"v(\d+)$", 1)
    return d.select(F.regexp_extract("id", r"abs/(.+?)(v\d+)?$", 1).alias("arxiv_id"), v.alias("version"), T.collapse(F.col("title")).alias("title"), T.collapse(F.col("summary")).alias("text")).distinct().orderBy(F.desc("arxiv_id"), F.desc(F.col("version").try_cast("int"))).limit(most)


def search_results(dump: DataFrame, query: str, *, most: int = 10) -> DataFrame:
    """Documents of a search dump with ``items`` array<struct<title,link,snippet>>: the first ``most`` of each answer."""
    i = dump.select(F.posexplode(F.slice("items", 1, most)).alias("seq", "i"))
    return i.select("seq", F.col("i.link").alias("url"), F.concat_ws("\n", "i.title", "i.snippet").alias("text"), F.lit(query).alias("query"))


def union_sources(parts: list[tuple[int, int, DataFrame]], local_seq: str = "seq") -> DataFrame:
    """All sources one after another: (group, kind) in order, each by its own sequence; ``seq`` sorts as the three do."""
    out = None
    for g, k, d in parts:
        d = d.withColumns({"group_idx": F.lit(g), "kind_idx": F.lit(k)}).withColumnRenamed(local_seq, "local_seq")
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out.withColumn("seq", F.col("group_idx").cast("long") * (1 << 52) + F.col("kind_idx").cast("long") * (1 << 48) + F.col("local_seq"))
