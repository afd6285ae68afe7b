"""Registered queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed
from ..functions import text as T
from ..operators import clean, contract, dedup, encode, graph, packing, reporting, rules, sampling, scan, signals
from ..session import spread, table
from ..sources import readers, token_shards
from . import provenance, store

CLEAN = clean.CleanConfig(shortest=200, longest=200_000, groups={"boilerplate": (1.0, [r"\ball rights reserved\b", r"\bwith the\b"])}, threshold=0.004)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source", "n_chars")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for work on their texts: a small table, which comes in one split, is dealt over all cores."""
    return spread(documents(spark, sf))


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pages"))


def visits(spark: SparkSession, sf: str) -> DataFrame:
    """Events as visits: the user as domain, in order of time, with a score below 1."""
    e = table(spark, sf, "events")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select(F.col("user_id").alias("domain"), n.alias("seq"), "event_id", (F.pmod(F.floor(F.col("value") * 100), F.lit(100)) / 100.0).alias("score"))


def r6(c):
    return F.round(c, 6)


def _docs_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with scores, types and weights, which name scores and types many times: both are computed once a row, and so is a weight."""
    d = T.once(texts(spark, sf), quality=T.quality_score(F.col("text")), content_type=T.classify_text(F.col("text")))
    return T.once(d, final_weight=T.final_weight(F.lit(""), F.col("content_type"), F.lit(""), F.col("quality")))


def corpus_summary(spark, sf):
    d = clean.clean(texts(spark, sf), clean.CleanConfig(shortest=200, longest=200_000)).where("kept").withColumn("quality", T.quality_score(F.col("text")))
    # scores are whole hundredths, and the weight of a text of unknown type from no domain is 0.8 of its score; sums stay exact
    hundredths = F.sum(F.round(F.col("quality") * 100).cast("long"))
    return d.groupBy("source", "lang").agg(F.count("*").alias("docs"), F.sum(T.n_words(F.col("text"))).alias("words"), (hundredths / F.count("*") / 100).alias("mean_quality"), (hundredths * 80 / 10_000).alias("total_weight"))


def text_metrics(spark, sf):
    t = F.col("text")
    return texts(spark, sf).select("doc_id", T.n_words(t).alias("words"), F.char_length(t).alias("chars"), F.size(F.array_distinct(T.words(F.lower(t)))).alias("unique_words"), T.letters(t).alias("letters"), T.digits(t).alias("digits"))


def clean_kept(spark, sf):
    d = clean.clean(texts(spark, sf), CLEAN)
    return d.select("doc_id", "clean_action", r6("clean_score").alias("clean_score"), "kept", F.md5("text").alias("text_md5"))


def clean_outcomes(spark, sf):
    return clean.outcomes(clean.clean(texts(spark, sf), CLEAN))


def redact(spark, sf):
    d = clean.clean(texts(spark, sf), clean.CleanConfig(action="redact", shortest=200, longest=200_000, groups=CLEAN.groups, threshold=CLEAN.threshold))
    return d.where("clean_action = 'redacted'").select("doc_id", F.md5("text").alias("text_md5"))


def exact_dedup_clean(spark, sf):
    return clean.clean(texts(spark, sf), clean.CleanConfig(shortest=200, longest=200_000, refusal=False)).where("kept").select("doc_id")


def exact_dedup_normalized(spark, sf):
    return dedup.first_of(texts(spark, sf), dedup.normal_key(F.col("text"))).select("doc_id")


def html_strip_pages(spark, sf):
    return pages(spark, sf).select("page_id", F.md5(T.normalise(T.strip_tags(F.col("html")))).alias("text_md5"))


def html_strip_dom(spark, sf):
    return pages(spark, sf).select("page_id", F.md5(T.normalise(clean.dom_text(F.col("html")))).alias("text_md5"))


def page_documents(spark, sf):
    return readers.page_documents(pages(spark, sf)).select("doc_id", "url", "domain", "title", "content_type", F.md5("text").alias("text_md5"))


def near_dup_pairs(spark, sf):
    """Pairs between classes of equal trigram sets, and every other row of a class with its first."""
    return dedup.similar_pairs(texts(spark, sf), 0.8).select("a", "b", r6("similarity").alias("similarity"))


def near_dup_resolve(spark, sf):
    d = texts(spark, sf).withColumn("final_weight", F.pmod(F.col("seq"), F.lit(7)) / 7.0)
    return dedup.resolve_similar(d, 0.92)


def embedding_dup_pairs(spark, sf):
    return dedup.cosine_pairs(table(spark, sf, "embeddings"), 0.4)


def embedding_topk(spark, sf):
    return dedup.cosine_topk(table(spark, sf, "embeddings"), 5)


def embedding_dedup_resolve(spark, sf):
    return dedup.resolve_embeddings(table(spark, sf, "embeddings").withColumn("final_weight", F.pmod(F.col("vec_id"), F.lit(5)) / 5.0), 0.4)


def classify_url(spark, sf):
    return pages(spark, sf).select("page_id", T.classify_url(F.col("url")).alias("content_type"))


def classify_text(spark, sf):
    return texts(spark, sf).select("doc_id", T.classify_text(F.col("text")).alias("content_type"))


def code_language(spark, sf):
    return pages(spark, sf).select("page_id", T.code_language(F.col("url")).alias("code_language"))


def reclassify(spark, sf):
    return texts(spark, sf).select("doc_id", T.reclassify(F.lit("unknown"), F.col("text")).alias("content_type"))


def quality_score(spark, sf):
    return texts(spark, sf).select("doc_id", r6(T.quality_score(F.col("text"))).alias("quality"))


def document_score(spark, sf):
    return readers.page_documents(pages(spark, sf)).select("doc_id", r6(T.score_document(F.col("url"), F.col("text"))).alias("score"))


def final_weight(spark, sf):
    return _docs_weighted(spark, sf).select("doc_id", r6("final_weight").alias("final_weight"))


def signal_gate(spark, sf):
    return signals.signal_gate(visits(spark, sf), threshold=0.45).select("event_id", "page_no")


def signal_gate_runs(spark, sf):
    return scan.rolling_gate(visits(spark, sf), threshold=0.45, rows_per_run=1000).select("event_id", "page_no")


def domain_page_cap(spark, sf):
    return signals.page_cap(visits(spark, sf), 12, keys=["domain"]).select("event_id", "page_no")


def domain_snapshot(spark, sf):
    return signals.domain_snapshot(visits(spark, sf), threshold=0.45).withColumn("avg_score", r6("avg_score"))


def weight_expand_whole(spark, sf):
    d = _docs_weighted(spark, sf).withColumn("w", F.floor(F.col("final_weight") * 4))
    return sampling.resample(d, "both", weight="w").select("doc_id", "copy")


def weight_resample(spark, sf):
    """Fractional weights with draws that are hashes of the keys."""
    d = _docs_weighted(spark, sf).withColumn("w", F.round(F.col("final_weight") * 4, 6))
    return sampling.resample(d, "both", weight="w").select("doc_id", "copy")


def weighter_totals(spark, sf):
    d = graph.durable(_docs_weighted(spark, sf).select("doc_id", F.round(F.col("final_weight") * 4, 6).alias("w")))  # read twice
    return sampling.totals(d, sampling.resample(d, "downsample", weight="w"), "w").select("docs_in", "docs_out", F.round("total_weight", 4).alias("total_weight"), r6("avg_weight").alias("avg_weight"), r6("expansion").alias("expansion"))


def final_weight_pages(spark, sf):
    """Weights with domains, types by URL and code languages."""
    p = readers.page_documents(pages(spark, sf))
    n = F.conv(F.substring("doc_id", 1, 4), 16, 10).cast("int")
    domain = F.element_at(F.array(*[F.lit(x) for x in ("github.com", "x.github.com", "export.arxiv.org", "huggingface.co", "a.org")]), n % 5 + 1)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("source_code", "research_paper", "blog_post")]), n % 3 + 1)
    lang = F.element_at(F.array(*[F.lit(x) for x in ("python", "java", "cobol", "")]), n % 4 + 1)
    return p.select("doc_id", F.round(T.final_weight(domain, kind, lang, F.lit(0.5)), 8).alias("final_weight"), T.domain_rule(domain, 2).alias("category"))


def weight_resample_exact(spark, sf):
    d = graph.durable(_docs_weighted(spark, sf).select("doc_id", "seq", (F.col("final_weight") * 4).alias("w")))  # read twice
    return sampling.resample_in_order(d, "both", weight="w").groupBy("doc_id").agg(F.count("*").alias("copies"))


def reservoir_sample(spark, sf):
    return sampling.reservoir_sample(documents(spark, sf), 100).select("doc_id", "place")


def buffer_shuffle(spark, sf):
    return sampling.buffer_shuffle(documents(spark, sf), 64).select("doc_id", "place")


def split_assignment(spark, sf):
    return sampling.split(documents(spark, sf), 0.05).select("doc_id", "bucket", "part")


def shard_offsets(spark, sf):
    d = sampling.split(texts(spark, sf), 0.05)
    return packing.offsets(d, T.n_words(F.col("text")) + 1).select("doc_id", "part", "start", F.expr("start div 50000").alias("shard"))


def _word_tokens(spark, sf):
    d = sampling.split(texts(spark, sf), 0.05)
    d = T.once(d.drop("lang", "source", "n_chars"), tokens=F.transform(T.words(F.col("text")), lambda w: F.char_length(w))).drop("text")
    return T.once(d, tokens=packing.with_end(F.col("tokens"), 2))


def shard_pieces(spark, sf):
    return packing.shard_pieces(graph.durable(_word_tokens(spark, sf)), 50_000).groupBy("part", "shard").agg(F.count("*").alias("pieces"), F.sum(F.size("piece")).alias("tokens"))


def batch_windows(spark, sf):
    w = packing.windows(_word_tokens(spark, sf).select("doc_id", "tokens"), 128)
    total = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    return w.select("doc_id", "at", total("x").alias("x_sum"), total("y").alias("y_sum"))


def shard_windows(spark, sf):
    """Training windows read back from the token shards of both parts."""
    folder = graph.new_folder(spark, "shards")
    # read by the sums and by the cuts: texts are split into words once
    d = graph.durable(_word_tokens(spark, sf).withColumn("tokens", F.transform("tokens", lambda n: F.least(n, F.lit(65_535)))))
    token_shards.write_token_shards(packing.shard_pieces(d, 50_000), folder, sequence_length=128, vocab_size=65_536)
    total = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    out = graph.durable(token_shards.read_token_shards(spark, folder).select("name", "at", total("x").alias("x_sum"), total("y").alias("y_sum")))
    graph.remove_folder(spark, folder)
    return out


def exclusion_tags(spark, sf):
    return texts(spark, sf).select("doc_id", F.array_join(T.exclusion_tags(F.col("text")), ",").alias("tags"))


def contract_gate(spark, sf):
    t = F.col("text")
    return texts(spark, sf).select("doc_id", contract.gate(t, T.quality_score(t), T.exclusion_tags(t)).alias("keep"))


def _decided(spark, sf):
    kinds = ["web", "github", "arxiv", "huggingface", "google"]
    kind = F.when(F.col("seq") % 13 == 0, "local_files").otherwise(F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("seq") % 5 + 1).cast("int")))
    # every seventh row lacks the last of its identity's keys
    part = F.when(F.col("seq") % 7 == 0, "").otherwise("v")
    names = [(k, v) for k, v in (("full_name", F.lit("a/b")), ("commit_sha", part), ("arxiv_id", F.lit("1")), ("version", part), ("repo", F.lit("r")), ("revision", F.lit("1")), ("split", F.lit("s")), ("row_index", part), ("result_url", F.lit("u")), ("query", part))]
    d = texts(spark, sf).withColumns({
        "url": F.when(F.col("seq") % 11 == 0, "").otherwise(F.concat(F.lit("https://example.org/"), F.col("doc_id"))), "source": kind,
        "dataset_group": F.when(F.col("seq") % 17 == 0, "other").otherwise("text"), "quality_signal": T.quality_score(F.col("text")), "source_identity": F.create_map(*[x for k, v in names for x in (F.lit(k), v)]),
        "license_status": F.when(F.col("seq") % 3 == 0, "verified").otherwise("unknown"), "doc_id": F.when(F.col("seq") % 19 == 0, F.lit("again")).otherwise(F.col("doc_id")),
    })
    return contract.decide(d, "text", kinds=kinds)


def acceptance_report(spark, sf):
    return _decided(spark, sf).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"), F.sum((F.col("license_status") != "verified").cast("int")).alias("rights_unknown"))


def contract_report(spark, sf):
    """The acceptance report itself, its reasons one a row."""
    return contract.report(_decided(spark, sf)).select("rows", "accepted", "rejected", "rights_unknown", F.explode("reasons").alias("reason", "n"))


def profile_groups(spark, sf):
    p = table(spark, sf, "nation").select(F.col("n_nationkey").alias("dataset_id"), F.col("n_name").alias("profile"), F.col("n_regionkey").alias("group_id"))
    g = table(spark, sf, "region").select(F.col("r_regionkey").alias("group_id"), F.col("r_name").alias("group_name"))
    return contract.bind_profiles(p, g).select("dataset_id", "profile", "group_name")


def record_hash(spark, sf):
    d = table(spark, sf, "documents").withColumn("license", F.lit(None).cast("string"))
    return d.select("doc_id", provenance.record_hash("doc_id", "lang", "source", "n_chars", "text", "license").alias("record_sha256"))


def content_fold(spark, sf):
    return signals.content_fold(documents(spark, sf), "source", "text", "seq")


def source_hash(spark, sf):
    d = table(spark, sf, "documents").withColumn("license", F.lit(None).cast("string"))
    return provenance.source_hashes(d, "source", "doc_id", "doc_id", "lang", "source", "n_chars", "text", "license")


def exclusion_rules(spark, sf):
    """The exclusion tags by one pass over all rules."""
    every = [(t, p) for t, patterns in fixed.EXCLUSIONS.items() for p in patterns]
    return rules.tagged(texts(spark, sf).select("doc_id", "text"), every).select("doc_id", F.array_join("tags", ",").alias("tags"))


def stage_throughput(spark, sf):
    return table(spark, sf, "part").select("p_partkey", signals.throughput(F.col("p_size") * 1000, F.col("p_retailprice") - 1000).alias("per_second"))


def dedup_totals(spark, sf):
    d = documents(spark, sf)
    return dedup.dedup_totals(d.count(), exact_dedup_normalized(spark, sf))


def embedding_topk_cells(spark, sf):
    """Neighbours by the cell index, as many cells as there are for so few vectors."""
    return dedup.topk(table(spark, sf, "embeddings"), 5, kind="ivf")


def parse_files(spark, sf):
    """A JSON and a CSV file made of every document's facts, parsed."""
    d = documents(spark, sf)
    as_json = F.concat(F.lit('[{"lang": "'), "lang", F.lit('", "doc_id": '), "doc_id", F.lit('}, {"n": '), F.col("n_chars").cast("string"), F.lit("}]"))
    as_csv = F.concat(F.lit("doc_id,lang,,note\n"), "doc_id", F.lit(","), "lang", F.lit(',"a, b"\n\n , ,\nlast,"x\ny"\n'))
    files = d.select("doc_id", F.encode(as_json, "utf-8").alias("content"), F.lit("a.json").alias("url")).unionAll(d.select("doc_id", F.encode(as_csv, "utf-8").alias("content"), F.lit("b.csv").alias("url")))
    return readers.parsed(files).select("doc_id", "url", "text", "content_type", "error")


def _source_facts(spark, sf):
    o = table(spark, sf, "orders")
    n = lambda c: F.sum(c.cast("int"))
    s = F.col("o_orderstatus")
    return o.groupBy((F.col("o_custkey") % 97).alias("k")).agg(n(s == "F").alias("documents"), n((s == "O") & (F.col("o_totalprice") > 200000)).alias("errors"), n(s == "P").alias("limited"), n(s == "O").alias("skipped"))


def source_status(spark, sf):
    c = F.col
    return _source_facts(spark, sf).select("k", signals.source_status(c("k") % 10 != 0, F.when(c("k") % 4 == 1, 0).otherwise(c("documents")), F.when(c("k") % 3 == 0, c("errors")).otherwise(0), c("skipped"), F.when(c("k") % 5 == 2, c("limited")).otherwise(0)).alias("status"))


def http_buckets(spark, sf):
    e = table(spark, sf, "events").select((F.pmod("event_id", F.lit(5)) * 100 + 101 + F.pmod("event_id", F.lit(7))).alias("status"))
    return signals.http_buckets(e)


def stage_counts(spark, sf):
    d = texts(spark, sf)
    return signals.stage_counts(d, clean.clean(d, CLEAN).where("kept"))


def source_licences(spark, sf):
    return documents(spark, sf).groupBy("source").agg(signals.one_or_many(F.col("lang")).alias("langs"))


def _metrics(spark, sf):
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("metric_name"), F.when(F.col("event_id") % 10 == 0, None).otherwise(F.floor(F.col("event_id") / 3)).cast("long").alias("step"), r6("value").alias("metric_value"))


def latest_metric(spark, sf):
    return signals.latest(_metrics(spark, sf), "metric_name", [F.desc_nulls_last("step"), F.desc("id")])


def metric_unpivot(spark, sf):
    d = table(spark, sf, "events").select("event_id", r6("value").alias("value"), F.col("user_id").alias("user"), (F.col("event_id") % 2 == 0).alias("even"), "event_type")
    return store.unpivot_metrics(d, ["event_id"])


def run_store(spark, sf) -> store.RunStore:
    """Orders as runs, customers as experiments, suppliers as sources."""
    c, o, s = (table(spark, sf, n) for n in ("customer", "orders", "supplier"))
    text = lambda x: F.col(x).cast("string")
    at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return store.RunStore(spark, {
        "experiments": c.select(text("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("2024").alias("created_at"), F.lit("2024").alias("updated_at")),
        "runs": o.select(text("o_orderkey").alias("id"), text("o_custkey").alias("experiment_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("git_sha"), at.alias("started_at")),
        "datasets": spark.createDataFrame([("d1", "1", "g")], "id string, run_id string, dataset_group string"),
        "sources": s.select(F.col("s_suppkey").alias("id"), F.lit("d1").alias("dataset_id"), F.lit("web").alias("kind"), F.col("s_name").alias("identifier")),
        "source_stats": s.where(F.col("s_suppkey") % 2 == 0).select(F.col("s_suppkey").alias("source_id"), F.floor("s_acctbal").cast("long").alias("documents")),
    })


def run_manifest_metrics(spark, sf):
    """Orders and their lines as run manifests, put into the store twice; the metrics of all runs."""
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.max(c).alias(c) for c in ("l_quantity", "l_extendedprice", "l_tax")])
    metrics = F.map_from_arrays(F.array(F.lit("quantity"), F.lit("price")), F.array("l_quantity", "l_extendedprice"))
    stage = F.struct(F.concat(F.lit("line"), F.col("l_linenumber").cast("string")), F.struct(F.lit("PASS").alias("status"), F.lit("s").alias("start"), F.lit("e").alias("end"), F.col("l_tax").alias("duration_seconds"), metrics.alias("metrics")))
    lines = li.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(stage)).alias("stages"))  # seven lines an order at most
    none = F.lit(None)
    m = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.lit(2).alias("schema"), F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_custkey").cast("string").alias("experiment_id"), none.cast("string").alias("dataset_id"),
        F.struct(F.lit("t").alias("started"), F.lit("u").alias("updated"), none.cast("string").alias("ended")).alias("timestamps"), F.struct(none.cast("string").alias("commit"), none.cast("string").alias("branch"), F.lit(False).alias("dirty")).alias("git"),
        F.create_map().cast("map<string,string>").alias("configuration"), "stages", F.array().cast("array<struct<artifact_id:string,stage:string,path:string,sha256:string,size:long>>").alias("artifacts"),
        F.array().cast("array<string>").alias("warnings"), F.array().cast("array<string>").alias("errors"), F.col("o_orderstatus").alias("final_status"),
    )
    s = store.RunStore(spark)
    s.sync(m)
    s.sync(m)
    return s.t["metrics"].select("run_id", "metric_name", "metric_value")


def run_search(spark, sf):
    return run_store(spark, sf).search(status="F", limit=50).select("id", "experiment_name", "status", "started_at")


def run_lineage_sources(spark, sf):
    return run_store(spark, sf).source_lineage("1").select("id", "identifier", F.coalesce("documents", F.lit(-1)).alias("fetched"))


def run_upsert(spark, sf):
    s = run_store(spark, sf)
    new = s.t["runs"].where(F.col("id").cast("long") % 5 == 0).withColumns({"status": F.lit("DONE"), "started_at": F.lit("later"), "id": F.when(F.col("id").cast("long") % 10 == 0, F.concat(F.lit("new-"), F.col("id"))).otherwise(F.col("id"))})
    s.upsert("runs", new, ["status", "completed_at"])
    return s.t["runs"].select("id", "status", "started_at")


def run_validate(spark, sf):
    return run_store(spark, sf).validate("1")


def dataset_pages(spark, sf):
    return store.paginate(documents(spark, sf).select("seq", "doc_id", "source"), "seq", 20, 30).select("doc_id", "source")


def event_tail(spark, sf):
    return store.tail(table(spark, sf, "events").select("event_id", "event_type"), 25, "event_id")


def generation_metrics(spark, sf):
    return store.generation_metrics(table(spark, sf, "conversations").select("conv_id", "turn", "text")).select("conv_id", "turn", "tokens", "repetition_rate", "distinct_1", "distinct_2")


def loss_summary(spark, sf):
    d = store.loss_summary(table(spark, sf, "lineitem").withColumn("loss", F.col("l_discount") * 10), "loss")
    return d.select(r6("loss").alias("loss"), r6("perplexity").alias("perplexity"))


def cosine_lr(spark, sf):
    return store.cosine_schedule(spark, 1000, 100, 3e-4, 3e-5).select("step", F.round("lr", 12).alias("lr"))


def duration_estimate(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 100).alias("total_steps"), F.lit(8).alias("batch_size"), F.lit(4).alias("grad_accum"), F.lit(512).alias("seq_len"), F.col("p_retailprice").alias("tokens_per_sec"), F.lit(250).alias("eval_every"), F.lit(500).alias("checkpoint_every"), F.lit(1.5).alias("eval_seconds"), F.lit(None).cast("double").alias("checkpoint_seconds"))
    return store.duration_estimate(p).select("p_partkey", "eval_count", "checkpoint_count", F.round("duration_seconds", 3).alias("duration_seconds"))


def union_sources(spark, sf):
    w = pages(spark, sf).select(F.col("page_id").alias("seq"), F.col("url").alias("name"))
    d = documents(spark, sf).select("seq", F.col("source").alias("name"))
    c = table(spark, sf, "benchmark").select(F.col("item_id").alias("seq"), F.lit("benchmark").alias("name"))
    return readers.union_sources([(0, 0, w), (0, 3, d), (1, 0, c)]).select("group_idx", "kind_idx", "local_seq", "name", "seq")


def field_text(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(T.field_text(["role", "text"])).alias("text_md5"))


def crawl_replay(spark, sf):
    """A crawl over the pages, whose links lead from each page to two others, three pages of a domain at most."""
    p = table(spark, sf, "pages")
    q = p.select(F.col("page_id").alias("to"), F.col("url").alias("link"))
    links = p.select("url", F.explode(F.array(F.col("page_id") * 2 + 1, F.col("page_id") * 3)).alias("to")).join(q, "to").select("url", "link")
    seeds = p.where(F.col("url").rlike("^http://[^?#]*$")).select("url")
    return readers.replay_crawl(p, links, seeds, same_domain=False, domain_cap=3)


def bpe_tokenize(spark, sf):
    import public_tokenizers

    t = encode.encoded(F.col("text"), str(public_tokenizers.path("byte_bpe_50k.json")))
    return encode.texts(texts(spark, sf)).select("doc_id", t.alias("ids")).select("doc_id", F.size("ids").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"))


def source_manifest(spark, sf):
    d = documents(spark, sf).select("seq", F.lit("web").alias("kind"), F.col("source").alias("identifier"), F.lit("r1").alias("revision"), F.col("lang").alias("license"), F.sha2("text", 256).alias("raw_source_sha256"), F.when(F.col("seq") % 9 == 0, "other").otherwise("text").alias("dataset_group"))
    return reporting.source_manifest(d)


def manifest_faults(spark, sf):
    return reporting.manifest_faults(source_manifest(spark, sf), "text")


def run_progress(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 1000).alias("step"), (F.col("o_custkey") % 900).alias("total_steps"), F.floor("o_totalprice").alias("elapsed_seconds"))
    return reporting.progress(o).select("o_orderkey", "percent", "eta_seconds")


def log_redaction(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(reporting.without_secrets(F.col("text"), ["the", "then", ""])).alias("text_md5"))


def token_totals(spark, sf):
    f = table(spark, sf, "part").select(F.concat(F.when(F.col("p_partkey") % 3 == 0, "val").otherwise("train"), F.lit("_"), F.col("p_partkey")).alias("name"), (F.col("p_size") * 8).cast("long").alias("size"), F.when(F.col("p_partkey") % 2 == 0, "uint16").otherwise("uint32").alias("dtype"))
    return reporting.token_total(f)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        corpus_summary, text_metrics, clean_outcomes, clean_kept, redact, exact_dedup_clean, exact_dedup_normalized, html_strip_pages, html_strip_dom, page_documents,
        near_dup_pairs, near_dup_resolve, embedding_dup_pairs, embedding_topk, embedding_dedup_resolve, classify_url, classify_text, code_language, reclassify,
        quality_score, document_score, final_weight, final_weight_pages, signal_gate, signal_gate_runs, domain_page_cap, domain_snapshot, weight_expand_whole, weight_resample, weighter_totals, weight_resample_exact, reservoir_sample,
        buffer_shuffle, split_assignment, shard_offsets, shard_pieces, batch_windows, shard_windows, exclusion_tags, contract_gate, acceptance_report, contract_report, profile_groups, record_hash, content_fold, source_hash, exclusion_rules, stage_throughput, dedup_totals, embedding_topk_cells, parse_files, run_manifest_metrics, source_status, http_buckets,
        stage_counts, source_licences, latest_metric, metric_unpivot, run_search, run_lineage_sources, run_upsert, run_validate, dataset_pages, event_tail,
        generation_metrics, loss_summary, cosine_lr, duration_estimate, union_sources, field_text, crawl_replay, bpe_tokenize, source_manifest, manifest_faults, run_progress, log_redaction, token_totals,
    )
}


def _oracle() -> dict[str, str]:
    from .oracle import SQL

    return {k: v for k, v in SQL.items() if k in QUERIES}


ORACLE_SQL: dict[str, str] = _oracle()
