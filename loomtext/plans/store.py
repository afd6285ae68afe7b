"""Run store: experiments, runs and their lineage as tables, kept by upsert or by replacing a run's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.signals import latest

#: Tables: columns, and the key by which rows are told apart.
SCHEMAS: dict[str, tuple[str, list[str]]] = {
    "schema_metadata": ("key string, value string", ["key"]),
    "experiments": ("id string, name string, description string, status string, created_at string, updated_at string, tags_json string", ["id"]),
    "runs": ("id string, experiment_id string, dataset_id string, started_at string, completed_at string, status string, git_sha string, git_branch string, git_dirty int, entrypoint string, parent_run_id string", ["id"]),
    "datasets": ("id string, run_id string, dataset_group string, manifest_sha256 string, document_count long, token_count long, train_tokens long, validation_tokens long", ["id"]),
    "sources": ("id long, dataset_id string, kind string, identifier string, revision string, license string, raw_source_sha256 string, status string", ["id"]),
    "source_stats": ("source_id long, requests long, successes long, failures long, http_2xx long, http_4xx long, http_5xx long, documents long, retries long, duration_seconds double", ["source_id"]),
    "stages": ("id long, run_id string, stage_name string, status string, started_at string, completed_at string, duration_seconds double, records_in long, records_out long, tokens long, throughput double, input_artifact_id string, output_artifact_id string", ["run_id", "stage_name"]),
    "artifacts": ("id string, run_id string, stage_name string, path string, sha256 string, size_bytes long, created_at string, parent_artifact_id string, metadata_json string", ["id"]),
    "checkpoints": ("id long, run_id string, artifact_id string, step long, val_loss double, best_val_loss double, is_best int, is_final int, created_at string", ["id"]),
    "metrics": ("id long, run_id string, step long, metric_name string, metric_value double, metric_unit string, recorded_at string", ["id"]),
    "evaluations": ("id long, run_id string, name string, status string, score double, step long, artifact_id string, details_json string", ["id"]),
    "hardware": ("run_id string, platform string, cpu_name string, cpu_threads int, ram_gb double, gpu_name string, gpu_count int, gpu_memory_gb double, disk_free_gb double, disk_total_gb double, snapshot_json string", ["run_id"]),
    "configs": ("run_id string, config_type string, sha256 string, path string, snapshot_json string", ["run_id", "config_type"]),
    "warnings": ("id long, run_id string, stage_id long, code string, message string, created_at string", ["id"]),
    "errors": ("id long, run_id string, stage_id long, code string, message string, exception_type string, created_at string", ["id"]),
    "runtime_estimates": ("id long, run_id string, estimate_type string, estimated_seconds double, actual_seconds double, tokens_per_second double, steps_per_second double, created_at string", ["id"]),
}
#: (child, its column, parent, its column): what has to be there.
REFERENCES = [("runs", "experiment_id", "experiments", "id"), ("source_stats", "source_id", "sources", "id"), ("sources", "dataset_id", "datasets", "id")] + [
    (t, "run_id", "runs", "id") for t in ("datasets", "stages", "artifacts", "checkpoints", "metrics", "evaluations", "hardware", "configs", "warnings", "errors", "runtime_estimates")
]
#: Columns that keep their first value when a row comes again.
FIRST_VALUES = {"experiments": ["name", "description", "created_at", "tags_json"], "runs": ["experiment_id", "dataset_id", "started_at", "entrypoint", "parent_run_id"], "artifacts": ["run_id", "stage_name", "path", "created_at", "parent_artifact_id"], "stages": ["id", "input_artifact_id", "output_artifact_id"]}


def aligned(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the columns of table ``name``: missing ones null, others dropped, types as the table has them."""
    fields = T.StructType.fromDDL(SCHEMAS[name][0]).fields
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], updates: list[str]) -> DataFrame:
    """``old`` with ``new``: rows of new keys are added; of known keys the ``updates`` columns take the new value, the rest stay."""
    n = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in old.columns if c not in keys], F.lit(True).alias("_is_new"))
    o = old.withColumn("_is_old", F.lit(True))
    pick = [F.col(k) for k in keys]
    for c in old.columns:
        if c in keys:
            continue
        fresh = F.col(f"_new_{c}")
        keep = F.col(c)
        pick.append((F.when(F.col("_is_old").isNull() | (F.col("_is_new") & F.lit(c in updates)), fresh).otherwise(keep)).alias(c))
    return o.join(n, keys, "full_outer").select(*pick).select(*old.columns)


def replace(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` without the rows of the keys that ``new`` has, and ``new``."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose parent is missing."""
    return child.where(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def unpivot_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per number: ``metric_name`` and ``metric_value`` from every other numeric or boolean column that is not null."""
    kinds = dict(rows.dtypes)
    names = [c for c in rows.columns if c not in keys and kinds[c] in ("int", "bigint", "double", "float", "smallint", "tinyint", "boolean")]
    d = rows.select(*keys, *[F.col(c).cast("double").alias(c) for c in names])
    return d.unpivot(keys, names, "metric_name", "metric_value").where("metric_value is not null")


class RunStore:
    """Tables by name, in memory or under a folder of Parquet, with the queries of a run's page."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.t = {k: spark.createDataFrame([], s) for k, (s, _) in SCHEMAS.items()} | {k: aligned(df, k) for k, df in (tables or {}).items()}

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> RunStore:
        return cls(spark, {k: spark.read.schema(s).parquet(f"{folder}/{k}") for k, (s, _) in SCHEMAS.items()})

    def write(self, folder: str) -> None:
        """All tables to a new folder; the folder read from must be another one."""
        for k, df in self.t.items():
            df.write.mode("overwrite").parquet(f"{folder}/{k}")

    def upsert(self, name: str, rows: DataFrame, updates: list[str] | None = None) -> None:
        keys = SCHEMAS[name][1]
        first = FIRST_VALUES.get(name, [])
        self.t[name] = upsert(self.t[name], aligned(rows, name), keys, [c for c in self.t[name].columns if c not in keys and c not in first] if updates is None else updates)

    def replace(self, name: str, rows: DataFrame, key: str = "run_id") -> None:
        self.t[name] = replace(self.t[name], aligned(rows, name), key)

    def replace_sources(self, dataset_id: str, sources: DataFrame, stats: DataFrame) -> None:
        """A data set's sources and their statistics anew; statistics of sources that went go too."""
        old = self.t["sources"].where(F.col("dataset_id") == dataset_id).select(F.col("id").alias("source_id"))
        self.t["source_stats"] = self.t["source_stats"].join(old, "source_id", "left_anti").unionByName(aligned(stats, "source_stats"))
        self.t["sources"] = self.t["sources"].where(F.col("dataset_id") != dataset_id).unionByName(aligned(sources, "sources"))

    def runs(self) -> DataFrame:
        e = self.t["experiments"].select(F.col("id").alias("experiment_id"), F.col("name").alias("experiment_name"))
        return self.t["runs"].join(e, "experiment_id")

    def search(self, *, status: str | None = None, git_sha: str | None = None, limit: int = 100) -> DataFrame:
        """Runs, the last started first; ``limit`` is held to 1 to 100."""
        d = self.runs()
        for c, v in (("status", status), ("git_sha", git_sha)):
            if v is not None:
                d = d.where(F.col(c) == v)
        return d.orderBy(F.desc("started_at"), "id").limit(max(1, min(100, limit)))

    def compare(self, a: str, b: str) -> dict[str, DataFrame]:
        """Two runs side by side: their runs, hardware, stages by name and artefacts by stage and path."""
        orders = {"runs": ["id"], "hardware": ["run_id"], "stages": ["stage_name", "run_id"], "artifacts": ["stage_name", "path", "run_id"]}
        return {k: self.t[k].where(F.col("id" if k == "runs" else "run_id").isin(a, b)).orderBy(*o) for k, o in orders.items()}

    def source_lineage(self, run_id: str) -> DataFrame:
        """The sources of a run's first data set with their statistics, if any."""
        dataset = self.t["datasets"].where(F.col("run_id") == run_id).agg(F.min("id").alias("dataset_id"))
        s = self.t["sources"].join(F.broadcast(dataset), "dataset_id")
        return s.join(self.t["source_stats"].withColumnRenamed("source_id", "id"), "id", "left").orderBy("id")

    def latest_metrics(self, run_id: str) -> DataFrame:
        return latest(self.t["metrics"].where(F.col("run_id") == run_id), "metric_name", [F.desc_nulls_last("step"), F.desc("id")])

    def lineage(self, run_id: str) -> dict[str, DataFrame]:
        """All of a run's tables, in their orders."""
        orders = {"stages": ["id", "stage_name"], "artifacts": ["stage_name", "path"], "metrics": ["step", "metric_name"], "configs": ["config_type"], "checkpoints": ["step"]}
        names = ("datasets", "stages", "artifacts", "configs", "checkpoints", "metrics", "evaluations", "runtime_estimates", "warnings", "errors")
        own = {k: self.t[k].where(F.col("run_id") == run_id).orderBy(*orders.get(k, ["id"])) for k in names}
        return own | {"run": self.runs().where(F.col("id") == run_id), "sources": self.source_lineage(run_id)}

    def best_checkpoint(self, run_id: str) -> DataFrame:
        """The checkpoint of the last step; of equal steps that of the largest id."""
        return self.kept_checkpoints(run_id, 1)

    def kept_checkpoints(self, run_id: str, n: int) -> DataFrame:
        return self.t["checkpoints"].where(F.col("run_id") == run_id).orderBy(F.desc("step"), F.desc("id")).limit(n)

    def snapshot(self, run_id: str) -> DataFrame:
        """One row of what a run's page shows.

        Status and times, stages and latest metrics as maps, the last step and the share of all steps, seconds elapsed and left, the best loss, counts of warnings,
        errors, checkpoints and artefacts, and whether configuration, data set lineage, tokenizer, checkpoint and artefact hashes are recorded.
        """
        of = lambda t: self.t[t].where(F.col("run_id") == run_id)
        pairs = lambda a, b: F.map_from_entries(F.sort_array(F.collect_list(F.struct(a, b))))
        n = lambda t, name: of(t).agg(F.count("*").alias(name))
        metrics = self.latest_metrics(run_id).agg(pairs("metric_name", "metric_value").alias("metrics"))
        parts = [
            of("stages").agg(pairs("stage_name", "status").alias("stages")), metrics, of("metrics").agg(F.max("step").alias("step")),
            of("checkpoints").agg(F.count("*").alias("checkpoints"), F.max_by("best_val_loss", F.when(F.col("best_val_loss").isNotNull(), F.col("step"))).alias("best_loss")),
            of("artifacts").agg(F.count("*").alias("artifacts"), F.coalesce(F.every(F.col("sha256").isNotNull()), F.lit(False)).alias("artifact_integrity"), F.coalesce(F.bool_or((F.col("stage_name") == "tokenize") & F.col("sha256").isNotNull()), F.lit(False)).alias("tokenizer")),
            n("configs", "configurations"), n("warnings", "warnings"), n("errors", "errors"), of("datasets").agg(F.coalesce(F.bool_or(F.col("manifest_sha256").isNotNull()), F.lit(False)).alias("dataset_lineage")),
        ]
        out = self.runs().where(F.col("id") == run_id)
        for p in parts:
            out = out.crossJoin(F.broadcast(p))  # one row each
        total = F.coalesce(F.try_element_at("metrics", F.lit("total_steps")), F.try_element_at("metrics", F.lit("train.total_steps")))
        seconds = F.unix_timestamp(F.to_timestamp("completed_at")) - F.unix_timestamp(F.to_timestamp("started_at"))
        out = out.withColumns({"total_steps": total.cast("long"), "elapsed_seconds": F.greatest(F.lit(0), seconds)}).withColumn("progress", F.when(F.col("total_steps") > 0, F.col("step") / F.col("total_steps")))
        loss = lambda *names: F.coalesce(*[F.try_element_at("metrics", F.lit(x)) for x in names])
        return out.withColumns({"loss": loss("loss", "train.loss", "train_loss"), "validation_loss": loss("val_loss", "validation_loss", "train.val_loss"), "configuration": F.col("configurations") > 0, "checkpoint": F.col("checkpoints") > 0})

    def dangling(self) -> DataFrame:
        """(child, column, n): references that point at nothing."""
        out = None
        for child, column, parent, key in REFERENCES:
            n = orphans(self.t[child], self.t[parent], column, key).agg(F.count("*").alias("n")).select(F.lit(child).alias("child"), F.lit(column).alias("column"), "n")
            out = n if out is None else out.unionAll(n)
        return out.where("n > 0")

    def validate(self, run_id: str) -> DataFrame:
        """(name, status, detail): checks of a run's lineage."""
        t, of = self.t, F.col("run_id") == run_id

        def check(name: str, rows: DataFrame, good: Column, detail: str, otherwise: str = "FAIL") -> DataFrame:
            n = rows.agg(F.count("*").alias("n"))
            return n.select(F.lit(name).alias("name"), F.when(good, "PASS").otherwise(otherwise).alias("status"), F.concat(F.lit(f"{detail}: "), F.col("n").cast("string")).alias("detail"))

        none, some = F.col("n") == 0, F.col("n") > 0
        run = t["runs"].where(F.col("id") == run_id)
        hashed = F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))
        parts = [
            check("run exists", run, F.col("n") == 1, "rows"),
            check("experiment exists", orphans(run, t["experiments"], "experiment_id", "id"), none, "runs without experiment"),
            check("dataset recorded", t["datasets"].where(of), some, "data sets", "WARN"),
            check("dataset manifest hashed", t["datasets"].where(of & F.col("manifest_sha256").isNull()), none, "without hash", "WARN"),
            check("sources recorded", self.source_lineage(run_id), some, "sources", "WARN"),
            check("configurations recorded", t["configs"].where(of), some, "configurations", "WARN"),
            check("artefacts hashed", t["artifacts"].where(of & ~hashed), none, "without hash"),
            check("artefact parents recorded", t["artifacts"].where(of & F.col("parent_artifact_id").isNotNull()).join(t["artifacts"].select(F.col("id").alias("parent_artifact_id")), "parent_artifact_id", "left_anti"), none, "without parent"),
            check("stages ended", t["stages"].where(of & ~F.col("status").isin("PASS", "WARN", "DEGRADED", "SKIPPED", "completed")), none, "not ended"),
            check("no errors", t["errors"].where(of), none, "errors"),
            check("checkpoints have artefacts", t["checkpoints"].where(of & F.col("artifact_id").isNotNull()).join(t["artifacts"].select(F.col("id").alias("artifact_id")), "artifact_id", "left_anti"), none, "without artefact"),
            check("source statistics attached", orphans(t["source_stats"], t["sources"], "source_id", "id"), none, "without source"),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def sync(self, manifests: DataFrame) -> None:
        """Run manifests (``read_run_manifests``) into the tables; doing it again changes nothing.

        Experiments, runs, stages, configurations and artefacts are upserted; a run's metrics, warnings and errors are replaced.
        """
        m = manifests
        number = lambda i: F.pmod(F.xxhash64("run_id"), F.lit(1 << 31)) * (1 << 32) + F.col(i)
        now = F.coalesce("timestamps.updated", "timestamps.started", F.lit(""))
        status = F.coalesce("final_status", F.lit("RUNNING"))
        last = Window.partitionBy("experiment_id").orderBy(now.desc(), F.desc("run_id"))
        e = m.withColumn("_r", F.row_number().over(last)).where("_r = 1")
        self.upsert("experiments", e.select(F.col("experiment_id").alias("id"), F.col("experiment_id").alias("name"), status.alias("status"), F.coalesce("timestamps.started", now).alias("created_at"), now.alias("updated_at"), F.lit("[]").alias("tags_json")))
        self.upsert("runs", m.select(
            F.col("run_id").alias("id"), "experiment_id", "dataset_id", F.coalesce("timestamps.started", now).alias("started_at"), F.col("timestamps.ended").alias("completed_at"), status.alias("status"),
            F.col("git.commit").alias("git_sha"), F.col("git.branch").alias("git_branch"), F.coalesce(F.col("git.dirty").cast("int"), F.lit(0)).alias("git_dirty"),
        ))
        self.upsert("configs", m.select("run_id", F.explode("configuration").alias("config_type", "v")).select("run_id", "config_type", F.coalesce(F.get_json_object("v", "$.sha256"), F.get_json_object("v", "$.config_sha256"), F.when(~F.col("v").startswith("{"), F.col("v"))).alias("sha256"), F.get_json_object("v", "$.path").alias("path"), F.col("v").alias("snapshot_json")))
        stages = m.select("run_id", F.posexplode(F.map_entries("stages")).alias("i", "s")).select("run_id", "i", F.col("s.key").alias("stage_name"), "s.value.*")
        metric = lambda x: F.try_element_at("metrics", F.lit(x))
        self.upsert("stages", stages.select(
            number("i").alias("id"), "run_id", "stage_name", F.coalesce("status", F.lit("PENDING")).alias("status"), F.col("start").alias("started_at"), F.col("end").alias("completed_at"), "duration_seconds",
            metric("input_document_count").alias("records_in"), F.coalesce(metric("document_count"), metric("output_document_count")).alias("records_out"), metric("token_count").alias("tokens"), metric("throughput_docs_per_second").alias("throughput"),
        ))
        metrics = stages.select("run_id", F.col("end").alias("recorded_at"), "stage_name", "i", F.posexplode(F.map_entries("metrics")).alias("j", "e")).where("e.value is not null")
        self.replace_runs("metrics", m, metrics.select((number("i") + F.col("j") * 65536).alias("id"), "run_id", F.concat_ws(".", "stage_name", "e.key").alias("metric_name"), F.col("e.value").alias("metric_value"), "recorded_at"))
        a = m.select("run_id", F.explode("artifacts").alias("a")).select("run_id", "a.*")
        self.upsert("artifacts", a.select(F.coalesce("artifact_id", F.concat_ws(":", "run_id", "stage", "path")).alias("id"), "run_id", F.col("stage").alias("stage_name"), "path", "sha256", F.col("size").alias("size_bytes"), F.to_json(F.struct("stage", "path", "sha256", "size")).alias("metadata_json")).dropDuplicates(["id"]))
        for name in ("warnings", "errors"):
            self.replace_runs(name, m, m.select("run_id", F.posexplode(name).alias("i", "message")).select(number("i").alias("id"), "run_id", F.coalesce(F.get_json_object("message", "$.code")).alias("code"), F.coalesce(F.get_json_object("message", "$.message"), "message").alias("message")))

    def replace_runs(self, name: str, runs: DataFrame, rows: DataFrame) -> None:
        """The rows of ``runs``' runs (run_id) anew, also where a run has none any more."""
        kept = self.t[name].join(runs.select("run_id").distinct(), "run_id", "left_anti").select(self.t[name].columns)
        self.t[name] = kept.unionByName(aligned(rows, name))


RUN_MANIFEST = (
    "schema int, run_id string, experiment_id string, dataset_id string, timestamps struct<started:string,updated:string,ended:string>, git struct<commit:string,branch:string,dirty:boolean>, "
    "configuration map<string,string>, stages map<string,struct<status:string,start:string,`end`:string,duration_seconds:double,metrics:map<string,double>>>, "
    "artifacts array<struct<artifact_id:string,stage:string,path:string,sha256:string,size:long>>, warnings array<string>, errors array<string>, final_status string"
)


def read_run_manifests(spark: SparkSession, glob: str) -> DataFrame:
    """Run manifests, one JSON object a file. One that can't be read, or has no run_id, fails the read."""
    d = spark.read.schema(RUN_MANIFEST).option("multiLine", True).option("mode", "FAILFAST").json(glob)
    return d.withColumn("run_id", F.when(F.col("run_id").isNull(), F.raise_error(F.lit("a run manifest has no run_id"))).otherwise(F.col("run_id")))


def final_status(statuses: DataFrame, status: str = "status") -> DataFrame:
    """The worst of DEGRADED, WARN and PASS."""
    rank = F.when(F.col(status) == "DEGRADED", 2).when(F.col(status) == "WARN", 1).otherwise(0)
    return statuses.agg(F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("DEGRADED")), F.coalesce(F.max(rank), F.lit(0)) + 1).alias("status"))


def paginate(rows: DataFrame, key: str, offset: int, limit: int) -> DataFrame:
    return rows.orderBy(key).offset(offset).limit(limit)


def tail(rows: DataFrame, n: int, seq: str) -> DataFrame:
    """The last ``n`` rows by ``seq``, in order."""
    return rows.orderBy(F.desc(seq)).limit(n).orderBy(seq)


def key_difference(actual: Column, expected: Column) -> Column:
    """How two sets of keys stand to each other: (missing, extra, equal)."""
    missing, extra = F.array_sort(F.array_except(expected, actual)), F.array_sort(F.array_except(actual, expected))
    return F.struct(missing.alias("missing"), extra.alias("extra"), ((F.size(missing) == 0) & (F.size(extra) == 0)).alias("equal"))


def missing_parents(actual: Column, expected: Column) -> Column:
    return F.array_except(expected, actual)


def ordered_unique(*lists: Column) -> Column:
    return F.array_distinct(F.concat(*lists))


def cosine_schedule(spark: SparkSession, steps: int, warmup: int, high: float, low: float) -> DataFrame:
    """(step, lr) for steps 0 to ``steps``: linear warm-up, then half a cosine."""
    s = F.col("step")
    progress = (s - warmup) / float(max(steps - warmup, 1))
    lr = F.when(s < warmup, F.lit(high) * s / float(max(warmup, 1))).when(s >= steps, F.lit(low)).otherwise(F.lit(low) + F.lit(0.5 * (high - low)) * (1 + F.cos(F.lit(3.141592653589793) * progress)))
    return spark.range(steps + 1).select(F.col("id").alias("step"), lr.alias("lr"))


def duration_estimate(rows: DataFrame) -> DataFrame:
    """Adds events and seconds of a planned run. Columns: total_steps, batch_size, grad_accum, seq_len, tokens_per_sec, eval_every,
    checkpoint_every, eval_seconds, checkpoint_seconds; null seconds count as none, no speed gives null."""
    least = lambda c, k: F.greatest(F.lit(k), F.col(c))
    steps = least("total_steps", 0)
    evals = F.expr("greatest(0, total_steps) div greatest(1, eval_every)")
    saves = F.expr("greatest(0, total_steps) div greatest(1, checkpoint_every)")
    train = steps * least("batch_size", 1) * least("grad_accum", 1) * least("seq_len", 1) / F.col("tokens_per_sec")
    s = lambda c: F.greatest(F.lit(0.0), F.coalesce(F.col(c), F.lit(0.0)))
    d = rows.withColumns({"eval_count": evals + 1, "checkpoint_count": saves + evals + 1, "training_seconds": F.when(F.col("tokens_per_sec") > 0, train)})
    return d.withColumn("duration_seconds", F.col("training_seconds") + F.col("eval_count") * s("eval_seconds") + F.col("checkpoint_count") * s("checkpoint_seconds"))


def generation_metrics(rows: DataFrame, text: str = "text") -> DataFrame:
    """tokens, repetition_rate, distinct_1, distinct_2 over words, and repeated_runs of three or more equal words."""
    w = F.col("_w")
    two = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0))), lambda i: F.concat_ws("\x01", F.get(w, i), F.get(w, i + 1)))
    from ..functions.text import words

    d = rows.withColumn("_w", words(F.col(text)))
    n = F.size(w)
    one = F.when(n > 0, F.size(F.array_distinct(w)) / n).otherwise(0.0)
    pairs = F.when(n > 1, F.size(F.array_distinct(two)) / (n - 1)).otherwise(0.0)
    runs = F.regexp_count(F.col(text), F.lit("(?iuU)(\\b\\w+\\b)(?:\\s+\\1){2,}"))
    return d.withColumns({"tokens": n, "repetition_rate": F.round(F.when(n > 0, 1 - one).otherwise(1.0), 6), "distinct_1": F.round(one, 6), "distinct_2": F.round(pairs, 6), "repeated_runs": F.coalesce(runs, F.lit(0))}).drop("_w")


def loss_summary(rows: DataFrame, loss: str = "loss") -> DataFrame:
    """Mean loss and the perplexity of it, the loss counting as 20 at most."""
    return rows.agg(F.avg(loss).alias("loss")).withColumn("perplexity", F.exp(F.least(F.col("loss"), F.lit(20.0))))


