"""Hashes, manifests and the skipping of stages whose inputs and configuration haven't changed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = 2


def stable_hash(value) -> str:
    """sha256 of a value's compact JSON with sorted keys; what JSON doesn't know counts by its text."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def artifact_id(kind: str, sha256: str) -> str:
    return f"{kind}:{sha256}"


def experiment_id(config: dict) -> str:
    return f"exp:{stable_hash(config)[:16]}"


def config_identities(config: dict, sections: tuple[str, ...] = ("crawl", "clean", "embed_dedup", "weight", "tokenizer", "train")) -> dict[str, str]:
    """A hash for each section that is there, and one of the whole."""
    return {s: stable_hash(config[s]) for s in sections if s in config} | {"source": stable_hash(config)}


def snapshot_configs(spark: SparkSession, folder: str, config: dict) -> dict[str, str]:
    """Each section as a JSON file named by its hash; one that is there already is left as it is. Names of the files by section."""
    out = {}
    for name, section in sorted(config.items()):
        out[name] = f"{name}-{stable_hash(section)}.json"
        path, fs = _path(spark, f"{folder}/{out[name]}")
        if not fs.exists(path):
            write_run_manifest(spark, f"{folder}/{out[name]}", section)
    return out


def content_hash(df: DataFrame) -> dict:
    """Rows and a hash of the content that doesn't depend on the order of rows: what a folder has in place of a file's hash."""
    h = F.xxhash64(*[F.col(c) if not t.startswith("map") else F.to_json(c) for c, t in df.dtypes])
    other = F.xxhash64(F.lit(1), *[F.col(c) if not t.startswith("map") else F.to_json(c) for c, t in df.dtypes])
    r = df.agg(F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("a"), F.sum(other.cast("decimal(38,0)")).alias("b")).first()
    return {"rows": r.n, "sha256": hashlib.sha256(f"{r.n}:{r.a}:{r.b}".encode()).hexdigest()}


def _path(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(uri)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_stage(df: DataFrame, folder: str, kind: str, provenance: dict) -> dict:
    """Write to a new folder beside ``folder``, check that it has rows, then put it in place with its manifest."""
    spark, staging = df.sparkSession, f"{folder}.staging"
    df.write.mode("overwrite").parquet(staging)
    made = content_hash(spark.read.parquet(staging))
    (src, fs), (dst, _) = _path(spark, staging), _path(spark, folder)
    if not made["rows"]:
        fs.delete(src, True)
        raise ValueError(f"{kind}: an artefact without rows is not written")
    before, _ = _path(spark, f"{folder}.before")
    fs.delete(before, True)
    if fs.exists(dst):  # set aside, not deleted: at every moment one of the two names holds a whole artefact
        fs.rename(dst, before)
    fs.rename(src, dst)
    fs.delete(before, True)
    manifest = {"schema": MANIFEST_SCHEMA, "kind": kind, "provenance": provenance} | made
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}.manifest")
    return manifest


def read_manifest(spark: SparkSession, folder: str) -> dict | None:
    p, fs = _path(spark, f"{folder}.manifest")
    return json.loads(spark.read.text(f"{folder}.manifest").first().value) if fs.exists(p) else None


def up_to_date(spark: SparkSession, folder: str, provenance: dict, verify: bool = True) -> bool:
    """Whether the folder holds what its manifest says, made with the same provenance."""
    m = read_manifest(spark, folder)
    if m is None or m["provenance"] != provenance or m["schema"] != MANIFEST_SCHEMA:
        return False
    return not verify or content_hash(spark.read.parquet(folder)) == {"rows": m["rows"], "sha256": m["sha256"]}


def run_stage(spark: SparkSession, folder: str, kind: str, provenance: dict, make) -> tuple[DataFrame, bool]:
    """The stage's table, made anew unless it is up to date; and whether it was skipped."""
    if up_to_date(spark, folder, provenance):
        return spark.read.parquet(folder), True
    write_stage(make(), folder, kind, provenance)
    return spark.read.parquet(folder), False


def _plain(value, kind: pa.DataType):
    """An Arrow value as JSON knows it: maps as objects."""
    if value is None:
        return None
    if pa.types.is_map(kind):
        return {k: _plain(v, kind.item_type) for k, v in value}
    if pa.types.is_struct(kind):
        return {f.name: _plain(value[f.name], f.type) for f in kind}
    if pa.types.is_list(kind):
        return [_plain(v, kind.value_type) for v in value]
    return value


def record_hash(*columns: str) -> Column:
    """sha256 of a record's columns as canonical JSON (compact, keys in order, nulls kept, no escapes beyond JSON's own), as a column."""

    def run(records: pa.Array) -> pa.Array:
        texts = (json.dumps(_plain(r, records.type), sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in records.to_pylist())
        return pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts], pa.string())

    run.__annotations__ = {"records": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "string")(F.struct(*[F.col(c) for c in columns]))


def source_hashes(rows: DataFrame, source: str, seq: str, *columns: str) -> DataFrame:
    """(source, records, source_sha256): sha256 over a source's records as canonical JSON lines, in order of ``seq``.

    The hash runs over a source's bytes one after the other, so a source is one sorted stretch that a task reads through, a batch at a time; ``signals.content_fold`` is the form
    whose work spreads. A null source is one too.
    """
    d = rows.select(F.col(source).alias("source"), F.col(seq).alias("_seq"), F.struct(*[F.col(c) for c in columns]).alias("record"))
    d = d.repartition("source").sortWithinPartitions("source", "_seq").select("source", "record")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, digest = None, 0, hashlib.sha256()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.string()), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])], names=["source", "records", "source_sha256"])

        for batch in batches:
            kind = batch.column(1).type
            for name, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n and name != now:
                    yield out()
                    n, digest = 0, hashlib.sha256()
                now, n = name, n + 1
                digest.update(json.dumps(_plain(record, kind), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode("utf-8", "surrogatepass") + b"\n")
        if n:
            yield out()

    return d.withColumn("source", F.col("source").cast("string")).mapInArrow(run, "source string, records long, source_sha256 string")


def new_run(config: dict, *, run_id: str, dataset_id: str, started: str, git: dict | None = None) -> dict:
    """A run manifest as a run begins."""
    return {
        "schema": MANIFEST_SCHEMA, "run_id": run_id, "experiment_id": experiment_id(config), "dataset_id": dataset_id, "timestamps": {"started": started, "updated": started, "ended": None}, "git": git or {},
        "configuration": {k: stable_hash(v) for k, v in sorted(config.items())}, "stages": {}, "artifacts": [], "warnings": [], "errors": [], "final_status": "RUNNING",
    }


def write_run_manifest(spark: SparkSession, uri: str, manifest: dict) -> None:
    """The manifest as one file, put in place by one rename over the old one, so a reader sees either of them whole at any moment."""
    (dst, fs), (tmp, _) = _path(spark, uri), _path(spark, f"{uri}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray((json.dumps(manifest, indent=2, sort_keys=True, default=str) + "\n").encode()))
    out.close()
    hadoop, gateway = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    over = gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(dst.toUri() if dst.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(tmp, dst, over)


def resume_run(spark: SparkSession, uri: str, updated: str) -> dict:
    """A run's manifest read again, running as of ``updated``; one of another schema is an error."""
    m = json.loads("\n".join(r.value for r in spark.read.text(uri, wholetext=True).collect()))
    if m.get("schema") != MANIFEST_SCHEMA:
        raise ValueError(f"unsupported run manifest: {uri}")
    m["timestamps"]["updated"], m["final_status"] = updated, "RUNNING"
    write_run_manifest(spark, uri, m)
    return m


def lineage_checks(manifests: dict[str, dict | None], hashes: dict[str, str]) -> list[tuple[str, str, str]]:
    """(name, status, detail): whether the manifests of source, weighted corpus, tokenizer, shards, checkpoint and export belong together.

    ``manifests`` by these names, a missing one None; ``hashes``: sha256 of the artefacts as they are (weighted, tokenizer, shard files by name, checkpoint) and of the
    manifests themselves under NAME.manifest. Checks end early where later ones would have nothing to stand on.
    """
    out: list[tuple[str, str, str]] = []
    say = lambda name, good, detail="", bad="FAIL": out.append((name, "PASS" if good else bad, str(detail)))
    m = {k: manifests.get(k) for k in ("source", "weighted", "tokenizer", "shards", "checkpoint", "export")}
    for k in ("source", "weighted", "tokenizer", "shards"):
        say(f"{k} manifest", m[k] is not None)
    if any(s == "FAIL" for _, s, _ in out):
        return out
    for k in ("weighted", "tokenizer"):
        say(f"{k} artefact", m[k].get("sha256") == hashes.get(k), m[k].get("sha256", ""))
    files = m["shards"].get("files", [])
    say("shard artefacts", all(f.get("sha256") and f["sha256"] == hashes.get(f.get("name")) for f in files), f"{len(files)} files")
    if m["checkpoint"]:
        say("checkpoint", m["checkpoint"].get("sha256") == hashes.get("checkpoint"))
    if m["source"].get("schema") not in (2, 3) or not m["source"].get("run_id") or not m["source"].get("source_definition_sha256"):
        say("configuration", False, "no configuration identity")
        return out
    defs = {k: v.get("sha256") for k, v in (m["source"].get("source_definition_files") or {}).items() if isinstance(v, dict)}
    say("source configuration", stable_hash(defs) == m["source"]["source_definition_sha256"])
    if m["export"] and m["checkpoint"]:
        say("export to checkpoint", m["export"].get("checkpoint_sha256") == hashes.get("checkpoint"))
    if not m["checkpoint"]:
        say("checkpoint lineage", False, "no checkpoint", "WARN")
        return out
    cp = m["checkpoint"].get("provenance") or {}
    if int(cp.get("schema", -1)) < 3:
        say("checkpoint lineage", False, "made before lineage was kept by stage", "LEGACY")
        return out
    snapshots, ids = cp.get("config_snapshots") or {}, cp.get("config_identities") or {}
    say("configuration snapshots", bool(snapshots) and all(str(p) in hashes for p in snapshots.values()), len(snapshots))
    for k, key in (("weighted", "dataset_config_sha256"), ("tokenizer", "tokenizer_config_sha256"), ("shards", "shard_config_sha256")):
        p = m[k].get("provenance") or {}
        own = (p.get("config_identities") or {}).get(key)
        say(f"{k} lineage", bool(ids.get(key)) and own == ids.get(key) and p.get("run_id") == cp.get("run_id"), own)
    say("checkpoint to source", cp.get("source_manifest_sha256") == hashes.get("source.manifest") and m["source"]["run_id"] == cp.get("run_id"))
    say("checkpoint to shards", cp.get("shard_manifest_sha256") == hashes.get("shards.manifest"))
    say("shards to tokenizer", (m["shards"].get("provenance") or {}).get("tokenizer_sha256") == hashes.get("tokenizer"))
    parents = {artifact_id(kind, hashes.get(f"{k}.manifest", "")) for kind, k in (("shard-manifest", "shards"), ("tokenizer-manifest", "tokenizer"), ("dataset-manifest", "weighted"), ("source-manifest", "source"))}
    say("parents", parents <= set(cp.get("parent_artifact_ids") or []), len(parents))
    say("overall", all(s == "PASS" for _, s, _ in out))
    return out


def append_event(spark: SparkSession, folder: str, event: dict) -> None:
    spark.createDataFrame([(json.dumps(event, sort_keys=True),)], "value string").coalesce(1).write.mode("append").text(folder)
