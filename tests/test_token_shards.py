"""Token shards through Spark's data source interface: round trip, retried tasks, refused files, streams."""

from __future__ import annotations

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.operators import packing
from loomtext.sources import token_shards as ts


def pieces(spark, n=60, size=50):
    docs = spark.range(n).select(F.lit("train").alias("part"), F.col("id").alias("seq"), F.transform(F.sequence(F.lit(0), F.pmod(F.col("id") * 7, F.lit(11)).cast("int")), lambda k: (F.col("id") * 3 + k).cast("int")).alias("tokens"))
    return packing.shard_pieces(docs, size), [(i * 3 + k) for i in range(n) for k in range(i * 7 % 11 + 1)]


def windows(tokens, size, length):
    out = []
    for s in range(0, len(tokens), size):
        shard = tokens[s : s + size]
        out += [(f"train_{s // size:05d}.bin", a, shard[a : a + length], shard[a + 1 : a + 1 + length]) for a in range(0, len(shard) - length, length)]
    return out


def rows(df):
    return sorted((r.name, r.at, list(r.x), list(r.y)) for r in df.collect())


@pytest.fixture
def written(spark, tmp_path):
    p, tokens = pieces(spark)
    folder = str(tmp_path / "shards")
    ts.write_token_shards(p, folder, sequence_length=8, vocab_size=500)
    return folder, tokens


def test_round_trip(spark, written, monkeypatch):
    folder, tokens = written
    m = ts.read_shard_manifest(folder)
    assert (m["version"], m["dtype"], m["sequence_length"], m["vocab_size"]) == (1, "uint16", 8, 500)
    assert sorted(os.listdir(folder)) == sorted([f["name"] for f in m["files"]] + [ts.MANIFEST])
    assert np.concatenate([np.fromfile(f"{folder}/{f['name']}", "<u2") for f in m["files"]]).tolist() == tokens
    assert rows(ts.read_token_shards(spark, folder)) == windows(tokens, 50, 8)
    assert rows(ts.read_token_shards(spark, folder, length=3)) == windows(tokens, 50, 3)
    more, _ = pieces(spark, 9)
    with pytest.raises(Exception, match="there already"):
        ts.write_token_shards(more, folder, sequence_length=8, vocab_size=500)
    assert rows(ts.read_token_shards(spark, folder)) == windows(tokens, 50, 8)
    ts.write_token_shards(more, folder, sequence_length=8, vocab_size=500, mode="overwrite")
    assert len(os.listdir(folder)) == len(ts.read_shard_manifest(folder)["files"]) + 1 == 3


def test_a_task_that_is_tried_again_leaves_one_file(spark, tmp_path):
    """The first attempt of a task dies after it has written its shard."""
    p, tokens = pieces(spark)
    batches = p.orderBy("shard", "at").toArrow().to_batches()
    folder = str(tmp_path / "shards")
    writer = ts.ShardWriter({"path": folder, "sequence_length": "8", "vocab_size": "500"}, False)
    lost, again = writer.write(iter(batches)), writer.write(iter(batches))
    assert lost.files == again.files and lost.folder != again.folder and not os.path.exists(f"{folder}/{ts.MANIFEST}")
    writer.commit([again])
    assert sorted(os.listdir(folder)) == sorted([f[0] for f in again.files] + [ts.MANIFEST])
    assert rows(ts.read_token_shards(spark, folder)) == windows(tokens, 50, 8)


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    p, _ = pieces(spark)
    for bad, message in ((p.withColumn("piece", F.transform("piece", lambda x: x + 400)), "outside the vocabulary"), (p.where("at > 0"), "follows")):
        folder = str(tmp_path / message[:3])
        with pytest.raises(Exception, match=message):
            ts.write_token_shards(bad, folder, sequence_length=8, vocab_size=500)
        assert not os.path.exists(folder) or os.listdir(folder) == []
    with pytest.raises(Exception, match="holds no ids"):
        ts.write_token_shards(p, str(tmp_path / "x"), sequence_length=8, vocab_size=70_000)
    with pytest.raises(Exception, match="no shards"):
        ts.write_token_shards(p.limit(0), str(tmp_path / "y"), sequence_length=8, vocab_size=500)


@pytest.mark.parametrize("case", ["corrupt", "short", "hashless", "gone", "no manifest"])
def test_bad_shards_are_refused(spark, written, case):
    folder, _ = written
    name = ts.read_shard_manifest(folder)["files"][1]["name"]
    raw = bytearray(open(f"{folder}/{name}", "rb").read())
    if case == "corrupt":
        raw[5] ^= 1
        open(f"{folder}/{name}", "wb").write(raw)
    elif case == "short":
        open(f"{folder}/{name}", "wb").write(raw[:-2])
    elif case == "gone":
        os.remove(f"{folder}/{name}")
    elif case == "hashless":
        m = ts.read_shard_manifest(folder)
        del m["files"][1]["sha256"]
        json.dump(m, open(f"{folder}/{ts.MANIFEST}", "w"))
    else:
        os.remove(f"{folder}/{ts.MANIFEST}")
    with pytest.raises(Exception, match="manifest|not there"):
        ts.read_token_shards(spark, folder).collect()


def test_stream_goes_on_where_it_was(spark, written, tmp_path):
    folder, tokens = written
    got = []
    for rounds in (1, 2):  # the second start goes one round on
        q = ts.stream_token_shards(spark, folder, windows_per_batch=10, rounds=rounds, seed=3).writeStream.foreachBatch(lambda b, k: got.append(rows(b))).option("checkpointLocation", str(tmp_path / "c")).start()
        q.processAllAvailable()
        q.stop()
        every = sorted(x for b in got for x in b)
        assert every == sorted(windows(tokens, 50, 8) * rounds)
        assert max(len(b) for b in got) <= 10 and len({x[0] for x in got[0]}) <= 3
