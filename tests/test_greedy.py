"""Greedy representatives in blocks and as a stream, and the metric self-join, against plain replays and full products."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.operators import dedup, greedy, metric
from loomtext.streaming.representatives import Representatives, representatives_stream

WORDS = [f"w{k}" for k in range(400)]


def family(r, n, edits):
    """Texts that come of one another by edits: near copies in a chain, so that representatives change hands."""
    words, out = [r.choice(WORDS) for _ in range(60)], []
    for _ in range(n):
        for _ in range(edits):
            words[r.randrange(60)] = r.choice(WORDS)
        out.append(" ".join(words))
    return out


def grams(text):
    t = text.lower().split()
    return {" ".join(t[i : i + 3]) for i in range(max(0, len(t) - 2))} or set(t)


def replay(rows, threshold):
    slots = []
    for seq, text, weight in rows:
        own = grams(text)
        for s in slots:
            other = grams(s[2])
            if own and other and len(own & other) / len(own | other) >= threshold:
                if weight > s[3]:
                    s[1:] = [seq, text, weight]
                break
        else:
            slots.append([seq, seq, text, weight])
    return sorted((s[0], s[1]) for s in slots)


def corpus(seed, families=6, length=25):
    r = random.Random(seed)
    texts = [t for _ in range(families) for t in family(r, length, 1)] + ["", "", "one two", "one two", "one"] + [" ".join(r.choice(WORDS) for _ in range(40)) for _ in range(20)]
    texts += [r.choice(texts) for _ in range(40)]
    r.shuffle(texts)
    return [(k, t, r.choice([1.0, 1.0, 2.0, 3.0, 0.5])) for k, t in enumerate(texts)]


@pytest.mark.parametrize("block_rows", [12, 100_000])
def test_texts_in_blocks_equal_the_replay(spark, block_rows):
    rows = corpus(1)
    docs = spark.createDataFrame(rows, "seq long, text string, final_weight double")
    for threshold in (0.6, 0.9):
        got = sorted((r.slot, r.seq) for r in dedup.resolve_similar(docs, threshold, block_rows=block_rows).collect())
        assert got == replay(rows, threshold)
    assert dedup.resolve_similar(docs.limit(0), 0.8).count() == 0


def test_vectors_in_blocks_equal_the_replay(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((6, 6))
    x = np.repeat(base, 40, axis=0) + 0.25 * r.standard_normal((240, 6))
    x[50], x[51], x[52] = x[10], 2 * x[10], 0
    order = r.permutation(len(x))
    rows = [(k, x[i].tolist(), float(r.integers(0, 4))) for k, i in enumerate(order)]
    slots, unit = [], [np.array(v) / max(np.linalg.norm(v), 1e-10) for _, v, _ in rows]
    for k, _, w in rows:
        s = [unit[j] @ unit[k] for j in slots]
        if s and max(s) >= 0.9 - 1e-6:
            best = int(np.argmax(np.array(s) >= max(s) - 1e-12))
            if w > rows[slots[best]][2]:
                slots[best] = k
        else:
            slots.append(k)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, final_weight double")
    for block_rows in (60, 100_000):
        assert sorted(r.seq for r in dedup.resolve_embeddings(df, 0.9, block_rows=block_rows).collect()) == sorted(slots)


def test_one_component_of_many_rows(spark, monkeypatch):
    """100,000 rows of one chain of near copies: no task holds more than a block and the representatives near it."""
    n, held = 100_000, 25_000
    docs = spark.range(n).select(F.col("id").alias("seq"), F.pmod(F.xxhash64("id"), F.lit(5)).cast("double").alias("final_weight"), (F.col("id") / 20).cast("long").alias("cls"))
    values = docs.select("cls").distinct().withColumn("value", F.sequence(F.col("cls"), F.col("cls") + 9))
    last = n // 20 - 1
    pairs = spark.range(last).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    plain = greedy.replay_sets(0.8)

    def watched(seq, weight, cls, slots, by):
        assert len(seq) <= held and len(slots) <= 400, (len(seq), len(slots))
        return plain(seq, weight, cls, slots, by)

    rows = docs.withColumnRenamed("final_weight", "weight").withColumn("cls", F.when(F.col("cls") > last, last).otherwise(F.col("cls")))
    whole = sorted((r.seq, r.weight, r.cls) for r in rows.collect())
    expected = plain(np.array([x[0] for x in whole]), np.array([x[1] for x in whole]), np.array([x[2] for x in whole]), [], {c: np.arange(c, c + 10) for c in range(last + 1)})
    got = sorted((r.slot, r.seq) for r in greedy.representatives(rows, values, pairs, watched, block_rows=held).collect())
    assert got == sorted((s[0], s[1]) for s in expected)


@pytest.mark.parametrize("cuts", [[0, 231], [0, 1, 2, 90, 231], [0, 60, 120, 180, 231]])
def test_any_cut_into_batches_gives_the_same(spark, tmp_path, cuts):
    rows = corpus(3)[:231]
    state = Representatives(str(tmp_path / "state"), threshold=0.7)
    batches = [spark.createDataFrame(rows[a:b], "seq long, text string, final_weight double") for a, b in zip(cuts, cuts[1:])]
    for k, b in enumerate(batches):
        state.advance(b, k)
    assert sorted((r.slot, r.seq) for r in state.table(spark).collect()) == replay(rows, 0.7)
    state.advance(batches[-1], len(batches) - 1)  # a batch that comes again
    assert sorted((r.slot, r.seq) for r in state.table(spark).collect()) == replay(rows, 0.7)
    assert len(state.versions(spark)) <= 2
    with pytest.raises(ValueError, match="worked off"):
        state.advance(batches[-1], len(batches))


def test_the_stream_restarts_where_it_was(spark, tmp_path):
    rows = corpus(4)[:120]
    kind = "seq long, text string, final_weight double"
    source, state = str(tmp_path / "in"), Representatives(str(tmp_path / "state"), threshold=0.7)
    for a, b in ((0, 70), (70, 120)):
        spark.createDataFrame(rows[a:b], kind).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(kind).parquet(source)
        q = representatives_stream(stream, state, str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    assert sorted((r.slot, r.seq) for r in state.table(spark).collect()) == replay(rows, 0.7)


def planted(seed, n, d, clusters, noise):
    r = np.random.default_rng(seed)
    c = r.standard_normal((clusters, d))
    x = c[r.integers(0, clusters, n)] / np.sqrt(d) + noise * r.standard_normal((n, d)) / np.sqrt(d)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("case", ["clusters", "dense cell", "isotropic"])
def test_metric_cells_lose_no_pair(spark, case, monkeypatch):
    monkeypatch.setattr(metric, "BLOCK", 64)
    x, t = {"clusters": lambda: (planted(1, 1500, 16, 30, 0.15), 0.95), "dense cell": lambda: (np.concatenate([planted(2, 900, 8, 1, 0.4), planted(3, 300, 8, 9, 0.1)]), 0.98), "isotropic": lambda: (planted(4, 600, 24, 600, 1.0), 0.5)}[case]()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    cells = metric.metric_cells(df, t, cell_rows=100)
    got = sorted((r.a, r.b) for r in metric.pairs_in_cells(cells, t).collect())
    s = x @ x.T
    i, j = np.nonzero(np.triu(s >= t - 1e-6, 1))
    assert got == sorted(zip(i.tolist(), j.tolist()))
    every, compared = len(x) * (len(x) - 1) // 2, metric.pairs_compared(cells)
    assert compared <= (1 if case == "isotropic" else 0.6) * every, (compared, every)
    assert metric.metric_cells(df.limit(0), t).count() == 0


def test_cosine_pairs_of_equal_directions(spark):
    rows = [(5, [1.0, 0.0]), (1, [2.0, 0.0]), (9, [1.0, 0.01]), (3, [0.0, 0.0]), (4, [0.0, 0.0]), (7, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((r.a, r.b) for r in dedup.cosine_pairs(df, 0.9).collect()) == [(1, 5), (1, 9), (5, 9)]
