"""Work that has to grow no faster than the input: what is computed once a row, and rows dealt over all cores."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.functions import text as T
from loomtext.operators import dedup, encode, graph, metric
from loomtext.plans.registry import QUERIES
from loomtext.session import longest, spread, table


def optimised(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["weight_expand_whole", "weight_resample", "final_weight"])
def test_scores_and_types_are_computed_once_a_row(spark, sf, name):
    plan = optimised(QUERIES[name](spark, sf))
    assert plan.count("cookie policy") == 2  # the search for its letters and the pattern, of one quality score


def test_longest_share():
    assert longest([10], 4) == 10 and longest([5, 5, 5, 5], 2) == 10 and longest([9, 1, 1], 2) == 9


def test_rows_of_one_row_group_are_dealt_over_all_cores(spark):
    d = table(spark, "/root/testdata/sf0.1", "documents")  # one row group, in a file that is cut into several splits
    n = spark.sparkContext.defaultParallelism
    rows = [r["count"] for r in spread(d).groupBy(F.spark_partition_id().alias("k")).count().collect()]
    assert sum(rows) == d.count() and longest(rows, n) * n <= 1.25 * sum(rows)


def test_candidates_that_prefixes_rule_out_exchange_no_sets(spark):
    """Sets that share one rare gram of long prefixes can't be similar: they are not compared, and the pairs are those of all candidates."""
    body = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    rows = [(k, f"alpha beta gamma {body(k, 200)}") for k in range(20)] + [(100 + k, f"{body('s', 100)} t{k}") for k in range(5)] + [(200, "a b c d e f"), (201, "a b c d e f g")]
    _, sets = dedup.gram_classes(spark.createDataFrame(rows, "seq long, text string"))
    sets = sets.localCheckpoint()
    for t in (0.5, 0.8, 0.92):
        common = np.zeros(0, np.int64)
        old = dedup.pairs_by_prefix(dedup.prefixes(sets, t, common), sets, t)
        new = dedup.pairs_by_prefix(dedup.prefixes(sets, t, common, ends=True), sets, t)
        assert sorted(old.collect()) == sorted(new.collect()) and new.count() >= 10
    met = dedup.candidates(dedup.prefixes(sets, 0.8, common, ends=True), 0.8)
    assert met.where("a < 100").count() == 0


def test_texts_are_encoded_in_steps_of_bounded_size(monkeypatch):
    monkeypatch.setattr(encode, "STEP_CHARS", 10)
    assert list(encode._steps([])) == []
    assert list(encode._steps(["aaaa", "bbbb", "cccc", "d" * 50, "", "e"])) == [["aaaa", "bbbb"], ["cccc"], ["d" * 50], ["", "e"]]


def _vectors(spark, v):
    return spark.createDataFrame([(k, [float(y) for y in x]) for k, x in enumerate(v)], "vec_id long, embedding array<float>")


def _brute(v, k):
    v = np.asarray(v, "f4").astype("f8")
    v = v / np.maximum(np.sqrt(np.cumsum(v * v, axis=1)[:, -1:]), 1e-10)
    s = np.stack([np.cumsum(v * x, axis=1)[:, -1] for x in v])
    np.fill_diagonal(s, -np.inf)
    return [(i, int(j), r + 1) for i in range(len(v)) for r, j in enumerate(np.lexsort((np.arange(len(v)), -s[i]))[:k])]


@pytest.mark.parametrize("block", [16, 100_000])
def test_nearest_rows_with_copies_zeros_and_ties_in_blocks(spark, monkeypatch, block):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(120, 6)).astype("f4")
    v[40:70] = v[7]  # more copies than neighbours asked for
    v[80:83] = v[9]
    v[90:94] = 0
    v[100:112] = np.eye(6, dtype="f4")[np.arange(12) % 6]  # equal products of different rows
    monkeypatch.setattr(metric, "BLOCK", block)
    monkeypatch.setattr(metric, "PRODUCT", 500)
    got = sorted((r.id, r.neighbour, r.rank) for r in dedup.cosine_topk(_vectors(spark, v), 5).collect())
    assert got == sorted((i, j, r) for i, j, r in _brute(v, 5))


def test_copies_are_no_rows_of_the_product(spark):
    plan = dedup.cosine_topk(_vectors(spark, np.repeat(np.eye(4), 50, axis=0)), 5)
    assert plan.count() == 1000 and plan.where("rank = 1 and neighbour % 50 > 1").count() == 0


def test_products_of_large_groups_stay_small():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(30_000, 8)), rng.normal(size=(4096, 8))
    x, y = (a / np.linalg.norm(a, axis=1)[:, None] for a in (x, y))
    tracemalloc.start()
    n = sum(len(ids) for ids, *_ in metric.nearest(x, np.arange(30_000), y, np.arange(30_000, 34_096), 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 150_000 and peak < 100e6  # all products at once take a gigabyte, their order as much again


def test_how_often_a_vector_is_copied(spark):
    sizes = spark.createDataFrame([(10,), (10_256,), (102_564,), (615_384,)], "n long")
    got = [r[0] for r in sizes.select(metric.n_blocks(F.col("n"), 12)).collect()]
    assert got == [1, 5, 5, 19]  # blocks of 2,048 rows: 301 copies of the last


def test_pairs_come_in_pieces(spark, monkeypatch):
    """A block of rows that are all alike gives its pairs piece by piece, and all of them."""
    monkeypatch.setattr(metric, "PRODUCT", 1000)
    rng = np.random.default_rng(5)
    v = np.ones((300, 8)) + rng.normal(size=(300, 8)) / 100
    assert dedup.cosine_pairs(_vectors(spark, v), 0.9).distinct().count() == 300 * 299 // 2


def test_edges_are_contracted_before_they_are_exchanged(spark, monkeypatch):
    monkeypatch.setattr(graph, "PIECE", 700)
    rng = np.random.default_rng(6)
    e = [(int(a), int(b)) for a, b in rng.integers(0, 60, (3000, 2))] + [(100 + k, 101 + k) for k in range(50)] + [(7, 7)]
    edges = spark.createDataFrame(e, "a long, b long").coalesce(1)
    assert graph.contracted(edges).count() < 500
    assert {r.node: r.root for r in graph.components(edges).collect()} == {k: 0 for k in range(60)} | {100 + k: 100 for k in range(51)}


def test_fast_classes_hold_the_same_characters(spark):
    """Every code point, by the classes as they are and as one would write them down."""
    plain = {
        T.SPACE: "[\\s\\x1c-\\x1f\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+",
        T.CONTROL: "[\\p{Cc}\\p{Cf}&&[^\\n\\t]]",
        T.PLAIN: "[\\x00-\\x9f\\u00a1-\\u00a7\\u00a9\\u00ab-\\u00ae\\u00b0\\u00b1\\u00b6\\u00b7\\u00bb\\u00bf-\\u0131\\u0134-\\u013e\\u0141-\\u0148\\u014a-\\u017e]",
    }
    d = spark.createDataFrame([(chr(k),) for k in range(0x110000) if not 0xD800 <= k < 0xE000], "c string")
    got = d.agg(*[F.sum((F.col("c").rlike(a) != F.col("c").rlike(b)).cast("int")) for a, b in plain.items()], *[F.sum(F.col("c").rlike(a).cast("int")) for a in plain]).first()
    assert list(got[:3]) == [0] * 3 and all(n > 10 for n in got[3:])


def test_texts_are_split_once_for_shards(spark, sf):
    plan = optimised(QUERIES["shard_pieces"](spark, sf))
    assert "split(" not in plan  # the tokens are laid down, and read by the sums and by the cuts
