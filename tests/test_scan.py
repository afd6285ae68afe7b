"""Scans by levels and runs, against running sums and the window form."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomtext.operators import packing, scan, signals


@pytest.mark.parametrize("bits", [2, 5, 12])
def test_running_sums_at_any_level(spark, bits):
    r = random.Random(1)
    places = r.sample(range(-3000, 3000), 500) + [1 << 40, -(1 << 40), (1 << 62), 7000]
    rows = [(r.choice(["a", "b", None]), p, r.randrange(100)) for p in places]
    got = {(x.part, x.seq): x.start for x in scan.running_sums(spark.createDataFrame(rows, "part string, seq long, n int"), F.col("n"), part="part", seq="seq", bits=bits).collect()}
    totals, want = {}, {}
    for part, seq, n in sorted(rows, key=lambda x: x[1]):
        want[part, seq] = totals.get(part, 0)
        totals[part] = want[part, seq] + n
    assert got == want


def test_three_levels_at_a_thousand_million_places(spark, capsys):
    assert scan.levels_for(0, 10**9) == 2 and scan.levels_for(0, 10**9, 9) == 3 and scan.levels_for(0, 4095) == 1 and scan.levels_for(-(1 << 63), (1 << 63) - 1) == 5
    df = spark.range(10**9).select(F.lit("x").alias("part"), F.col("id").alias("seq"))
    sums = scan.running_sums(df, F.lit(1), part="part", seq="seq", levels=3)
    sums.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count(") Window") >= 4  # the rows' and three levels'
    assert packing.offsets(df.limit(0), F.lit(1)).count() == 0


@pytest.mark.parametrize("rows_per_run", [7, 30, 10_000])
def test_rolling_gate_equals_the_window(spark, rows_per_run):
    r = random.Random(3)
    rows = [(f"d{d}" if d else None, s, None if r.random() < 0.05 else round(r.random() * (0.8 if d % 3 else 1), 3), s % 7) for d in range(5) for s in r.sample(range(1000), r.choice([3, 19, 20, 21, 70]))]
    rows += [("hot", s, 0.36 if s < 260 else 0.1, 0) for s in range(400)]
    df = spark.createDataFrame(rows, "domain string, seq long, score double, extra int").repartition(3)
    for window, least in ((20, 10), (5, 1), (1, 3)):
        key = lambda x: tuple((v is not None, v) for v in x)
        want = sorted((tuple(x) for x in signals.signal_gate(df, window=window, least=least).collect()), key=key)
        got = sorted((tuple(x) for x in scan.rolling_gate(df, window=window, least=least, rows_per_run=rows_per_run).collect()), key=key)
        assert got == want and any(x[0] == "hot" for x in want)
    assert scan.rolling_gate(df.limit(0)).count() == 0


def test_one_domain_spreads_over_tasks(spark):
    df = spark.range(100_000).select(F.lit("one").alias("domain"), F.col("id").alias("seq"), F.lit(0.5).alias("score"))
    got = scan.rolling_gate(df, rows_per_run=5_000)
    sizes = [x["count"] for x in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 100_000 and got.agg(F.max("page_no")).first()[0] == 100_000
