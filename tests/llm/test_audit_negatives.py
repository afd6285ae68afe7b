"""Filter audit and hard negatives: SQL on the given tables, brute force and replay on odd ones, rigour of the bounds."""

from __future__ import annotations

import itertools
import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.llm import audit, negatives, queries

from . import cases

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_filter_audit"])
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    mine, sql = queries.QUERIES[name](spark, SF).toPandas(), duck.execute(queries.ORACLE_SQL[name]).df()
    columns = sorted(mine.columns)
    assert columns == sorted(sql.columns) and len(mine) > 50
    assert sorted(map(tuple, mine[columns].astype(str).values)) == sorted(map(tuple, sql[columns].astype(str).values))


# filter audit


def fails(rows):
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, _, source, _ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        out.append((i, source or "", {x for x, y in f.items() if y}))
    return out


def replay(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    docs, out = fails(rows), {}
    for part in {p for _, p, _ in docs}:
        own = [(i, f) for i, p, f in docs if p == part]
        lost = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, x in enumerate(order):
                here = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                lost[x] += len(here)
                out[part, "".join(order), step + 1] = [
                    len(left), len(here), sum(x in f for _, f in own) - len(here), sum(f == {x} for _, f in own), sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)
                ]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(lost[order[step - 1]])
    return out


def test_audit_equals_a_replay_on_odd_rows(spark):
    rows = cases.odd_rows() + [(200 + i, "SAME Text $" * 9, None, s, 0) for i, s in enumerate(["", None, "a1", "a2", "a1"])] + [(3, "one two", "en", "a4", 0), (7, "one two", "en", "a4", 0)]
    labels = [(1, 1, 0), (1, None, 1), (2, 1, 1), (5, 0, 1), (9, None, None), (None, 1, 1), (7, 1, 0), (204, 1, 5), (203, 1, 1)]
    docs = cases.clashing(spark.createDataFrame(rows, cases.SCHEMA))
    got = audit.filter_audit(docs, cases.clashing(spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumnRenamed("toxic", "bad")).drop("toxic").withColumnRenamed("bad", "toxic"))
    mine = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got.collect()}
    assert mine == replay(rows, labels)
    assert audit.filter_audit(cases.empty(spark), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_shares_are_the_exact_integrals(spark):
    """Any counts: corners against inclusion, shares against averages over orders."""
    r = np.random.default_rng(3)
    n = r.integers(0, 50, 32)
    counts = spark.createDataFrame([("p", m, int(n[m]), int(n[m]) // 2, 0) for m in range(32) if n[m]], "part string, mask int, n long, good long, toxic long")
    got = {(x.filter_order, x.step): x for x in audit.audit_steps(counts, "ABCDE").collect()}
    assert len(got) == 600
    for (order, step), x in got.items():
        before = sum(1 << "ABCDE".index(c) for c in order[: step - 1])
        f = 1 << "ABCDE".index(order[step - 1])
        assert x.kept == sum(n[m] for m in range(32) if not m & (before | f))
        assert x.shapley == sum(int(n[m]) * math.factorial(5) // m.bit_count() for m in range(1, 32) if m & f)


# hard negatives


def brute(rows, positives=5, negatives=5):
    kept = {(i, lab, tuple(math.floor(256 * float(x)) for x in v)) for i, lab, v in rows if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, lab, v in kept:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, x) for j, x, w in kept if j != i)
        for s, j, x in [t for t in scored if t[2] == lab][:positives]:
            p = -s
            inside = [(j2, -s2) for s2, j2, x2 in scored if x2 != lab and 80 * p <= 100 * -s2 <= 100 * p][:negatives]
            out += [(i, j, k + 1, j2, p, n) for k, (j2, n) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({c: F.lit("clash") for c in ("id", "v", "row", "chunk", "block", "codes", "rest", "top", "rank")})
    return sorted(tuple(r) for r in negatives.hard_negatives(df, **more).collect())


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK", 150)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    r = np.random.default_rng(7)
    rows = [(i, int(r.integers(0, 3)), (r.standard_normal(7) * r.choice([0.2, 1.0])).round(1).tolist()) for i in range(700)]
    rows += [(1000 + i, 1, [0.3] * 7) for i in range(300)] + [(2000, 1, [0.3] * 7), (2100, 2, [0.3] * 7), (2200, 2, [-0.3] * 7), (2300, 0, [0.0] * 7)]  # equal vectors, negative and zero scores
    rows += [(i, 2, [float("nan")] * 7) for i in (800, 801)] + [(802, None, [1.0] * 7), (803, 1, None), (804, 1, [1.0, None] * 3 + [1.0]), (805, 1, [float("inf")] * 7), (None, 1, [1.0] * 7), (806, 1, []), (807, 1, [9.0])]
    expected = brute([x for x in rows if x[0] != 807])
    assert mined(spark, rows) == expected and len(expected) > 100
    assert mined(spark, rows + rows[:200]) == expected  # repeated rows
    for few in (rows[:1], rows[100:103], rows[:0]):
        assert mined(spark, few) == brute(few)


def test_negatives_of_repeated_ids(spark):
    r = np.random.default_rng(8)
    rows = [(int(i), int(r.integers(0, 2)), r.standard_normal(4).round(2).tolist()) for i in r.integers(0, 40, 300) * 50]
    got, expected = mined(spark, rows), brute(rows)
    assert got == expected and len({x[0] for x in got}) > 5


def test_bounds_hold_and_prune():
    r = np.random.default_rng(9)
    x = np.floor(256 * r.standard_normal((3000, 64)) / 8)
    q = negatives.fit_quantiser(x[:1000])
    codes, rest = q.encode(x)
    block = negatives.Block(np.arange(3000), np.arange(3000), np.zeros(3000), x, codes, rest)
    for i, low, high in block.bounds(q, x[:50]):
        exact = x @ x[i]
        assert (low <= exact).all() and (exact <= high).all()
        assert (high >= negatives._least(low, 6)).mean() < 0.2
