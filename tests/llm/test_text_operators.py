"""Decontamination, line dedup, mixing, neighbours: against brute force on small tables."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.llm import ann, common, decontam, lines, mixing

from . import cases


def word_list(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def shingles(w, k):
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]


def brute_contamination(docs, items, t=0.8):
    out = {}
    for doc, text in docs:
        for item, body in items:
            w = word_list(body)
            if not w:
                continue
            k = min(5, len(w))
            mine, m = shingles(word_list(text), k), len(w) - k + 1
            best = None
            for s in range(max(1, len(mine) - m + 1)):
                a, b = collections.Counter(mine[s : s + m]), collections.Counter(shingles(w, k))
                i = sum((a & b).values())
                sim = i / (a.total() + b.total() - i)
                if i and sim >= t - 1e-12 and (best is None or sim > best[1] + 1e-12):
                    best = (s, sim)
            if best:
                out[doc, item] = (best[0], round(best[1], 9))
    return out


def test_decontamination_equals_brute_force(spark):
    item = cases.prose(500, 40)
    edited = item.split()
    edited[2] = "edited"
    repeated = " ".join(["again and again and"] * 8)
    items = [(1, item), (2, "short one"), (3, ""), (4, None), (5, cases.prose(501, 25)), (6, repeated), (7, "so sea saw see sow")]
    docs = [
        (1, cases.prose(1) + " " + item.upper() + "! " + cases.prose(2)), (2, cases.prose(3) + " " + " ".join(edited) + " " + cases.prose(4)), (3, " ".join(item.split()[:20])), (4, None), (5, ""),
        (6, "a very short one indeed"), (7, item), (8, cases.prose(5)), (9, repeated + " and again " + cases.prose(501, 25).replace(" ", ", ")), (10, "So sea; saw see SOW"), (11, " ".join(item.split()[:38])),
    ]
    want = brute_contamination(docs, items)
    d = cases.clashing(spark.createDataFrame([*docs, docs[0]], "doc_id long, text string"))
    b = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    got = [((r.doc_id, r.item_id), (r.start, round(r.similarity, 9))) for r in decontam.contaminated(d, b).collect()]
    assert dict(got) == want and len(got) == len(want) >= 8
    assert {k for k in want if k[0] == 8} == set()
    assert decontam.contaminated(cases.empty(spark), b).count() == 0 == decontam.contaminated(d, b.limit(0)).count()
    assert decontam.contaminated(cases.odd(spark), b).count() == 0


def test_fingerprints_of_wide_lanes_are_the_same(spark):
    h = spark.createDataFrame([([5, -7, 1 << 40, 5],), ([],), ([-1],)], "h array<long>")
    r = h.select(decontam.fingerprint(F.col("h")).alias("a"), decontam.fingerprint(F.col("h"), True).alias("b")).collect()
    assert [x.a for x in r] == [x.b for x in r] and r[1].a == 0 and r[2].a == -1


def brute_lines(rows, width=3):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    for k in order:
        doc, text = rows[k]
        if text is None:
            out.append((doc, None, 0, 0))
            continue
        ls = text.split("\n")
        full = [i for i, x in enumerate(ls) if x.strip(" \t\r")]
        gone = set()
        for a in range(len(full) - width + 1):
            w = tuple(ls[i].strip(" \t\r") for i in full[a : a + width])
            if w in seen:
                gone |= set(range(full[a], full[a + width - 1] + 1))
            seen.add(w)
        out.append((doc, "\n".join(x for i, x in enumerate(ls) if i not in gone), len(ls), len(gone)))
    return out


def test_line_dedup_equals_brute_force(spark):
    a, b = [f"line {i}" for i in range(8)], [f"row {i}" for i in range(4)]
    rows = [
        (3, "\n".join(a)), (1, "\n".join(["top", *a[:4], "mid", *a[4:]])), (2, "\n".join([a[0], "", " " + a[1] + " ", "", a[2], "tail"])), (2, "\n".join([a[0], "", " " + a[1] + " ", "", a[2], "tail"])), (None, "\n".join(b)),
        (None, None), (5, ""), (6, "\n\n\n"), (7, "\n".join(b * 3)), (8, "x\ny"), (9, "\r\n".join(b)),
    ]
    d = cases.clashing(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    got = [tuple(r) for r in lines.line_dedup(d).collect()]
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    assert sorted(got, key=key) == sorted(brute_lines(rows), key=key)
    assert lines.line_dedup(cases.empty(spark)).count() == 0


def test_line_dedup_doesn_t_depend_on_how_the_table_is_split(spark, tmp_path):
    shared = [f"shared {i}" for i in range(6)]
    rows = [(i, "\n".join([f"own {i} {k}" for k in range(4)] + (shared[: 3 + i % 4] if i % 3 == 0 else []))) for i in range(300)]
    rows += [rows[5], rows[6], rows[6], rows[9], (None, rows[9][1]), (9, rows[12][1])]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/t")
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    want = brute_lines([rows[k] for k in order])
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    try:
        for size, then in (("1g", "4k"), ("4k", "1g")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            out = lines.line_dedup(spark.read.parquet(f"{tmp_path}/t"))
            spark.conf.set("spark.sql.files.maxPartitionBytes", then)
            got = sorted((tuple(r) for r in out.collect()), key=key)
            # rows of one id come in an order of their own: which of the two keeps the shared lines is left open
            assert [r for r in got if r[0] != 9] == sorted((r for r in want if r[0] != 9), key=key)
            assert sum(r[3] for r in got if r[0] == 9) == sum(r[3] for r in want if r[0] == 9)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def levels():
    return [
        mixing.Level("domain", F.expr("case when source in ('a1', 'a2') then 'x' else 'y' end"), F.expr("case domain when 'x' then 3 else 1 end")),
        mixing.Level("lang", F.col("lang"), F.lit(1)),
        mixing.Level("source", F.col("source"), F.expr("case source when 'a5' then 0 else 1 end")),
    ]


def brute_share(amount, kids):
    """{name: (cap, weight)} -> {name: alloc}; by repeated rounds instead of sorting."""
    kids = {k: (c if w > 0 else 0, w) for k, (c, w) in kids.items()}
    amount, full = min(amount, sum(c for c, _ in kids.values())), set()
    while True:
        left, w = amount - sum(kids[k][0] for k in full), sum(v[1] for k, v in kids.items() if k not in full)
        more = {k for k, (c, x) in kids.items() if k not in full and (x == 0 or c * w <= left * x)}
        if not more:
            return {k: c if k in full else left * x // w for k, (c, x) in kids.items()}
        full |= more


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = [("p", "s", "a", 100), ("p", "s", "b", 1000), ("p", "t", "c", 50), ("q", "s", "d", 5000), ("q", "u", "e", 10), ("q", "u", "f", 0)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    ls = [mixing.Level("domain", F.col("domain"), F.lit(1)), mixing.Level("lang", F.col("lang"), F.expr("case lang when 's' then 2 else 1 end")), mixing.Level("source", F.col("source"), F.lit(1))]
    for budget, epochs in ((300, 1), (1500, 1), (3000, 2), (10**6, 2)):
        got = {r.source: r.alloc for r in mixing.budgets(df, ls, F.lit(budget), epochs).collect()}
        cap = {(d, lang): sum(t for a, b, _, t in leaves if (a, b) == (d, lang)) * epochs for d, lang, _, _ in leaves}
        top = brute_share(budget, {d: (sum(c for (a, _), c in cap.items() if a == d), 1) for d in "pq"})
        want = {}
        for d in "pq":
            mid = brute_share(top[d], {b: (c, 2 if b == "s" else 1) for (a, b), c in cap.items() if a == d})
            for lang, amount in mid.items():
                want |= brute_share(amount, {s: (t * epochs, 1) for a, b, s, t in leaves if (a, b) == (d, lang)})
        assert got == want


@pytest.mark.parametrize("epochs", [1, 3])
def test_mixing_takes_whole_passes_and_a_prefix(spark, epochs):
    docs = cases.clashing(cases.odd(spark)).drop("n")
    budget = F.expr("total * 8 div 10") if epochs == 1 else F.expr("total * 2")
    got = mixing.mix(docs, levels(), budget, seed=9, max_epochs=epochs).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch", "key").collect()
    assert {r.key for r in got} == {"clash"}
    named = [mixing.Level(x.name, F.coalesce(x.value.cast("string"), F.lit("unknown")), x.weight) for x in levels()]
    p = {(r.domain, r.lang, r.source): r for r in mixing.plan(docs, named, budget, seed=9, max_epochs=epochs, id_col="doc_id", text_col="text").collect()}
    have = collections.Counter((r.domain, r.lang, r.source, r.doc_id, r.epoch) for r in got)
    rows = collections.defaultdict(list)
    for d, t, lang, s, _ in cases.odd_rows():
        rows["x" if s in ("a1", "a2") else "y", lang or "unknown", s or "unknown"].append((d, len((t or "").split())))
    for leaf, own in rows.items():
        r = p[leaf]
        total = sum(n for _, n in own)
        assert r.tokens == total and r.epochs == (r.alloc // total if total else 0)
        left, used = r.alloc - r.epochs * total, 0
        want = collections.Counter((*leaf, d, e) for d, _ in own for e in range(r.epochs))
        by = collections.defaultdict(list)
        for d, n in own:
            by[hashlib.md5(f"9:{r.epochs}:{'null' if d is None else d}".encode()).hexdigest()].append((d, n))
        for k in sorted(by):
            used += sum(n for _, n in by[k])
            if left <= 0 or used > left:
                break
            want += collections.Counter((*leaf, d, r.epochs) for d, _ in by[k])
        assert {k: v for k, v in have.items() if k[:3] == leaf} == dict(want)
    assert mixing.mix(cases.empty(spark), levels(), F.col("total")).count() == 0


def test_prefix_is_found_with_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(0), (F.col("id") % 7).cast("int")), lambda i: F.lit("w"))).alias("text"), F.lit("en").alias("lang"), F.lit("a1").alias("source"))
    for per_mille in (0, 1, 250, 777, 1000):
        got = {r.doc_id for r in mixing.mix(docs, levels(), F.expr(f"total * {per_mille} div 1000"), seed=3).collect()}
        total, used, want = sum(i % 7 + 1 for i in range(300)), 0, set()
        for i in sorted(range(300), key=lambda i: hashlib.md5(f"3:{1 if per_mille == 1000 else 0}:{i}".encode()).hexdigest()):
            used += i % 7 + 1
            if per_mille == 1000 or used <= total * per_mille // 1000:
                want.add(i)
        assert got == want


def brute_nearest(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault(i, []).append(np.array(v, np.float32).astype(np.float64))
    out = {}
    for i in ok:
        if i % every == 0:
            best = sorted(((-max(float((a * b).sum()) for a in ok[i] for b in ok[j]), j) for j in ok if j != i))[:k]
            out[i] = [(j, -s) for s, j in best]
    return out


def test_neighbours_on_odd_vectors(spark):
    r = np.random.default_rng(4)
    rows = [(i, r.standard_normal(8).astype(np.float32).tolist()) for i in range(60)]
    same = rows[7][1]
    rows += [(200 + i, same) for i in range(30)] + [(300, None), (301, [0.0] * 8), (302, [1.0] * 7 + [None]), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (305, [1.0] * 4), (None, same), (306, []), rows[0]]
    df = cases.clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
    got = collections.defaultdict(list)
    for x in ann.nearest(df, k=5, every=10, coverage=1.0).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.vec_id, x.score))
        assert x.rank == len(got[x.query_id])
    want = brute_nearest(rows, 5, 10)
    assert {q: [j for j, _ in v] for q, v in got.items()} == {q: [j for j, _ in v] for q, v in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q], strict=True))
    assert ann.nearest(df.limit(0)).count() == 0 == ann.nearest(spark.createDataFrame([(20, same)], "vec_id long, embedding array<float>")).count()


def test_queries_in_small_parts_go_on_until_they_have_enough(spark):
    r = np.random.default_rng(6)
    centres = np.eye(3, 16) * 30
    x = np.concatenate([c + r.standard_normal((n, 16)) for c, n in zip(centres, (400, 12, 400), strict=True)]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.nearest(df, every=1, rows_per_part=50, coverage=0.5).groupBy("query_id").agg(F.count("*").alias("n"), F.countDistinct("vec_id").alias("d"), F.max("rank").alias("r")).collect()
    assert len(got) == 812 and {(g.n, g.d, g.r) for g in got} == {(20, 20, 20)}
    few = ann.nearest(df.where("vec_id < 9"), every=1).groupBy("query_id").count().collect()
    assert [g["count"] for g in few] == [8] * 9


def test_two_levels_of_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "MOST_PARTS", 16)
    r = np.random.default_rng(7)
    centres = r.standard_normal((40, 12)) * 3
    x = (centres[r.integers(0, 40, 4000)] + r.standard_normal((4000, 12))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    rows = common.durable(ann.valid_vectors(df, "vec_id", "embedding"))
    tree = ann.fit_tree(rows, 4000, sample_rows=2000, rows_per_part=40, coverage=0.95)
    assert len(tree.below) == 16 and tree.first[-1] > 16
    y = x.astype(np.float64)
    leaf, (order, before) = tree.leaf(y[:50]), tree.ordered(y[:50])
    assert (np.sort(order, 1) == np.arange(tree.first[-1])).all() and before[:, 0].max() == 0 and leaf.max() < tree.first[-1]
    got = ann.nearest(df, rows_per_part=40, sample_rows=2000, coverage=0.95).groupBy("query_id").agg(F.collect_set("vec_id").alias("s")).collect()
    s = y @ y.T
    np.fill_diagonal(s, -np.inf)
    assert len(got) == 200
    assert np.mean([len(set(np.argsort(-s[g.query_id])[:20].tolist()) & set(g.s)) / 20 for g in got]) >= 0.9


def test_parts_are_balanced_and_recall_is_measured(spark, sf, monkeypatch):
    r = np.random.default_rng(5)
    centres = r.standard_normal((12, 16)) * 2
    x = (centres[r.integers(0, 12, 1500)] + r.standard_normal((1500, 16))).astype(np.float32)
    part = ann.balanced_parts(ann.neighbour_graph(x.astype(np.float64), 10), 8)
    n = np.bincount(part, minlength=8)
    assert n.max() - n.min() <= 3
    monkeypatch.setattr(ann, "CHUNK", 100)
    monkeypatch.setattr(ann, "QUERIES", 7)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), rows_per_part=100).groupBy("query_id").agg(F.collect_set("vec_id").alias("s")).collect()
    s = x.astype(np.float64) @ x.astype(np.float64).T
    np.fill_diagonal(s, -np.inf)
    assert len(got) == 75
    assert np.mean([len(set(np.argsort(-s[g.query_id])[:20].tolist()) & set(g.s)) / 20 for g in got]) >= 0.9


@pytest.mark.parametrize("n", [5, 20, 30, 5000])
@pytest.mark.parametrize("equal", [True, False])
def test_neighbours_where_one_id_has_many_rows(spark, monkeypatch, n, equal):
    """The frequent id is near the queries and is a query itself; every query still gets 20 different ids, or all."""
    monkeypatch.setattr(ann, "CHUNK", 700)
    r = np.random.default_rng(12)
    rows = [(i, r.standard_normal(8).tolist()) for i in range(100)]
    near = np.array(rows[40][1]) * 2
    rows += [(1000, (near if equal else near + 0.3 * r.standard_normal(8)).tolist()) for _ in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = collections.defaultdict(list)
    for x in ann.nearest(df, coverage=1.0).orderBy("query_id", "rank").collect():
        got[x.query_id].append(x.vec_id)
    want = collections.defaultdict(dict)
    matrix, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    for i, v in rows:
        if i % 20 == 0:
            for j, s in zip(ids.tolist(), (matrix * np.array(v)).sum(1).tolist(), strict=True):
                if j != i:
                    want[i][j] = max(s, want[i].get(j, -1e9))
    assert set(got) == set(want) and 1000 in got
    for q, scores in want.items():
        assert got[q] == sorted(scores, key=lambda j: (-scores[j], j))[:20]
