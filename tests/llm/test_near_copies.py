from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from loomtext.llm import components as graph
from loomtext.llm import nearcopies, simhash
from loomtext.llm.components import components

from . import cases


def fingerprint(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids, linked):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(ids))]


def least(ids, roots):
    by = {}
    for i, r in zip(ids, roots, strict=True):
        if i is not None:
            by[r] = min(by.get(r, i), i)
    return [by.get(r) for r in roots]


@pytest.mark.parametrize("clash", [False, True])
def test_components_equal_brute_force(spark, clash):
    docs = cases.clashing(cases.odd(spark)) if clash else cases.odd(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fp = [fingerprint(t) for _, t in rows]
    roots = least([i for i, _ in rows], groups(rows, lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 3))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] is not None, r[2] or 0)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=key)
    assert got == sorted(((i, f"{f:016x}", r) for (i, _), f, r in zip(rows, fp, roots, strict=True)), key=key)


def test_links_of_crowded_fingerprints(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 6, dtype=np.int64).astype(np.uint64)
    fps = set(int(b) for b in base)
    for b in base:
        for _ in range(60):
            x = int(b)
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    want = groups(fps, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    for cell, part in ((8192, 200_000), (16, 40)):  # the second cuts cells into blocks, and links into parts that stars join
        monkeypatch.setattr(simhash, "CELL", cell)
        monkeypatch.setattr(graph, "PART_LINKS", part)
        got = {r.node: r.root for r in components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()}
        mine = [got.get(s, s) for s in signed]
        assert len(set(zip(mine, want, strict=True))) == len(set(want)) == len(set(mine))


@given(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1))
@settings(max_examples=200, deadline=None)
def test_lower_bound(a, b):
    u = simhash.unary_counts(np.array([a, b], np.uint64))
    counts = lambda x: [(x >> 2 * k & 3).bit_count() for k in range(32)]
    assert int(np.bitwise_count(u[0] ^ u[1])) == sum(abs(x - y) for x, y in zip(counts(a), counts(b), strict=True)) <= (a ^ b).bit_count()


def test_long_groups_of_hashes_are_counted_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    h, off = rng.integers(0, 2**63, 500, dtype=np.int64).astype(np.uint64), np.array([0, 0, 200, 203, 500])
    whole = simhash.bit_majorities(h, off)
    monkeypatch.setattr(simhash, "LANE", 7)
    assert (simhash.bit_majorities(h, off) == whole).all() and whole[0] == 0


@pytest.mark.parametrize("block", [8, 512])
def test_one_of_each_group_of_near_copies_stays(spark, monkeypatch, block):
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    if block == 8:  # crowded cells, common shingles and lists too long to broadcast
        monkeypatch.setattr(nearcopies, "CELL", 4)
        monkeypatch.setattr(nearcopies, "HOT", 2)
        monkeypatch.setattr(nearcopies, "BROADCAST_ROWS", 3)
    rows = [(i, cases.prose(i)) for i in range(20)]
    words = rows[0][1].split()
    for k in range(30):  # copies of row 0 with one word changed: similar to it and to each other
        w = list(words)
        w[2 + 2 * k] = f"edit{k}"
        rows.append((100 + k, " ".join(w)))
    for k in range(12):  # a chain: each like the next, its ends unlike
        rows.append((130 + k, " ".join(cases.prose(77, 120).split()[4 * k : 4 * k + 60])))
    rows += [(200, rows[1][1]), (None, rows[2][1]), (300, None), (301, None), (302, ""), (3, rows[3][1]), (3, rows[3][1])]
    docs = cases.clashing(spark.createDataFrame(rows, "doc_id long, text string"))

    def similar(a, b, t=0.8):
        s = [{tuple(x.split()[i : i + 5]) for i in range(len(x.split()) - 4)} for x in (a or "", b or "")]
        return a and b and (a.split() == b.split() or len(s[0] & s[1]) >= t * len(s[0] | s[1]) > 0)

    roots = groups(rows, lambda i, j: similar(rows[i][1], rows[j][1]))
    keep = {}
    for (i, _), r in zip(rows, roots, strict=True):
        keep[r] = min(keep.get(r, (True, 0)), (i is None, i or 0))
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in nearcopies.without_near_copies(docs).collect())
    assert got == sorted(keep.values())
    assert nearcopies.without_near_copies(cases.empty(spark)).count() == 0
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


def edited(words, kind, r):
    """A copy of 200 words with 18 to 20 of them appended, cut off, replaced in one stretch, or five changed here and there: Jaccard 0.80 to 0.92."""
    n, new = r.randint(18, 20), [f"new{r.random()}" for _ in range(20)]
    k = r.randint(20, 160)
    if kind == "appended":
        return words + new[:n]
    if kind == "truncated":
        return words[:-n]
    if kind == "replaced":
        return words[:k] + new[: n - 3] + words[k + n - 3 :]
    spots = {10, 55, 100, 145}
    return [new[0] + w if i in spots else w for i, w in enumerate(words)]


@pytest.mark.parametrize("kind", ["appended", "truncated", "replaced", "scattered"])
def test_near_copies_are_found_for_every_kind_of_edit(spark, kind):
    r, rows = random.Random(kind), []
    for i in range(150):
        words = cases.prose(1000 + i, 200).split()
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited(words, kind, r)))]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in rows]
    assert all(len(a & b) >= 0.8 * len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True))
    got = sorted(x.doc_id for x in nearcopies.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == list(range(0, 300, 2))


def test_the_table_may_be_split_in_another_way_when_it_is_read_again(spark, tmp_path):
    rows = [(i % 37, cases.prose(i % 50)) for i in range(400)] + [(1000 + i, cases.prose(9, 60) + f" end{i}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/t")
    seen = []
    for size in ("1g", "4k"):  # the plan is made at one size of splits and run at another
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        out = nearcopies.without_near_copies(spark.read.parquet(f"{tmp_path}/t"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k" if size == "1g" else "1g")
        seen.append(sorted((r.doc_id, r.text) for r in out.collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] == sorted([*{t: (min(j for j, u in rows if u == t), t) for i, t in rows[:400]}.values(), (1000, rows[400][1])])


def test_prefixes_of_similar_sets_meet():
    r = np.random.default_rng(3)
    for _ in range(300):
        n, k = int(r.integers(1, 80)), int(r.integers(0, 12))
        base = np.unique(r.integers(0, 2**63, n + k).astype(np.uint64))
        a, b = base[: len(base) - k // 2], base[k - k // 2 :]
        both = len(np.intersect1d(a, b))
        if not both or both < 0.8 * (len(a) + len(b) - both):
            continue
        common = np.sort(r.choice(base, len(base) // 3, replace=False))
        first, ends = nearcopies._prefixes(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 0.8, common)
        assert len(np.intersect1d(first[: ends[1]], first[ends[1] :]))
