from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from loomtext.llm import common, queries, shards, tokens

from . import cases


def reference_ids(rows, path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    out, at = [], 0
    for doc, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


def test_encoder_equals_the_tokenizer_on_odd_texts():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    t, r = Tokenizer.from_file(path), random.Random(5)
    letters = list("ab éÉ.,!?'\"12 \n\t́ΣσİŁß中국<|>s tक़") + ["'s", "'re", "<|endoftext|>", " ", " ", "\x1c", "\x0b", "A."]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(3000)] + ["", "y" * 5000]
    for added in t.get_added_tokens_decoder().values():  # in every case form, alone, between words and inside them
        for form in (added.content, added.content.upper(), added.content.title(), added.content.swapcase(), "".join(r.choice((c, c.upper())) for c in added.content)):
            texts += [form, f"Some TEXT {form} and More", f"x{form}Y.", form * 2, f"{form[:-1]} |>"]
    flat, n = tokens.WordEncoder(path).encode(pa.array(texts, pa.large_string()))
    ends = np.cumsum(n)
    for x, a, b in zip(texts, ends - n, ends, strict=True):
        assert t.encode(x, add_special_tokens=False).ids == flat[a:b].tolist(), x


@pytest.mark.parametrize("make", [cases.odd, lambda s: cases.clashing(cases.odd(s)).repartition(3)])
def test_round_trip(spark, make):
    docs = make(spark)
    path, folder = queries.tokenizer_path(), common.new_folder(spark, "t")
    m = tokens.write_token_files(docs, folder, path, end_id=1)
    got = tokens.read_token_files(spark, folder, ids=True).collect()
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want = reference_ids(rows, path)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    if make is cases.odd:
        assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32, list(r.ids)) for r in got), key=key) == sorted(want, key=key)
    assert sum(p["n_tokens"] for p in m["parts"]) == sum(w[2] for w in want)
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    common.remove_folder(spark, folder)


def test_no_documents(spark):
    folder = common.new_folder(spark, "t")
    assert tokens.write_token_files(cases.empty(spark), folder, queries.tokenizer_path())["parts"] == []
    assert tokens.read_token_files(spark, folder).count() == 0


def test_shards_meet_the_law_of_bytes(spark):
    docs = cases.odd(spark)
    got = shards.shard_by_bytes(docs, 5).collect()
    rows = sorted(((r.doc_id, (r.text or "").encode()) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    total, before, want = sum(len(t) + 8 for _, t in rows), 0, []
    edges = np.concatenate([[0], np.cumsum([len(t) + 8 for _, t in rows])]).tolist()
    bounds = [min(edges, key=lambda e: (abs(e - -(-total * j // 5)), e)) for j in range(1, 5)]
    for doc, t in rows:
        want.append((doc, len(t) + 8, zlib.crc32(t), sum(before >= b for b in bounds)))
        before += len(t) + 8
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard) for r in got), key=key) == sorted(want, key=key)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_one_id_for_all_rows_is_split(spark):
    docs = spark.createDataFrame([(7, "z" * 92)] * 400, "doc_id long, text string").repartition(3)
    n = shards.shard_by_bytes(docs, 4, rows_per_range=30).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in n) == [100] * 4
    assert shards.shard_by_bytes(cases.empty(spark), 4).count() == 0
    assert shards.shard_by_bytes(cases.clashing(cases.odd(spark)), 3).count() == cases.odd(spark).count()

def expected_shards(rows, shards_n):
    """rows: (id, text) in input order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    sizes = [len((t or "").encode()) + 8 for _, t in rows]
    total, edges = sum(sizes), np.concatenate([[0], np.cumsum(sizes)]).tolist()
    bounds = [min(edges, key=lambda e: (abs(e - -(-total * j // shards_n)), e)) for j in range(1, shards_n)]
    out, slots = [], {}
    for (doc, t), before in zip(rows, edges, strict=False):
        s = sum(before >= b for b in bounds)
        out.append((doc, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), s, slots.get(s, 0)))
        slots[s] = slots.get(s, 0) + 1
    return out


LONGS = [-(1 << 63), -(1 << 63) + 1, (1 << 63) - 1, (1 << 63) - 2, -(1 << 62), -(1 << 62) - 1, 0, -1, 1, None, None, None]


@pytest.mark.parametrize("make", ["hashes", "limits", "nulls", "twice", "one"])
def test_shards_of_any_ids(spark, make):
    r = np.random.default_rng(11)
    ids = {
        "hashes": lambda: [int(x) for x in r.integers(-(1 << 63), (1 << 63) - 1, 300)], "limits": lambda: LONGS * 9, "nulls": lambda: [None] * 150 + LONGS,
        "twice": lambda: [int(x) for x in r.integers(-(1 << 63), (1 << 63) - 1, 100)] * 3, "one": lambda: [(1 << 63) - 1] * 200,
    }[make]()
    rows = [(i, "é" * int(r.integers(0, 200)) if k % 7 else None) for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for n in (1, 5, 24):
        got = [(x.doc_id, x.size, x.text_crc32, x.shard, x.slot) for x in shards.shard_by_bytes(docs, n, rows_per_range=40).collect()]
        assert sorted(got, key=lambda x: x[3:]) == expected_shards(rows, n)
