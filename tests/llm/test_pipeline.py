"""The pipeline: each stage on its own input, then all of them; and the thin queries."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from loomtext.llm import queries
from loomtext.llm.common import table

from . import cases
from .test_text_operators import brute_contamination
from .test_tokens_shards import reference_ids

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """Every stage's rows, each made from what the one before it wrote."""
    top, docs, out = tmp_path_factory.mktemp("stages"), table(spark, SF, "documents"), []
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{top}/{k}")
        out.append((docs, docs := spark.read.parquet(f"{top}/{k}")))
    return out


def test_stages(spark, ran):
    names = table(spark, SF, "documents").columns
    for (before, after), (name, _) in zip(ran[:-1], P.STAGES, strict=False):
        assert after.columns == names, name
        assert after.exceptAll(before).count() == 0 and 0 < after.count() <= before.count()
    assert ran[0][0].count() > ran[0][1].count() and ran[1][0].count() > ran[1][1].count()


def test_toxic_documents_go_and_clean_ones_stay(spark, ran):
    before, after = ran[0]
    y = table(spark, SF, "labels").join(before.select("doc_id"), "doc_id")
    left = y.join(after.select("doc_id"), "doc_id")
    assert left.where("toxic = 0").count() == y.where("toxic = 0").count()
    assert left.where("toxic = 1").count() < y.where("toxic = 1").count()


def test_no_near_copies_are_left(ran):
    before, after = ran[1]
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    sets = {r.doc_id: grams(r.text.lower().split()) for r in before.collect()}
    stay = sorted(r.doc_id for r in after.collect())
    similar = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0
    assert not any(similar(a, b) for i, a in enumerate(stay) for b in stay[:i])
    texts = {r.doc_id: r.text for r in before.collect()}
    for gone in set(texts) - set(stay):
        assert any(similar(gone, x) or texts[gone].lower().split() == texts[x].lower().split() for x in texts if x != gone)


def test_contaminated_documents_go(spark, ran):
    before, after = ran[2]
    found = brute_contamination([(r.doc_id, r.text) for r in before.collect()], [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == {d for d, _ in found}


def test_token_stage(ran):
    before, after = ran[4]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    assert sorted(tuple(r)[:4] for r in after.collect()) == [x[:4] for x in reference_ids(rows, queries.tokenizer_path())]


def test_run_gives_the_stages_rows(spark, ran):
    assert P.run(spark, SF).exceptAll(ran[4][1]).count() == 0 == ran[4][1].exceptAll(P.run(spark, SF)).count()


def test_stages_stand_odd_rows(spark, tmp_path):
    docs = cases.odd(spark)
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    # bit by bit what came in, under names that the stages use themselves; the last stage gives token counts
    before = cases.odd(spark).collect()
    wide = cases.clashing(cases.odd(spark)).drop("n_tokens").withColumn("n_tokens", F.lit(99)).withColumn("Epoch", F.lit(7))
    for k, (name, stage) in enumerate(P.STAGES[:-1]):
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        out.write.parquet(f"{tmp_path}/wide{k}")
        wide = spark.read.parquet(f"{tmp_path}/wide{k}")
        # a source without a token has no share in the mix
        assert wide.where("lang is null").count() and (name.startswith("mixing") or wide.where("text is null").count()), name
    left = wide.collect()
    assert {r.n_tokens for r in left} == {99} and {r.Epoch for r in left} == {7} and {r[c] for r in left for c in cases.CLASHES if c not in ("n_tokens", "epoch")} == {"clash"}
    assert {(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in left} <= {tuple(r) for r in before}
    assert docs.count() == len(left)
    empty = cases.empty(spark)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_python_gets_texts_in_small_batches(spark, tmp_path, monkeypatch):
    """Stages bound the batches of every step that reads texts, whoever runs the action."""
    few = table(spark, SF, "documents")
    docs = few.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(2500 // few.count())))).withColumn("doc_id", F.col("doc_id") + 1_000_000 * F.col("copy")).drop("copy")
    docs.coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs, plain = spark.read.parquet(f"{tmp_path}/docs"), type(few).mapInArrow
    folder, most = tmp_path / "seen", 2048
    folder.mkdir()

    def watched(self, func, *args, **more):
        def run(batches):
            def each():
                for batch in batches:
                    with (folder / f"{'over' if batch.num_rows > most else 'under'}").open("a") as f:
                        f.write(f"{batch.num_rows}\n")
                    yield batch

            return func(each())

        return plain(self, run, *args, **more)

    assert docs.count() > most
    monkeypatch.setattr(type(few), "mapInArrow", watched)
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
    assert (folder / "under").exists() and not (folder / "over").exists()


def test_toxic_rows_go_by_their_text(spark):
    """What goes is what the model rejects, row by row: repeated ids, null ids and null texts among them."""
    docs = table(spark, SF, "documents").unionByName(cases.odd(spark).select(*table(spark, SF, "documents").columns))
    model = P.toxicity.fit_toxicity(docs, table(spark, SF, "labels"))
    want = P.toxicity.score_toxicity(docs, model).where("toxic = 0").drop("toxic", "toxic_score")
    got = P.drop_toxic(spark, docs, SF)
    assert got.columns == docs.columns and 0 < got.count() < docs.count()
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_thin_queries_return_whole_tables(spark):
    docs = table(spark, SF, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {n: f(spark, SF) for n, f in queries.QUERIES.items()}
    want = {"op2_token_binary": "doc_id start n_tokens ids_crc32", "op4_shards": "doc_id size text_crc32 law shard slot grown_shard", "op5_neighbours": "query_id rank vec_id score", "op7_language": "doc_id held_out lang_pred score", "op8_toxicity": "doc_id held_out score predicted", "op9_quality": "doc_id held_out score predicted", "op10_simhash": "doc_id fingerprint component_id"}
    for n, columns in want.items():
        assert got[n].columns[: len(columns.split())] == columns.split()
        if n != "op5_neighbours":
            assert sorted(r.doc_id for r in got[n].select("doc_id").collect()) == [d for d, _ in rows]
    held = {r.doc_id: r.held_out for r in got["op9_quality"].collect()}
    assert held == {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _ in rows}
    assert {n: f"op{i}_" for i, n in enumerate(queries.QUERIES, 1)} == {n: n[: n.index("_") + 1] for n in queries.QUERIES}


def test_neighbours_of_the_table_against_brute_force(spark):
    rows = table(spark, SF, "embeddings").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    found = queries.op5_neighbours(spark, SF)
    by = {}
    for r in found.orderBy("query_id", "rank").collect():
        by.setdefault(r.query_id, []).append(r)
    for q, own in by.items():  # whole, in order, ties to the smaller id, scores of the vectors themselves
        assert [r["rank"] for r in own] == list(range(1, 21)) and len({r.vec_id for r in own} - {q}) == 20
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert all(abs(r.score - float((x[ids == q][0] * x[ids == r.vec_id][0]).sum())) < 1e-12 for r in own)
    got = found.groupBy("query_id").agg(F.collect_set("vec_id").alias("s")).collect()
    hit = []
    for g in got:
        s = x @ x[ids == g.query_id][0]
        s[ids == g.query_id] = -np.inf
        hit.append(len(set(ids[np.lexsort((ids, -s))[:20]].tolist()) & set(g.s)) / 20)
    assert len(hit) == sum(ids % 20 == 0) and np.mean(hit) >= 0.9
