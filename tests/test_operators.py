"""Operators against sequential specifications written here, and hand-made cases."""

from __future__ import annotations

import hashlib
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.functions import text as T
from loomtext.operators import clean, contract, dedup, packing, sampling, signals
from loomtext.plans import provenance, store
from loomtext.sources import parsers, readers


def col(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"seq long, x {kind}")


def test_normalise(spark):
    texts = ["ﬁne  ½\t x", "a\r\nb​\n\n\n\nc", "　 pad  ", "Ångström ①", "", None, "plain"]

    def spec(t):
        import re

        t = "".join(c for c in unicodedata.normalize("NFKC", t) if unicodedata.category(c) not in ("Cc", "Cf") or c in "\n\t")
        return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", t)).strip()

    got = [r[0] for r in col(spark, texts).orderBy("seq").select(T.normalise(F.col("x"))).collect()]
    assert got == [None if t is None else spec(t) for t in texts]


def test_words_and_classes(spark):
    texts = ["a b\x1cc  d", "", "Figure 1 shows a theorem and proof of the dataset", "click here " * 20]
    d = col(spark, texts).orderBy("seq")
    assert [r[0] for r in d.select(T.n_words(F.col("x"))).collect()] == [len(t.split()) for t in texts]
    assert [r[0] for r in d.select(T.reclassify(F.lit("blog"), F.col("x"))).collect()] == ["blog"] * 4
    urls = ["https://arxiv.org/abs/1234.5678", "https://github.com/a/b", "https://x.org/m.py", "https://www.reddit.com/r/x", "https://a.b/c", "https://en.wikipedia.org/wiki/X"]
    u = col(spark, urls).orderBy("seq")
    assert [r[0] for r in u.select(T.classify_url(F.col("x"))).collect()] == ["research_paper", "source_code", "source_code", "forum_post", "unknown", "encyclopedia"]
    assert [r[0] for r in u.select(T.code_language(F.col("x"))).collect()] == ["", "", "python", "", "", ""]
    hosts = col(spark, ["x.github.com", "github.com", "export.arxiv.org", "a.org"]).orderBy("seq")
    assert [(r[0], r[1]) for r in hosts.select(T.domain_rule(F.col("x"), 1), T.domain_rule(F.col("x"), 2)).collect()] == [(1.15, "github"), (1.15, "github"), (1.25, "arxiv"), (1.0, "web")]


def test_clean_order_of_decisions(spark):
    bad = "this is secret text that is long enough to pass " * 3
    ok = "this is other text that is long enough to pass " * 3
    rows = [(0, bad), (1, bad), (2, "short"), (3, ok + " "), (4, ok), (5, None), (6, "y" * 900)]
    d = spark.createDataFrame(rows, "seq long, text string")
    cfg = clean.CleanConfig(shortest=80, longest=500, groups={"g": (1.0, ["secret"])}, threshold=0.05)
    got = {r.seq: (r.clean_action, r.kept) for r in clean.clean(d, cfg).collect()}
    assert got == {0: ("dropped", False), 1: ("duplicate", False), 2: ("too_short", False), 3: ("kept", True), 4: ("duplicate", False), 5: ("too_short", False), 6: ("too_long", False)}
    flag = {r.seq: (r.clean_action, r.flagged) for r in clean.clean(d, clean.CleanConfig(action="flag", shortest=80, longest=500, groups=cfg.groups, threshold=0.05)).collect()}
    assert flag[0] == ("flagged", True)
    red = clean.clean(d, clean.CleanConfig(action="redact", shortest=80, longest=500, groups={"g": (1.0, ["secret text", "text that"])}, threshold=0.05)).where("seq = 0").first()
    assert "secret" not in red.text and red.text.count("[REMOVED]") == 3 and "is long enough" in red.text
    hits = d.where("seq = 0").select(clean.pattern_hits(F.col("text"), clean.CleanConfig(instant=["is"])).alias("h")).first().h
    assert [(h.group, h.start, h.end) for h in hits] == [("instant_drop", 2, 4)]


def jaccard(a, b):
    import re

    def grams(t):
        w = re.findall(r"\w+", t.lower())
        return set(w) if len(w) < 3 else {" ".join(w[i : i + 3]) for i in range(len(w) - 2)}

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x and y else 0.0


def test_similar_pairs_and_greedy_choice(spark):
    r = random.Random(3)
    words, texts = [f"w{i}" for i in range(30)], []
    for _ in range(12):
        base = [r.choice(words) for _ in range(25)]
        for _ in range(r.randint(1, 5)):
            w = list(base)
            for _ in range(r.randint(0, 2)):
                w[r.randrange(25)] = r.choice(words)
            texts.append(" ".join(w))
    texts += ["", "a", "A", "a b", None]
    r.shuffle(texts)
    rows = [(i, t, r.choice([1.0, 2.0, 3.0])) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "seq long, text string, final_weight double")
    for t in (0.5, 0.8):
        slots, founder = [], []
        for i, x, w in rows:
            for k, j in enumerate(slots):
                if jaccard(x or "", rows[j][1] or "") >= t:
                    if w > rows[j][2]:
                        slots[k] = i
                    break
            else:
                slots.append(i)
                founder.append(i)
        got = sorted((x.slot, x.seq) for x in dedup.resolve_similar(d, t).collect())
        assert got == sorted(zip(founder, slots, strict=True))


def test_embedding_choices(spark):
    rows = [(0, [1.0, 0.0, 0.0], 1.0), (1, [0.8, 0.6, 0.0], 2.0), (2, [0.309, 0.951, 0.0], 1.5)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, final_weight double")
    assert [r.seq for r in dedup.resolve_embeddings(d, 0.8).collect()] == [1]
    two = spark.createDataFrame([(0, [1.0, 0.0], 1.0), (1, [0.99, 0.1], 2.0), (2, [0.0, 1.0], 1.0)], "vec_id long, embedding array<float>, final_weight double")
    assert sorted(r.seq for r in dedup.resolve_embeddings(two, 0.8).collect()) == [1, 2] == sorted(r.seq for r in dedup.resolve_embeddings(two, 0.8, batch=True).collect())
    assert [(r.id, r.neighbour) for r in dedup.cosine_topk(two, 1).orderBy("id").collect()] == [(0, 1), (1, 0), (2, 1)]


@pytest.mark.parametrize("strategy", sampling.STRATEGIES)
def test_resample_draws_in_order(spark, strategy):
    r = random.Random(1)
    weights = [0.5, 1.0, 2.5, 0.0, -1.0] + [r.random() * 3 for _ in range(200)]
    rng, want = random.Random(1), []
    for i, w in enumerate(max(w, 0.0) for w in weights):
        whole, part = int(w), w - int(w)
        if strategy == "downsample":
            n = 1 if w >= 1 else int(rng.random() < w)
        elif strategy == "both" and w < 1:
            n = int(rng.random() < w)
        else:
            n = max(1, whole) + int(w > 1 and part > 0 and rng.random() < part)
        want += [i] * n
    d = spark.createDataFrame(list(enumerate(weights)), "seq long, final_weight double")
    assert sorted(x.seq for x in sampling.resample_in_order(d, strategy, seed=1).collect()) == want
    whole = spark.createDataFrame([(0, 2.0), (1, 1.0), (2, 0.0)], "doc_id long, final_weight double")
    n = {"upsample": [2, 1, 1], "downsample": [1, 1, 0], "both": [2, 1, 0]}[strategy]
    got = sorted(x.doc_id for x in sampling.resample(whole, strategy).collect())
    assert [got.count(i) for i in range(3)] == n
    with pytest.raises(ValueError):
        sampling.resample(whole, "sideways")


def test_samples_and_shuffles(spark):
    assert len(set(sampling.reservoir_slots(100, 10))) == 10 and sorted(sampling.buffer_order(57, 8)) == list(range(57))
    d = spark.range(50).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("doc_id"))
    got = [int(r.doc_id) for r in sampling.buffer_shuffle(d, 8).orderBy("place").collect()]
    assert got == sampling.buffer_order(50, 8)
    for r in sampling.split(d, 0.5, seed=7).collect():
        b = int.from_bytes(hashlib.sha256(f"7:{r.doc_id}".encode()).digest()[:4], "big") % 1_000_000
        assert (r.bucket, r.part) == (b, "val" if b < 500_000 else "train")


def test_signal_gate(spark):
    r = random.Random(5)
    rows, want = [], []
    for dom in range(12):
        scores, gone = [], False
        for s in range(60):
            x = r.random() * (0.5 if dom % 3 else 1.0)
            rows.append((f"d{dom}", s, x))
            if not gone:
                want.append((f"d{dom}", s))
                scores = [*scores, x][-20:]
                gone = s + 1 >= 10 and sum(scores) / len(scores) < 0.35
    d = spark.createDataFrame(rows, "domain string, seq long, score double")
    assert sorted((x.domain, x.seq) for x in signals.signal_gate(d).collect()) == sorted(want)


def test_packing_round_trip(spark, tmp_path):
    r = np.random.default_rng(2)
    docs = [(i, "train" if i % 4 else "val", r.integers(3, 60000, r.integers(0, 40)).tolist()) for i in range(60)]
    d = spark.createDataFrame(docs, "seq long, part string, tokens array<int>").withColumn("tokens", packing.with_end(F.col("tokens"), 2))
    files = packing.write_shards(packing.shard_pieces(d, 100), f"file://{tmp_path}")
    m = files.collect()
    for part in ("train", "val"):
        flat = [t for i, p, ts in docs if p == part and ts for t in [*ts, 2]]
        got = np.concatenate([np.fromfile(f"{tmp_path}/{x.name}", "<u2") for x in sorted(m) if x.name.startswith(part)])
        assert got.tolist() == flat and all(x.size == 200 for x in sorted(x for x in m if x.name.startswith(part))[:-1])
    table = spark.createDataFrame(m, "name string, size long, sha256 string")
    assert all(x.ok for x in packing.verify_shards(table, f"file://{tmp_path}").collect())
    (tmp_path / m[0].name).write_bytes(b"x" * m[0].size)
    assert [x.ok for x in packing.verify_shards(table.where(F.col("name") == m[0].name), f"file://{tmp_path}").collect()] == [False]
    w = packing.windows(spark.createDataFrame([(list(range(10)),), ([1, 2],)], "tokens array<int>"), 3).collect()
    assert [(x.x, x.y) for x in w] == [([0, 1, 2], [1, 2, 3]), ([3, 4, 5], [4, 5, 6]), ([6, 7, 8], [7, 8, 9])]


def test_contract(spark):
    long = "word " * 40
    rows = [(0, "a", long, "u", "web", "g", 0.9), (1, "a", long, "u", "web", "g", 0.9), (2, "b", long, "u", "web", "h", 0.9), (3, "c", long, "u", "local_files", "g", 0.9), (4, "d", long + " buy now, not financial advice", "u", "web", "g", 0.9), (5, "e", "few", "u", "web", "g", 0.9), (6, "f", long, "", "web", "g", 0.9), (7, "g", long, "u", "arxiv", "g", 0.9)]
    d = spark.createDataFrame(rows, "seq long, doc_id string, text string, url string, source string, dataset_group string, quality_signal double").withColumn("source_identity", F.create_map(F.lit("arxiv_id"), F.lit("1"))).withColumn("license_status", F.lit("unknown"))
    out = contract.decide(d, "g")
    assert [r.reason for r in out.orderBy("seq").collect()] == [None, "duplicate_document_id", "dataset_group_mismatch", "unsupported_source", "financial-advice,investment-advice,marketing", "quality_gate", "missing_source_identity", "missing_source_identity"]
    r = contract.report(out).first()
    assert (r.rows, r.accepted, r.rejected, r.rights_unknown) == (8, 1, 7, 1) and r.reasons["missing_source_identity"] == 2


def test_parsers():
    p = lambda raw, url: parsers.parse(raw, url)
    assert p(b'name,note\na,"x, y"\nb', "f.csv")["text"] == "record 2\nname: a\nnote: x, y\n\nrecord 3\nname: b\nnote: "
    assert p(b"a,b\n , \n\n1,\x002\n", "f.csv")["text"] == "record 4\na: 1\nb: 2"
    assert p(b" , \nx,y\n", "f.csv")["text"] == "record 2\ncolumn_1: x\ncolumn_2: y"
    q = p(b'name,description,value\n"alpha, beta","quoted value",42\nsecond,plain,7\n', "https://e.test/data.csv")
    assert q["content_type"] == "tabular_data" and "name: alpha, beta\ndescription: quoted value\nvalue: 42" in q["text"] and q["text"].count("record ") == 2
    for raw, url in ((b"", "f.csv"), (b"a,b\n", "f.csv"), (b"[]", "f.json"), (b"\n\n", "f.jsonl"), (b"<a><b/></a>", "f.xml"), (b"<html><nav>x</nav></html>", "f.html")):
        assert parsers.parse_or_error(raw, url)["text"] is None and parsers.parse_or_error(raw, url)["error"], url
    kinds = {"f.json": b"[1]", "f.jsonl": b"1", "f.xml": b"<a>x</a>"}
    assert {p(raw, url)["content_type"] for url, raw in kinds.items()} == {"structured_data"}
    h = p(b'<html><head><title>Example</title></head><body><p>Hello</p><a href="/next">Next</a></body></html>', "https://e.test/i.html")
    assert (h["title"], h["text"], h["links"]) == ("Example", "Example Hello", ["/next"])
    with pytest.raises(ValueError, match="unsupported content type"):
        p(b"\x00\x01", "blob.bin")
    for html, text in (("<div><form>a</div>b", "b"), ("<ul><li><nav>x</ul>tail", "tail"), ("<b><div><nav>x</b>y</div>z", "z"), ("<table><tr><td><a href=1>x<td>y</table>z", "y z"), ("<p>one<br/>two<script>if(a<b){}</script>three", "one two three")):
        assert p(html.encode(), "f.html")["text"] == text, html
    assert p(b"a\tb\n1\t2\n", "f.tsv")["text"].endswith("a: 1\nb: 2")
    assert p('[{"b": 1, "a": "é"}, 2]'.encode(), "f.json")["text"] == '{"a":"é","b":1}\n2'
    assert "line 2" in parsers.parse_or_error(b'{"a":1}\nnope', "f.jsonl")["error"]
    assert p(b"<a>x<b>y</b> z</a>", "f.xml")["text"] == "x y z"
    assert parsers.parse_or_error(b'<!DOCTYPE a [<!ENTITY b "c">]><a>&b;</a>', "f.xml")["error"]
    h = p(b'<html><title>T</title><nav>n</nav><p>one <a href="/u">link</a> two</p><script>s</script></html>', "f.html")
    assert (h["title"], h["links"]) == ("T", ["/u"]) and "link" not in h["text"] and "one" in h["text"] and "s" not in h["text"].split()
    assert parsers.parse_or_error(b"\x00\x01", "f.bin")["error"] and p("ü".encode("cp1252") + b"a bc", "f.txt")["text"] == "üa bc"


def test_readers(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text('{"doc_id": "1", "text": "a b", "odd": 1}\n\n{"doc_id": "2", "text": "c"}\n')
    d = readers.read_jsonl(spark, str(tmp_path / "d.jsonl")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.word_count, r.language, r.final_weight) for r in d] == [("1", 2, "en", 1.0), ("2", 1, "en", 1.0)]
    (tmp_path / "bad.jsonl").write_text('{"text": "a"}\n')
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(tmp_path / "bad.jsonl")).collect()
    files = tmp_path / "files"
    files.mkdir()
    (files / "a.txt").write_text("hello")
    (files / "A.TXT").write_text("other")
    (files / "e.txt").write_text("")
    (files / "x.bin").write_text("no")
    got = readers.local_files(spark, [str(files)], extensions=[".txt"]).collect()
    assert [(r.text, r.content_type, r.error) for r in got] == [("other", "text", None)] and len(got[0].doc_id) == 64
    rows = spark.createDataFrame([(0, "q", None, " MIT "), (1, "", "c", "mit"), (2, "x", "y", "gpl"), (3, "z", "z", "mit")], "row_index long, question string, context string, license string")
    out = readers.dataset_rows(rows, repo="r", revision="v", split="s", fields=["question", "context"], most=3, license_field="license", licenses=["MIT"]).collect()
    assert [(r.doc_id, r.text) for r in out] == [("hf:r:v:s:0", "question: q"), ("hf:r:v:s:1", "context: c")]
    pages = spark.createDataFrame([("https://a.org/1",), ("https://a.org/2",), ("https://b.org/3",), ("https://a.org/4",)], "url string")
    links = spark.createDataFrame([("https://a.org/1", "https://a.org/2#x"), ("https://a.org/2", "https://b.org/3"), ("https://a.org/2", "https://a.org/4"), ("https://a.org/1", "http://10.0.0.1/x")], "url string, link string")
    crawl = {r.url: r.crawl_depth for r in readers.replay_crawl(pages, links, ["https://a.org/1"]).collect()}
    assert crawl == {"https://a.org/1": 0, "https://a.org/2": 1, "https://a.org/4": 2}
    more = spark.createDataFrame([("https://a.org/1", "/2"), ("https://a.org/1", "4#x"), ("https://a.org/2", "https://b.org/3"), ("https://a.org/4", "//b.org/3")], "url string, link string")
    crawl = lambda cap: {r.url: r.crawl_depth for r in readers.replay_crawl(pages, more, ["https://a.org/1"], same_domain=False, domain_cap=cap).collect()}
    assert crawl(5) == {"https://a.org/1": 0, "https://a.org/2": 1, "https://a.org/4": 1, "https://b.org/3": 2}
    assert crawl(1) == {"https://a.org/1": 0}  # pages beyond the cap aren't fetched, so their links aren't known
    hosts = ["https://a.org/x", "http://10.0.0.1/", "http://127.0.0.1:80/", "http://[::1]/", "http://[2606:4700::1111]/", "http://8.8.8.8/", "http://2130706433/", "http://0x7f.1/", "http://localhost/", "http://x.local/", "ftp://a.org/", "http://100.64.0.1/", "http://u@10.0.0.1/", "http://3.a.org/"]
    ok = [r[0] for r in spark.createDataFrame([(i, h) for i, h in enumerate(hosts)], "i int, u string").orderBy("i").select(readers.allowed(F.col("u"))).collect()]
    assert ok == [True, False, False, False, True, True, False, False, False, False, False, False, False, True]
    dump = spark.createDataFrame([([("t1", "u1", "s1"), ("t2", "u2", "s2")],)], "items array<struct<title:string,link:string,snippet:string>>")
    assert [tuple(r) for r in readers.search_results(dump, "q", most=1).collect()] == [(0, "u1", "t1\ns1", "q")]
    (tmp_path / "c.yaml").write_text("sources:\n  - {name: a, n: 1}\n  - {name: b}\n")
    assert [tuple(r) for r in readers.read_yaml(spark, str(tmp_path / "c.yaml"), "sources").collect()] == [(0, '{"n": 1, "name": "a"}'), (1, '{"name": "b"}')]
    copied = readers.ingest(spark, [str(files)], str(tmp_path / "in")).collect()
    assert sorted(r.size for r in copied) == [2, 5, 5] and all((tmp_path / "in" / r.name).read_bytes() is not None and hashlib.sha256((tmp_path / "in" / r.name).read_bytes()).hexdigest() == r.sha256 for r in copied)
    with pytest.raises(ValueError):
        readers.ingest(spark, [str(files)], str(tmp_path / "in2"), most_files=2)
    repos = spark.createDataFrame([("u1", 5, "MIT"), ("u1", 5, "MIT"), ("u2", 9, "NOASSERTION"), ("u3", 1, None)], "url string, stars long, spdx string")
    assert [(r.url, r.license_status) for r in readers.repositories(repos, least_stars=2).collect()] == [("u2", "unknown"), ("u1", "verified")]
    (tmp_path / "p.xml").write_text("<feed><entry><id>http://arxiv.org/abs/2401.1v2</id><title>A\n  b</title><summary> s\n t </summary></entry></feed>")
    assert [tuple(r) for r in readers.papers(spark, str(tmp_path / "p.xml")).collect()] == [("2401.1", "2", "A b", "s t")]


def test_store(spark, tmp_path):
    s = store.RunStore(spark)
    run = lambda i, status, at: spark.createDataFrame([(i, "e", status, "sha", at)], "id string, experiment_id string, status string, git_sha string, started_at string")
    s.upsert("experiments", spark.createDataFrame([("e", "exp", "t0", "t0")], "id string, name string, created_at string, updated_at string"))
    s.upsert("runs", run("r1", "RUNNING", "t1"))
    s.upsert("runs", run("r1", "PASS", "t9"))
    s.upsert("runs", run("r2", "PASS", "t2"))
    assert [(r.id, r.status, r.started_at) for r in s.search().collect()] == [("r2", "PASS", "t2"), ("r1", "PASS", "t1")]
    m = spark.createDataFrame([(1, "r1", "loss", 3.0, 1), (2, "r1", "loss", 2.0, 5), (3, "r1", "loss", 9.0, None)], "id long, run_id string, metric_name string, metric_value double, step long")
    s.replace("metrics", m)
    s.replace("metrics", m)
    assert s.t["metrics"].count() == 3 and s.latest_metrics("r1").first().metric_value == 2.0
    s.replace_sources("d", spark.createDataFrame([(1, "d", "web", "a"), (2, "d", "web", "b")], "id long, dataset_id string, kind string, identifier string"), spark.createDataFrame([(1, 5)], "source_id long, documents long"))
    s.upsert("datasets", spark.createDataFrame([("d", "r1", "g")], "id string, run_id string, dataset_group string"))
    assert [(r.id, r.documents) for r in s.source_lineage("r1").collect()] == [(1, 5), (2, None)]
    c = spark.createDataFrame([(1, "r1", 10, 3.0), (2, "r1", 30, 2.0), (3, "r1", 20, None)], "id long, run_id string, step long, best_val_loss double")
    s.replace("checkpoints", c)
    assert [r.id for r in s.best_checkpoint("r1").collect()] == [2] and [r.id for r in s.kept_checkpoints("r1", 2).collect()] == [2, 3]
    assert {k: d.count() for k, d in s.compare("r1", "r2").items()} == {"runs": 2, "hardware": 0, "stages": 0, "artifacts": 0}
    assert set(s.lineage("r1")) == {"run", "datasets", "stages", "artifacts", "configs", "sources", "checkpoints", "metrics", "evaluations", "runtime_estimates", "warnings", "errors"} and s.dangling().count() == 0
    s.write(str(tmp_path / "store"))
    again = store.RunStore.read(spark, str(tmp_path / "store"))
    shot = again.snapshot("r1").first()
    assert (shot.metrics, shot.step, shot.checkpoints, shot.best_loss, shot.loss, shot.checkpoint, shot.artifact_integrity) == ({"loss": 2.0}, 5, 3, 2.0, 2.0, True, False)
    assert {r.name: r.status for r in again.validate("r1").collect()}["run exists"] == "PASS"
    assert store.final_status(spark.createDataFrame([("PASS",), ("WARN",)], "status string")).first().status == "WARN"


def run_manifest(run_id, status, warnings=()):
    m = provenance.new_run({"crawl": {"a": 1}}, run_id=run_id, dataset_id="d", started="2024-01-01T00:00:00", git={"commit": "c", "branch": "b", "dirty": True})
    m["stages"] = {"clean": {"status": "PASS", "start": "s", "end": "e", "duration_seconds": 1.5, "metrics": {"document_count": 3, "input_document_count": 4, "token_count": None}}}
    m["artifacts"] = [{"stage": "clean", "path": "p", "sha256": "0" * 64, "size": 9}]
    return m | {"final_status": status, "warnings": list(warnings)}


def test_run_manifests_in_the_store(spark, tmp_path):
    s, top = store.RunStore(spark), f"file://{tmp_path}"
    for name, status, warnings in (("r1", "RUNNING", ["w1", "w2"]), ("r2", "PASS", [])):
        provenance.write_run_manifest(spark, f"{top}/runs/{name}/run_manifest.json", run_manifest(name, status, warnings))
    glob = f"{top}/runs/*/run_manifest.json"
    for _ in range(2):
        s.sync(store.read_run_manifests(spark, glob))
        assert {k: s.t[k].count() for k in ("experiments", "runs", "stages", "metrics", "artifacts", "configs", "warnings", "errors")} == {"experiments": 1, "runs": 2, "stages": 2, "metrics": 4, "artifacts": 2, "configs": 2, "warnings": 2, "errors": 0}
    m = provenance.resume_run(spark, f"{top}/runs/r1/run_manifest.json", "2024-01-02")
    assert m["final_status"] == "RUNNING" and m["timestamps"]["updated"] == "2024-01-02"
    provenance.write_run_manifest(spark, f"{top}/runs/r1/run_manifest.json", run_manifest("r1", "PASS"))
    s.sync(store.read_run_manifests(spark, glob))
    r = s.t["runs"].where("id = 'r1'").first()
    assert (r.status, r.git_sha, r.git_dirty, r.started_at) == ("PASS", "c", 1, "2024-01-01T00:00:00") and s.t["warnings"].count() == 0
    assert {(x.metric_name, x.metric_value) for x in s.t["metrics"].collect()} == {("clean.document_count", 3.0), ("clean.input_document_count", 4.0)}
    assert s.t["stages"].first().records_in == 4 and {x.status for x in s.validate("r1").where("name in ('run exists', 'artefacts hashed', 'stages ended')").collect()} == {"PASS"}
    (tmp_path / "runs" / "r2" / "run_manifest.json").write_text('{"schema": 2}')
    with pytest.raises(Exception):
        s.sync(store.read_run_manifests(spark, glob))
        s.t["runs"].collect()
    with pytest.raises(ValueError):
        (tmp_path / "old.json").write_text('{"schema": 1}')
        provenance.resume_run(spark, f"{top}/old.json", "x")


def lineage_case():
    h = {"weighted": "w", "tokenizer": "t", "a.bin": "s", "checkpoint": "c", "source.manifest": "1", "shards.manifest": "2", "tokenizer.manifest": "3", "weighted.manifest": "4", "snap.json": "5"}
    ids = {"dataset_config_sha256": "x", "tokenizer_config_sha256": "y", "shard_config_sha256": "z"}
    own = {"config_identities": ids, "run_id": "r"}
    m = {
        "source": {"schema": 3, "run_id": "r", "source_definition_sha256": provenance.stable_hash({"web": "q"}), "source_definition_files": {"web": {"sha256": "q"}}}, "weighted": {"sha256": "w", "provenance": own}, "tokenizer": {"sha256": "t", "provenance": own},
        "shards": {"files": [{"name": "a.bin", "sha256": "s"}], "provenance": own | {"tokenizer_sha256": "t"}}, "export": {"checkpoint_sha256": "c"},
        "checkpoint": {"sha256": "c", "provenance": own | {"schema": 3, "config_snapshots": {"d": "snap.json"}, "source_manifest_sha256": "1", "shard_manifest_sha256": "2", "parent_artifact_ids": ["shard-manifest:2", "tokenizer-manifest:3", "dataset-manifest:4", "source-manifest:1"]}},
    }
    return m, h


def test_lineage_checks():
    m, h = lineage_case()
    good = provenance.lineage_checks(m, h)
    assert len(good) == 19 and {s for _, s, _ in good} == {"PASS"} and good[-1][0] == "overall"
    status = lambda m, h: {n: s for n, s, _ in provenance.lineage_checks(m, h)}
    assert status(m, h | {"a.bin": "other"})["shard artefacts"] == "FAIL" and status(m, h | {"a.bin": "other"})["overall"] == "FAIL"
    assert status(m | {"weighted": None}, h) == {"source manifest": "PASS", "weighted manifest": "FAIL", "tokenizer manifest": "PASS", "shards manifest": "PASS"}
    assert status(m | {"checkpoint": None}, h)["checkpoint lineage"] == "WARN"
    old = m | {"checkpoint": {"sha256": "c", "provenance": {"schema": 2}}}
    assert status(old, h)["checkpoint lineage"] == "LEGACY"
    assert status(m, h | {"shards.manifest": "9"})["parents"] == "FAIL" == status(m, h | {"shards.manifest": "9"})["checkpoint to shards"]
    assert status(m | {"source": m["source"] | {"schema": 1}}, h)["configuration"] == "FAIL"


def test_record_hash_is_of_the_canonical_record(spark):
    import json

    rows = [("ü\n\"x\"", None, 3, 1.5, {"b": "2", "a": "1"}, [1, None])]
    d = spark.createDataFrame(rows, "t string, none string, n long, f double, m map<string,string>, l array<int>")
    want = json.dumps(dict(zip("t none n f m l".split(), rows[0], strict=True)), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert d.select(provenance.record_hash(*d.columns)).first()[0] == hashlib.sha256(want.encode()).hexdigest()


def test_an_artefact_is_never_missing_while_it_is_replaced(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/s"
    provenance.write_stage(spark.range(3), folder, "k", {})
    provenance.write_stage(spark.range(4), folder, "k", {})
    assert spark.read.parquet(folder).count() == 4 and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["s", "s.manifest"]


def test_profiles_and_groups(spark):
    p = spark.createDataFrame([(1, "a"), (2, "b")], "dataset_id int, group_id string")
    g = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "group_id string, v int")
    assert sorted((r.dataset_id, r.v) for r in contract.bind_profiles(p, g).collect()) == [(1, 1), (2, 2)]
    for bad_p, bad_g in ((p, g.where("group_id <> 'b'")), (p.unionAll(p), g), (p, g.unionAll(g))):
        with pytest.raises(Exception):
            contract.bind_profiles(bad_p, bad_g).collect()


def test_modes_and_indexes(spark):
    d = spark.createDataFrame([(0, "a b c d e f g", 1.0), (1, "a b c d e f g", 2.0), (2, "x y z", 1.0)], "seq long, text string, final_weight double")
    assert sorted(r.seq for r in dedup.dedup(d, "auto").collect()) == [1, 2] == sorted(r.seq for r in dedup.dedup(d, "fallback").collect())
    encoder = lambda c: F.array(F.char_length(c).cast("float"), F.lit(1.0).cast("float"))
    assert sorted(r.seq for r in dedup.dedup(d, "embedding", encoder=encoder, threshold=0.999).collect()) == [1, 2]
    for bad in (lambda: dedup.dedup(d, "embedding"), lambda: dedup.dedup(d, "other"), lambda: dedup.index_choice("hnsw", 5)):
        with pytest.raises(ValueError):
            bad()
    assert (dedup.index_choice("ivf", 55), dedup.index_choice("ivf", 10**6), dedup.index_choice("flat", 5)) == (("ivf", 5, 5), ("ivf", 100, 10), ("flat", 0, 0))
    r = np.random.default_rng(2)
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(r.standard_normal((300, 6)))], "vec_id long, embedding array<double>")
    exact, cells = dedup.topk(v, 5), dedup.topk(v, 5, kind="ivf", cells=20)
    both = exact.join(cells.drop("rank"), ["id", "neighbour"]).count()
    assert cells.count() == 1500 and both > 0.8 * 1500
    t = dedup.dedup_totals(3, d.where("seq < 2")).first()
    assert tuple(t) == (3, 2, 1, 0.333333)
    w = sampling.totals(d, d.where("seq = 0")).first()
    assert (w.docs_in, w.docs_out, w.total_weight) == (3, 1, 4.0)


def test_shard_reader(spark, tmp_path):
    toks = {f"train_{k:05d}.bin": np.arange(k * 100, k * 100 + n, dtype="<u2") for k, n in enumerate((25, 3, 0, 12))}
    files = []
    for name, x in toks.items():
        (tmp_path / name).write_bytes(x.tobytes())
        files.append((name, x.nbytes, hashlib.sha256(x.tobytes()).hexdigest()))
    reader = packing.ShardReader(str(tmp_path), files, 8, seed=1)
    assert reader.names == sampling.shard_order(list(toks), 1) and sorted(reader.names) == sorted(toks)
    windows = [x[a : a + 9] for name in reader.names for x in [toks[name]] for a in range(0, len(x) - 8, 8)]
    x, y = reader.next_batch(2 * len(windows) + 1)  # twice round
    want = (windows * 3)[: 2 * len(windows) + 1]
    assert (x == np.array([w[:-1] for w in want])).all() and (y == np.array([w[1:] for w in want])).all()
    state = reader.state()
    a = reader.next_batch(3)[0]
    other = packing.ShardReader(str(tmp_path), files, 8, seed=1)
    other.restore(state)
    assert (other.next_batch(3)[0] == a).all()
    bad = [(files[0][0], files[0][1] + 1, files[0][2])], [(files[0][0], files[0][1], "0" * 64)], [(files[0][0], files[0][1], None)], []
    for f in bad:
        with pytest.raises(ValueError):
            packing.ShardReader(str(tmp_path), f, 8)
    with pytest.raises(ValueError):
        packing.ShardReader(str(tmp_path), files, 50).next_batch(1)
    with pytest.raises(ValueError):
        other.restore(state | {"length": 9})


def test_prefilters_never_hide_a_match(spark):
    from loomtext.functions import fixed

    every = [(p, True) for ps in fixed.EXCLUSIONS.values() for p in ps] + fixed.SIGNAL_REWARDS + fixed.SIGNAL_PENALTIES + [(p, True) for p in fixed.QUALITY_REWARDS + fixed.QUALITY_PENALTIES]
    texts = ["Figure 12 SHOWS", "the Lemma and PROOF", "O(N) Algorithm", "you have got\na diagnosis", "PRESCRIBE some Medication", "cures Cancer", "Vaccines cause autism", "TV review", "de def x", "Smith et al. 2001.12345", "Section  3", "!!!!!!!!!!", "no no no no no no", "sign up today", "", None, "detoxifies and cure", "API schema"]
    d = col(spark, texts).orderBy("seq")
    joined = d.select(*[T.matches(F.col("x"), p, i).alias(f"a{k}") for k, (p, i) in enumerate(every)], *[T.found(F.col("x"), F.lower(F.col("x")), p, i).alias(f"b{k}") for k, (p, i) in enumerate(every)]).collect()
    assert all(bool(r[f"a{k}"]) == r[f"b{k}"] for r in joined for k in range(len(every)))


def test_cleaning_computes_each_text_once(spark, sf):
    from loomtext.plans import registry

    plan = clean.with_clean_text(registry.documents(spark, sf), clean.CleanConfig())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("<[^>]+>") == 1 and plan.count("FileScan") == 1


def test_stage_skipping(spark, tmp_path):
    folder, made = f"file://{tmp_path}/s", []

    def make():
        made.append(1)
        return spark.range(5)

    for provenance_, skipped in (({"a": 1}, False), ({"a": 1}, True), ({"a": 2}, False)):
        df, skip = provenance.run_stage(spark, folder, "clean", provenance_, make)
        assert skip is skipped and df.count() == 5
    assert len(made) == 2 and provenance.content_hash(spark.range(5).repartition(3)) == provenance.content_hash(spark.range(5))
    with pytest.raises(ValueError):
        provenance.write_stage(spark.range(0), folder, "clean", {})
    assert provenance.stable_hash({"b": 1, "a": 2}) == hashlib.sha256(b'{"a":2,"b":1}').hexdigest()


def test_small_facts(spark, tmp_path):
    from loomtext.operators import reporting

    d = spark.createDataFrame([(["a", "b"], ["b", "c"]), (["a"], ["a"])], "x array<string>, y array<string>")
    assert [(r.d.missing, r.d.extra, r.d.equal) for r in d.select(store.key_difference(F.col("x"), F.col("y")).alias("d")).collect()] == [(["c"], ["a"], False), ([], [], True)]
    assert [r[0] for r in d.select(F.array_sort(store.missing_parents(F.col("x"), F.col("y")))).collect()] == [["c"], []] and [r[0] for r in d.select(store.ordered_unique("x", "y")).collect()] == [["a", "b", "c"], ["a"]]
    v = col(spark, ["1.5", "true", "x", None, " FALSE", "0"]).orderBy("seq")
    assert [r[0] for r in v.select(reporting.json_number(F.col("x"))).collect()] == [1.5, 1.0, None, None, 0.0, 0.0]
    assert [r[0] for r in v.select(reporting.json_bool(F.col("x"))).collect()] == [True, True, False, False, False, False]
    assert d.limit(1).select(reporting.json_text(F.struct("x", F.lit(None).alias("n")))).first()[0] == '{"x":["a","b"],"n":null}'
    names = provenance.snapshot_configs(spark, f"file://{tmp_path}", {"crawl": {"a": 1}, "clean": {}})
    assert names == provenance.snapshot_configs(spark, f"file://{tmp_path}", {"crawl": {"a": 1}, "clean": {}}) and all((tmp_path / n).is_file() for n in names.values())
    p = spark.createDataFrame([("train", 0, 0, [1, 2, 3]), ("train", 0, 3, [4])], "part string, shard long, at long, piece array<int>")
    files = packing.write_shards(p, str(tmp_path)).cache()
    m = packing.write_shard_manifest(files, str(tmp_path), dtype="<u2", sequence_length=2, vocab_size=9)
    reader = packing.ShardReader(str(tmp_path), [(f["name"], f["size"], f["sha256"]) for f in m["files"]], 2)
    assert reader.next_batch(1)[0].tolist() == [[1, 2]] and packing.verify_shards(files, str(tmp_path)).first().ok
    stats = reporting.dataset_stats(spark.createDataFrame([("a", 5), ("b", 7)], "path string, length long"), {"02_cleaned": spark.createDataFrame([("x y",)], "text string")}).first()
    assert tuple(stats) == (2, 12, 1, 2)
    docs = spark.range(50).select(F.col("id").cast("string").alias("doc_id"))
    assert {r.doc_id for r in sampling.hash_sample(docs, 9).collect()} == {r.doc_id for r in sampling.hash_sample(docs.repartition(7), 9).collect()}
    assert packing.ids_fit(1 << 16, "<u2") and not packing.ids_fit((1 << 16) + 1, "<u2")
