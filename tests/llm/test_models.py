"""The three classifiers: held-out accuracy, independence from labels of held-out rows, odd rows."""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext.llm import langid, quality, queries, toxicity
from loomtext.llm.common import table

from . import cases

SF = "/root/testdata/sf0.01"


def accuracy(spark, scored, label):
    y = table(spark, SF, "labels")
    r = scored.join(y, "doc_id").where("held_out").select(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    return r[0], r[1]


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = quality.score_quality(docs, labels)
    a, n = accuracy(spark, got, "quality")
    assert n > 50 and a > 0.95
    # labels of held-out rows change nothing
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.score_quality(docs, other).exceptAll(got).count() == 0


def test_discriminant_equals_a_direct_density():
    r = np.random.default_rng(0)
    x = [r.standard_normal((200, 3)), r.standard_normal((100, 3)) * 2 + 1]
    m = quality.Discriminant.fit(np.array([200.0, 100.0]), np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]), 0.0, 0.0)
    p = r.standard_normal((5, 3))
    dens = []
    for v in x:
        c = np.cov(v.T, bias=True) + 1e-6 * np.eye(3)
        d = p - v.mean(0)
        dens.append(np.log((len(v) + 1) / 302) - 0.5 * (np.log(np.linalg.det(c)) + np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)))
    assert np.allclose(m.score(p), 1 / (1 + np.exp(dens[0] - dens[1])))


def test_toxicity_held_out_and_obfuscated(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.fit_toxicity(docs, labels)
    y = labels.join(docs.select("doc_id", "text"), "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    rows = toxicity.score_toxicity(y.withColumnRenamed("toxic", "y"), model).select("y", "toxic").collect()
    hit = sum(r.y == r.toxic == 1 for r in rows)
    assert len(rows) > 500 and hit >= 0.88 * sum(r.y for r in rows) and hit >= 0.99 * sum(r.toxic for r in rows)
    clean = "The erentnd of thation was in the ononre and with heared " * 6
    for word in ("idiot", "1d10t", "!d!ot", "i d i o t", "iiidiiioooot", "i.d.i.o.t", "tr@sh", "w0rthle55", "STUPID", "$tupid"):
        t = pa.array([clean + word + " the " + word + " " + clean, clean], pa.large_string())
        s = model.score(t, toxicity.Restorer(model.costs))
        assert s[0] >= 0.5 > s[1], (word, s)


def english_restorer():
    text = "you are such a stupid idiot and your work is total garbage the other people said that it is worthless trash " * 50
    sym = toxicity.symbols_of(" " + text).astype(np.int64)
    sym = np.repeat(sym, np.where(sym == 0, 2, 1))
    c = np.bincount((sym[:-2] * toxicity.A + sym[1:-1]) * toxicity.A + sym[2:], minlength=toxicity.A**3)
    return toxicity.Restorer(toxicity.character_costs(c.reshape((toxicity.A,) * 3)))


@pytest.mark.parametrize("mark", [".", "_", "-", "/", "\u00a0", "\u3000", "\u2003"])
def test_every_part_of_a_long_word_is_read(mark):
    text = mark.join("the other people said that you are a $tupid 1d10t and worthless".split())
    keys, t, k = toxicity.restored_words(pa.array(["total trash", text, ""], pa.large_string()), english_restorer())
    assert [keys[i] for i in k[t == 0]] == ["total", "trash"]
    assert [keys[i] for i in k[t == 1]][:12] == ["the", "other", "people", "said", "that", "you", "are", "a", "stupid", "idiot", "and", "worthless"]


def test_long_disguises_are_read():
    restorer = english_restorer()
    assert "stupid" in restorer.restore("-".join("stupididiotgarbagestupid"))
    assert restorer.restore("1d1" + "0" * 60 + "t") == ("idiot",)
    assert restorer.restore("s" + "t" * 70 + "up1d") == ("stupid",)


@pytest.mark.parametrize("n", [40, 400, 4000])
def test_a_disguised_word_is_read_wherever_it_lies_in_a_long_token(n):
    restorer = english_restorer()
    filler = ["other", "people", "said", "that", "work"]
    count = n // 5
    for at in sorted({0, 1, count // 2, count - 1}):
        parts = [filler[i % 5] for i in range(count)]
        parts[at] = "1d10t"
        assert "idiot" in restorer.restore("-".join(parts)), (n, at)


@pytest.mark.parametrize("n", [10, 31, 33, 4000])
def test_one_rule_for_tokens_of_any_length(n):
    """Each part is read by itself, with its neighbour, and by the best path of the whole, however long the token is."""
    restorer = english_restorer()
    for part in ("1d10t", "id.iot", "stu-pid"):
        head = "you," + part
        token = head + ("," + "the," * n)[: max(0, n - len(head))]
        keys = restorer.restore(token)
        assert keys[0] == "you" and ("idiot" if part[1] != "t" else "stupid") in keys, (token, keys[:9])
    for word in ("idiot", "such", "hot", "a"):
        assert {"idiot", word} <= set(restorer.restore(f"{word},idiot")) and {"idiot", word} <= set(restorer.restore(f"{word}/1d10t" + "/the" * n))


def test_words_that_differ_by_a_double_letter_stay_different():
    restorer = english_restorer()
    texts = pa.array(["ass as butt but hoot hot", "hooot", "WORTHLESS worthlesss"], pa.large_string())
    keys, t, k = toxicity.restored_words(texts, restorer)
    assert [keys[i] for i in k[t == 0]] == ["ass", "as", "butt", "but", "hoot", "hot"]
    assert {keys[i] for i in k[t == 1]} <= {"hoot", "hot"} and len(k[t == 1]) == 1
    assert [keys[i] for i in k[t == 2]] == ["worthless"] * 2
    assert toxicity.word_features("hoot") == ["hoot", "^hoot", "=hot"] and toxicity.word_features("") == []


def test_letters_of_other_alphabets_stay_themselves():
    restorer = english_restorer()
    assert "дурак" in restorer.restore("ду.рак") and "привет" in restorer.restore("при.вет")
    assert restorer.restore("дуууурак") == ("дурак",)


def test_words_of_stand_ins_alone_and_numbers():
    restorer = english_restorer()
    assert restorer.restore("7|2@$#")[0] and restorer.restore("1|)10") == ("",) and restorer.restore("!!!") == ("",)
    assert [restorer.restore(w) for w in ("2019", "100", "1945", "$100", "31", "1,000", "...")] == [("",)] * 7
    assert restorer.restore("$7+@$#")[0].startswith("st")


def test_ten_thousand_spaced_letters():
    restorer = english_restorer()
    letters = "theotherpeople" * 700 + "garbage" + "theotherpeople" * 14
    keys, t, k = toxicity.restored_words(pa.array([" ".join(letters)], pa.large_string()), restorer)
    assert len(letters) > 10_000 and "garbage" in keys


def test_words_spelled_over_many_letters_stay_whole():
    restorer = english_restorer()
    for n in range(120, 140):  # a run's end and a word lie at every place about 128 letters
        letters = ("the" * 50)[:n] + "garbage"
        text = " ".join(letters)
        keys, t, k = toxicity.restored_words(pa.array([text], pa.large_string()), restorer)
        assert [keys[i] for i in k[len(letters) :]] == restorer.restore_spaced(letters)
        assert "garbage" in keys, n


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(1)
    restorer = toxicity.Restorer(toxicity.character_costs(r.integers(0, 50, (28, 28, 28))))
    for word in ("a1b", "s.s", "xxx", "0@", "a!l", "heeello"):
        best = None
        for path in itertools.product(*restorer.lattice(word)):
            total, a, b = sum(c for _, c, _ in path), 0, 0
            for s in [s for s, _, _ in path if s >= 0] + [0]:
                total += restorer.cost[a][b][s]
                a, b = b, s
            text = "".join(x for _, _, x in path)
            best = min(best or (total, text), (total, text))
        assert restorer.decode(word) == best[1], word


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(3)
    e, t, start, n = r.standard_normal((7, 3)), r.standard_normal((3, 3)), r.standard_normal(3), np.array([4, 1, 2])
    post, expected, logs = langid.forward_backward(e, n, t, start)
    at, pairs = 0, np.zeros((3, 3))
    for k in n:
        w, p = 0.0, np.zeros((k, 3))
        own = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(k)):
            x = np.exp(start[path[0]] + sum(e[at + i, c] for i, c in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
            w += x
            for i, c in enumerate(path):
                p[i, c] += x
            for a, b in zip(path, path[1:]):
                own[a, b] += x
        assert np.allclose(post[at : at + k], p / w) and np.isclose(logs[at : at + k].sum(), np.log(w))
        pairs += own / w
        at += k
    assert np.allclose(expected, pairs)


@pytest.mark.parametrize("block", [1, 7, 128])
def test_long_chains_in_blocks_equal_the_uncut_chain(monkeypatch, block):
    r = np.random.default_rng(4)
    n = np.array([5000, 3, 0, 128, 129, 1, 700])
    e, t, start = 2 * r.standard_normal((n.sum(), 4)), r.standard_normal((4, 4)), r.standard_normal(4)
    monkeypatch.setattr(langid, "BLOCK", 10**6)
    whole = langid.forward_backward(e, n, t, start)
    monkeypatch.setattr(langid, "BLOCK", block)
    for a, b in zip(langid.forward_backward(e, n, t, start), whole, strict=True):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-9)


def test_all_of_a_long_word_counts():
    a, b = "begin" * 3 + "x" * 4 + "end" * 4, "begin" * 3 + "q" * 4 + "end" * 4
    assert set(langid.word_features(a, frozenset())) != set(langid.word_features(b, frozenset()))
    w, off = langid.language_words(pa.array(["one\u3000two\u00a0three", None, "12"], pa.large_string()).fill_null(""))
    assert w.to_pylist() == ["one", "two", "three"] and off.tolist() == [0, 3, 3, 3]


def test_fitting_is_bounded_when_one_id_has_most_rows(spark):
    docs = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("some words and "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    docs = docs.unionByName(spark.createDataFrame([(i, "other words here", "en") for i in range(2, 9)], "doc_id long, text string, lang string"))
    got = langid.training_texts(docs, rows_per_language=5, id_col="doc_id", text_col="text", lang_col="lang")
    assert len(got) == 5 and {lang for lang, _ in got} == {"en"}
    labels = spark.createDataFrame([(1, 1)] * 50 + [(i, i % 2) for i in range(2, 9)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels, sample_rows=3)
    assert 0 < 1 / (1 + np.exp(-model.bias)) < 1


def test_language_held_out_and_switched(spark):
    docs = table(spark, SF, "documents")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.select(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.97
    model = langid.fit_languages(docs)
    some = {r.lang: r.t.split()[:40] for r in docs.where("n_chars > 1500 and n_chars < 9000").groupBy("lang").agg(F.min_by("text", "doc_id").alias("t")).collect()}
    text = pa.array([" ".join(some["en"] + some["de"])], pa.large_string())
    share, n = langid.posteriors(text, model, {})
    part = dict(zip(model.langs, share[0] / n[0], strict=True))
    assert 0.3 < part["en"] < 0.7 and 0.3 < part["de"] < 0.7


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, clash):
    docs = cases.clashing(cases.odd(spark)) if clash else cases.odd(spark)
    n = docs.count()
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, 0, 1), (9, None, 7), (100, 1, 1), (101, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for out in (quality.score_quality(docs, labels), toxicity.toxicity(docs, labels)):
        rows = out.collect()
        assert len(rows) == n and all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in rows)
    rows = langid.identify(docs).collect()
    assert len(rows) == n
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[4].lang_pred == by[5].lang_pred == by[6].lang_pred == by[12].lang_pred == "und" and by[4].score == 0


def test_empty_tables(spark):
    e = cases.empty(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score_quality(e, labels).count() == toxicity.toxicity(e, labels).count() == langid.identify(e).count() == 0
    some = cases.odd(spark).where("doc_id < 6")
    assert {round(r.score, 6) for r in quality.score_quality(some, labels).collect()} == {0.5}
    assert {round(r.score, 6) for r in toxicity.toxicity(some, labels).collect()} == {0.5}
    assert {r.lang_pred for r in langid.identify(some.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


SMALL = "/root/testdata/sf0.001"


def plain_statistics(t):
    """The fourteen statistics of one text, character by character."""
    kinds = []
    for c in t:
        special = next((k for chars, k in ((".,;:?-'\"()", "stop"), ("!", "bang"), ("|", "bar"), ("#$%&*+/<=>@\\^_`~{}[]", "symbol")) if c in chars), None)
        kinds.append(special or ("lower" if ord(c) >= 0x3000 else "upper" if c.isupper() else "lower" if c.isalpha() else "digit" if c.isdigit() else "newline" if c == "\n" else "space" if c.isspace() else "other"))
    n = {k: kinds.count(k) for k in ("stop", "bang", "bar", "symbol", "upper", "lower", "digit", "newline", "space")}
    runs = sum(t[i] == t[i - 1] and kinds[i] in ("bang", "bar", "symbol") for i in range(1, len(t)))
    w = [x for x in re.split(r"[ \t\n\r\x0b\x0c]+", t) if x]
    m, size = max(len(w), 1), [len(x) for x in w]
    mean = sum(size) / m
    letters, full = max(n["upper"] + n["lower"], 1), max(len(t) - n["space"] - n["newline"], 1)
    rate = lambda x, of: math.log(x / of + 1e-3)
    return [
        math.log1p(len(w)), mean, math.sqrt(max(sum(s * s for s in size) / m - mean * mean, 0)), rate(n["upper"], letters), rate(n["digit"], full), rate(n["stop"], full), rate(n["bang"], full), rate(n["bar"], full), rate(n["symbol"], full),
        rate(runs, full), math.log1p(len(w) / (n["newline"] + 1)), len(set(w)) / m, sum(s <= 3 for s in size) / m, rate(sum(x[0].isupper() for x in w), m),
    ]


def test_quality_query_equals_a_plain_run_of_the_model(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    model = quality.fit(quality.document_statistics(docs), labels, "quality", 0.2, 0.1)
    got = {r.doc_id: r for r in queries.op9_quality(spark, SMALL).collect()}
    for r in docs.collect():
        x = np.array(plain_statistics(r.text))
        dens = []
        for c in (0, 1):
            z = model.whiteners[c] @ (x - model.means[c])
            dens.append(model.log_priors[c] - 0.5 * (model.log_dets[c] + z @ z))
        p = 1 / (1 + math.exp(min(500, max(-500, dens[0] - dens[1]))))
        assert abs(got[r.doc_id].score - p) < 1e-6 and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3), r.doc_id
    assert len(got) == docs.count()


def test_language_query_equals_a_plain_run_of_the_field(spark):
    docs = table(spark, SMALL, "documents")
    model = langid.fit_languages(docs)
    got = {r.doc_id: r for r in queries.op7_language(spark, SMALL).collect()}
    trans, start = np.exp(model.transition), np.exp(model.start)
    for r in docs.collect():
        w = [re.sub(r"^['’]+|['’]+$", "", "".join(c for c in x.lower() if unicodedata.category(c)[0] in "LM" or c in "'’")) for x in (r.text or "").split()]
        e = model.emissions([x for x in w if any(unicodedata.category(c)[0] == "L" for c in x)])
        if not len(e):
            assert got[r.doc_id].lang_pred == "und"
            continue
        x = np.exp(e - e.max(1, keepdims=True))
        a, b = np.zeros_like(x), np.ones_like(x)
        for i in range(len(x)):
            a[i] = x[i] * (start if i == 0 else a[i - 1] @ trans)
            a[i] /= a[i].sum()
        for i in range(len(x) - 2, -1, -1):
            b[i] = trans @ (x[i + 1] * b[i + 1])
            b[i] /= b[i].sum()
        post = a * b
        share = (post / post.sum(1, keepdims=True)).mean(0)
        assert abs(got[r.doc_id].score - share.max()) < 1e-6 and (got[r.doc_id].lang_pred == model.langs[share.argmax()] or np.sort(share)[-2] > share.max() - 1e-9), r.doc_id
    assert len(got) == docs.count()


def test_toxicity_query_equals_a_plain_run_of_the_model(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    model = toxicity.fit_toxicity(docs, labels)
    weight, restorer = dict(zip(model.lexicon, model.weights, strict=True)), toxicity.Restorer(model.costs)
    got = {r.doc_id: r for r in queries.op8_toxicity(spark, SMALL).collect()}
    for r in docs.collect():
        keys, run = [], ""
        for w in [*(r.text or "").lower().split(), ""]:
            if len(w) == 1:
                run += w
            else:
                keys += restorer.restore_spaced(run) if len(run) > 2 else []
                run = ""
            keys += restorer.restore(w) if w else []
        count = Counter(f for k in keys for f in toxicity.word_features(k))
        z = model.bias + sum(weight.get(f, 0.0) + (weight.get("%" + f, 0.0) if n >= toxicity.SHARE * len(keys) else 0.0) for f, n in count.items())
        assert abs(got[r.doc_id].score - 1 / (1 + math.exp(-z))) < 1e-9, r.doc_id
    assert len(got) == docs.count()
