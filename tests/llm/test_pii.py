"""Personal data: base spans against regular expressions, added spans, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from loomtext.llm import pii, queries

from . import cases

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and passes_luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


FINDER = pii.Finder()


def found(text, kinds=pii.BASE):
    return [(pii.KINDS[k], s, e) for k, s, e in FINDER.spans(text) if pii.KINDS[k] in kinds]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["1", "25", "256", "4111111111111111", "0", ".", ".", "-", " ", "+", "+4", "@", "a", "b.c", "_", "%", "x@y.z", "(", ")", "é", "日", "\n", "255", "9" * 9, "\U0001f600"]), max_size=40).map("".join))
def test_base_spans_equal_the_expressions(text):
    assert found(text) == base(text)


def test_base_spans_in_number_chains():
    r = random.Random(5)
    n = 0
    for _ in range(6000):
        digits = "".join(r.choice("0123456789") for _ in range(r.randint(14, 21)))
        text = "".join(c + r.choice(["", "", "", " ", "-", "."]) for c in digits) + r.choice(["", " 10.0.0.1", " +1 (555) 010-9999"])
        assert found(text) == base(text)
        n += any(k == "card" for k, _, _ in base(text))
    assert n > 20


def test_added_spans():
    text = "write to jo.doe [at] mail [dot] example.org or see https://user:pw@host.example.com/a?b=1). IBAN: GB82 WEST 1234 5698 7654 32, token = \"f3ef4d6b2755\" but no token of love, http://x, token password 1234567"
    got = {k: [text[s:e] for kk, s, e in found(text, pii.KINDS) if kk == k] for k in pii.KINDS}
    assert got["spelled_email"] == ["jo.doe [at] mail [dot] example.org"]
    assert got["url"] == ["https://user:pw@host.example.com/a?b=1"]
    assert got["account"] == ["GB82 WEST 1234 5698 7654 32", "f3ef4d6b2755", "1234567"]
    assert found("IBAN GB82 WEST 1234 5698 7654 33 subaccount 123456", ("account",)) == []
    assert pii.masked(text, FINDER.spans(text)).startswith("write to <spelled_email> or see <url>). IBAN: <account>, token = \"<account>\" but")


def test_long_runs_take_linear_time():
    t = time.perf_counter()
    for run in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "1 " * 200_000, "a@" * 200_000, "a@b." * 100_000, "+1 " * 130_000, "http://" * 60_000, "token " * 60_000, "a-" * 200_000 + "@" + "b-" * 200_000, "[at]" * 100_000):
        assert found(run, ()) == []
    assert time.perf_counter() - t < 20


def test_report_on_odd_rows(spark):
    rows = [r for r in cases.odd_rows()] + [(900, "mail a.b@c.de, 10.0.0.256, 10.0.0.25 and +49 (0) 555-123456, é 4111 1111-1111 1111", None, None, 0)]
    docs = cases.clashing(spark.createDataFrame(rows, cases.SCHEMA))
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.personal_data_report(docs).collect()), key=str)
    expected = []
    for r in rows:
        spans = base(r[1] or "")
        counts = [sum(k == kind for k, _, _ in spans) for kind in PATTERNS]
        expected.append((r[0], *counts, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()))
    assert got == sorted(expected, key=str) and any(sum(x[1:5]) == 4 for x in got)
    assert pii.personal_data_report(cases.empty(spark)).count() == 0
    masked = {r.doc_id: r.text for r in pii.mask_personal_data(docs).where("doc_id in (4, 900)").collect()}
    assert masked[4] is None and masked[900] == "mail <email>, 10.0.0.256, <ip> and <phone>, é <card>"
    assert pii.mask_personal_data(docs).columns == docs.columns


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op13_personal_data(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in spans) for kind in PATTERNS]
        assert ",".join(f"{k}:{s}:{e}" for k, s, e in spans) == ",".join(x for x in r.spans.split(",") if x.split(":")[0] in PATTERNS)
