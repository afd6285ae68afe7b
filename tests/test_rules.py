"""Many rules in one pass against each rule by itself, and folds of content by levels."""

from __future__ import annotations

import hashlib
import random
import re
import time

from loomtext.operators import rules, signals


def test_ten_thousand_rules_equal_each_rule(spark):
    r = random.Random(1)
    syllables = ["ka", "lo", "mi", "ne", "su", "ta"]
    word = lambda: "".join(r.choice(syllables) for _ in range(4))
    every = [(f"t{k % 4000:04d}", rf"\b{word()} {word()}s?\b" if k % 3 else rf"(?:{word()}|{word()})[ -]{word()}") for k in range(10_000)] + [("short", r"\bx\d+\b"), ("class", r"[aeiou]{5}")]
    texts = [None, "", "X12 and aeiou"] + [" ".join(r.choice([word(), "KALO" + word(), "\n"]) for _ in range(200)) for _ in range(30)]
    texts += [f"before {re.sub(r'[^a-z ]', '', p.split(')')[0].split('|')[0].replace('b', ''))} after" for _, p in every[:5]]
    book = rules.RuleBook(every)
    t = time.perf_counter()
    one_pass = [book.tags(x) if x else [] for x in texts]
    fast = time.perf_counter() - t
    t = time.perf_counter()
    compiled = [(tag, re.compile(p, re.I | re.S)) for tag, p in every]
    assert one_pass == [sorted({tag for tag, p in compiled if p.search(x)}) if x else [] for x in texts] and any(len(x) > 1 for x in one_pass)
    assert fast < (time.perf_counter() - t) / 3
    df = spark.createDataFrame([(k, x, "clash") for k, x in enumerate(texts)], "id long, text string, tags string")
    assert [x.tags for x in rules.tagged(df, every).orderBy("id").collect()] == one_pass
    assert rules.tagged(df.limit(0), every).count() == 0 and rules.tagged(df, []).where("size(tags) > 0").count() == 0


def test_folds_at_any_level(spark):
    r = random.Random(2)
    rows = [(s, p, f"text {p}") for s in ("a", "b") for p in r.sample(range(-50, 3000), 200)]
    df = spark.createDataFrame(rows, "source string, seq long, text string")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def fold(own, bits, levels):
        nodes = {p: sha(t) for p, t in own}
        for _ in range(levels):
            up = {}
            for p in sorted(nodes):
                up.setdefault(p >> bits, []).append(nodes[p])
            assert max(map(len, up.values())) <= 1 << bits
            nodes = {p: sha("".join(v)) for p, v in up.items()}
        return sha("".join(nodes[p] for p in sorted(nodes)))

    for bits, levels in ((12, 1), (4, 2), (3, 3)):
        got = {x.source: x.content_sha256 for x in signals.content_fold(df, "source", "text", "seq", bits=bits).collect()}
        assert signals.levels_for(min(p for _, p, _ in rows), max(p for _, p, _ in rows), bits) == levels
        assert got == {s: fold([(p, t) for x, p, t in rows if x == s], bits, levels) for s in ("a", "b")}
