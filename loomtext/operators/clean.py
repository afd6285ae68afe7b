"""Clean stage: strip and normalise, length gate, exact dedup, refusal scoring, then drop, flag or redact."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text as T
from .graph import durable

#: Numbers of later copies up to which they are broadcast (8 bytes each).
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class CleanConfig:
    """``groups``: name -> (weight, patterns). Case is ignored in all patterns. Actions: drop, flag, redact."""

    action: str = "drop"
    threshold: float = 0.12
    shortest: int = 80
    longest: int = 2_000_000
    strip_html: bool = True
    dom: bool = False
    normalise: bool = True
    dedup: bool = True
    refusal: bool = True
    groups: dict[str, tuple[float, list[str]]] = field(default_factory=dict)
    instant: list[str] = field(default_factory=list)


#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a start tag ends if they are the innermost open one.
_BLOCKS = "address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
ENDED_BY = {t: {"p"} for t in _BLOCKS} | {"li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "option": {"option"}, "a": {"a"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "tr": {"p", "td", "th", "tr"}, "body": {"head"}}
for _t in ("td", "th", "table", "fieldset"):
    ENDED_BY[_t] = ENDED_BY[_t] | {"a"}
#: Elements that an end tag of a lesser one doesn't end.
STRENGTH = {"div": 1, "td": 2, "th": 2, "tr": 3, "thead": 4, "tbody": 4, "tfoot": 4, "table": 5, "head": 6, "body": 6, "html": 7}


class _Text(HTMLParser):
    """Text of a page without some elements; pieces in a list. An end tag ends what is still open inside its element."""

    def __init__(self, dropped: list[str]):
        super().__init__(convert_charrefs=True)
        self.dropped, self.open, self.hidden, self.out, self.title, self.links, self._in_title = set(dropped), [], 0, [], [], [], False

    def _pop(self) -> str:
        tag = self.open.pop()
        self.hidden -= tag in self.dropped
        return tag

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href" and v]
        if tag == "title":
            self._in_title = True
        if tag in VOID:
            return
        while self.open and self.open[-1] in ENDED_BY.get(tag, ()):
            self._pop()
        self.open.append(tag)
        self.hidden += tag in self.dropped

    def handle_endtag(self, tag):
        if tag == "title":
            self._in_title = False
        own = STRENGTH.get(tag, 0)
        for other in reversed(self.open):
            if other == tag:
                while self._pop() != tag:
                    pass
                return
            if STRENGTH.get(other, 0) > own:
                return

    def handle_data(self, data):
        if self._in_title:
            self.title.append(data)
        if not self.hidden:
            self.out.append(data)


def page_parts(html: str, dropped: list[str]) -> tuple[str, str, list[str]]:
    """Text (pieces joined by a space), title and links of a page."""
    p = _Text(dropped)
    p.feed(html)
    p.close()
    return " ".join(p.out), "".join(p.title).strip(), p.links


def dom_text(html: Column) -> Column:
    """Text of a page by its elements, without those that hold no prose."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda x: None if x is None else page_parts(x, fixed.CLEAN_DROPPED)[0])

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(html)


def with_clean_text(d: DataFrame, cfg: CleanConfig, text: str = "text") -> DataFrame:
    """``d`` with its text stripped and normalised as the configuration says; null text becomes empty. Each step is computed once."""
    if cfg.strip_html:
        d = d.withColumn(text, dom_text(F.col(text))) if cfg.dom else T.once(d, **{text: T.strip_tags(F.col(text))})
    if cfg.normalise:
        d = d.withColumn(text, T.compatible(F.col(text)))
        return T.once(d, **{text: F.coalesce(T.normalise(F.col(text), nfkc=False), F.lit(""))})
    return d.withColumn(text, F.coalesce(F.col(text), F.lit("")))


def refusal_score(text: Column, cfg: CleanConfig) -> Column:
    """999 if an instant pattern occurs, else weighted matches per word (no words count as one)."""
    n = F.greatest(T.n_words(text), F.lit(1))

    def score(low: Column) -> Column:
        total, instant = F.lit(0.0), F.lit(False)
        for weight, patterns in cfg.groups.values():
            for p in patterns:
                total = total + T.counted(text, low, p) * weight
        for p in cfg.instant:
            instant = instant | T.found(text, low, p)
        return F.when(instant, F.lit(999.0)).otherwise(total / n)

    return T.let(F.lower(text), score)


HIT = "array<struct<group:string,pattern:string,start:int,end:int,matched:string>>"


def pattern_hits(text: Column, cfg: CleanConfig) -> Column:
    """All matches with their spans; of an instant pattern the first match alone."""
    groups = [(g, re.compile(p, re.I)) for g, (_, ps) in cfg.groups.items() for p in ps]
    instant = [re.compile(p, re.I) for p in cfg.instant]

    def one(x: str | None) -> list[dict]:
        if x is None:
            return []
        for p in instant:
            if m := p.search(x):
                return [{"group": "instant_drop", "pattern": p.pattern, "start": m.start(), "end": m.end(), "matched": m[0]}]
        return [{"group": g, "pattern": p.pattern, "start": m.start(), "end": m.end(), "matched": m[0]} for g, p in groups for m in p.finditer(x)]

    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, HIT)(text)


def redacted(text: Column, hits: Column) -> Column:
    """Spans replaced by [REMOVED]; overlapping spans are merged first, so the rest of the text stays whole."""

    def one(x: str | None, found) -> str | None:
        if x is None or found is None:
            return x
        spans: list[list[int]] = []
        for a, b in sorted((int(h["start"]), int(h["end"])) for h in found):
            if spans and a < spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        for a, b in reversed(spans):
            x = x[:a] + "[REMOVED]" + x[b:]
        return x

    def run(s: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(s, h, strict=True)])

    run.__annotations__ = {"s": pd.Series, "h": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(text, hits)


def clean(docs: DataFrame, cfg: CleanConfig, *, seq: str = "seq", text: str = "text") -> DataFrame:
    """Every row with ``text`` cleaned, ``clean_action``, ``clean_score``, ``flagged`` and ``kept``.

    Of equal cleaned texts the first by ``seq`` counts, among rows that pass the length gate; a copy that the refusal score would
    drop still makes later copies duplicates. ``seq`` tells rows apart. Null text counts as empty. Order of decisions: too_short, too_long, duplicate, then the score.
    """
    d = with_clean_text(docs, cfg, text)
    n = F.char_length(text)
    d = d.withColumn("_long", F.when(n < cfg.shortest, "too_short").when(n > cfg.longest, "too_long"))
    if cfg.dedup:
        # the cleaned rows are laid down; only hashes and numbers are exchanged, and the later copies' numbers come back as a list
        d = durable(d.withColumn("_h", F.when(F.col("_long").isNull(), F.sha2(text, 256))))
        first = d.where("_h is not null").groupBy("_h").agg(F.min(seq).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
        later = d.select(F.col(seq).alias("_later"), "_h").join(first, "_h").where("_later > _first").select("_later")
        later = durable(later)
        later = F.broadcast(later) if later.count() <= BROADCAST_ROWS else later
        d = d.join(later, d[seq] == later["_later"], "left").withColumn("_again", F.col("_later").isNotNull()).drop("_h", "_later")
    else:
        d = d.withColumn("_again", F.lit(False))
    score = refusal_score(F.col(text), cfg) if cfg.refusal else F.lit(0.0)
    d = d.withColumn("clean_score", F.when(F.col("_long").isNotNull() | F.col("_again"), F.lit(0.0)).otherwise(score))
    over = {"drop": "dropped", "flag": "flagged", "redact": "redacted"}[cfg.action]
    action = F.when(F.col("_long").isNotNull(), F.col("_long")).when(F.col("_again"), "duplicate").when(F.col("clean_score") >= cfg.threshold, over).otherwise("kept")
    d = d.withColumn("clean_action", action).drop("_long", "_again")
    if cfg.action == "redact":
        d = d.withColumn(text, F.when(F.col("clean_action") == "redacted", redacted(F.col(text), pattern_hits(F.col(text), cfg))).otherwise(F.col(text)))
    return d.withColumn("flagged", F.col("clean_action") == "flagged").withColumn("kept", F.col("clean_action").isin("kept", "flagged", "redacted"))


def outcomes(d: DataFrame) -> DataFrame:
    """Rows by outcome."""
    return d.groupBy("clean_action").agg(F.count("*").alias("n"))
