"""Column functions over text: words, clean-up, classification, scores. All of them stay in the JVM but ``normalise``'s
compatibility step, which runs only on rows that hold a character it could change."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce
from re import _parser as trees

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed

# Classes ask first what most characters answer: single characters below 256 are one look-up, each range, property and part of a union is a test of its own.

#: White space as Python's str.split sees it.
SPACE = "[\\t\\n\\x0b\\f\\r\\x1c\\x1d\\x1e\\x1f \\x85\\xa0[\\u1680-\\u3000&&[\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]]]+"
#: Control and format characters but newline and tab.
CONTROL = "[[^\\x20-\\x7e\\n\\t]&&[\\p{Cc}\\p{Cf}]]"
#: ASCII and composed Latin letters, which are their own normal form.
PLAIN = "[\\x00-\\x9f[\\u00a1-\\u00a7\\u00a9\\u00ab-\\u00ae\\u00b0\\u00b1\\u00b6\\u00b7\\u00bb\\u00bf-\\u0131\\u0134-\\u013e\\u0141-\\u0148\\u014a-\\u017e]]"


def _java(pattern: str, ignore_case: bool = True, dot_all: bool = False) -> str:
    """A pattern as Python reads it. Unicode classes are costly and only asked for where a pattern has a class of word characters."""
    flags = ("U" if "\\w" in pattern else "") + "i" * ignore_case + "s" * dot_all
    return (f"(?{flags})" if flags else "") + pattern


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _held(tree) -> list[str]:
    """Strings of which every match of a parsed pattern holds one, the longest such list; an empty list if nothing is certain."""
    found, run = [], ""
    for op, arg in [*tree, (None, None)]:
        name = str(op)
        if name == "LITERAL":
            run += chr(arg)
            continue
        if run:
            found.append([run])
            run = ""
        inner = []
        if name == "BRANCH":
            sides = [_held(x) for x in arg[1]]
            inner = [x for side in sides for x in side] if all(sides) else []
        elif name == "SUBPATTERN":
            inner = _held(arg[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] > 0:
            inner = _held(arg[2])
        if inner:
            found.append(inner)
    return max(found, key=lambda x: (min(map(len, x)), -len(x)), default=[])


@lru_cache(maxsize=1024)
def needed(pattern: str, ignore_case: bool) -> tuple[str, ...]:
    """Strings of two characters or more of which every text that the pattern matches holds one, in lower case if case is ignored.

    None for patterns whose case rules go beyond a to z (those with classes of word characters).
    """
    out = [] if ignore_case and "\\w" in pattern else _held(trees.parse(pattern))
    out = [x.lower() for x in out] if ignore_case else out
    return tuple(dict.fromkeys(out)) if out and min(map(len, out)) > 1 else ()


def _may(text: Column, low: Column, pattern: str, ignore_case: bool) -> Column | None:
    """Whether the text holds what the pattern needs: plain searches, many times cheaper than the pattern. ``low``: the text in lower case."""
    keys = needed(pattern, ignore_case)
    return reduce(lambda a, b: a | b, [(low if ignore_case else text).contains(k) for k in keys]) if keys else None


def found(text: Column, low: Column, pattern: str, ignore_case: bool = True, dot_all: bool = False) -> Column:
    """``matches``, with the pattern run only where it can match; false for null."""
    may, hit = _may(text, low, pattern, ignore_case), F.coalesce(matches(text, pattern, ignore_case, dot_all), F.lit(False))
    return hit if may is None else F.when(may, hit).otherwise(F.lit(False))


def counted(text: Column, low: Column, pattern: str, ignore_case: bool = True) -> Column:
    """``match_count``, with the pattern run only where it can match; 0 for null."""
    may, n = _may(text, low, pattern, ignore_case), F.coalesce(match_count(text, pattern, ignore_case), F.lit(0))
    return n if may is None else F.when(may, n).otherwise(F.lit(0))


def matches(text: Column, pattern: str, ignore_case: bool = True, dot_all: bool = False) -> Column:
    return text.rlike(_java(pattern, ignore_case, dot_all))


def match_count(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    return F.regexp_count(text, F.lit(_java(pattern, ignore_case)))


def words(text: Column) -> Column:
    """Words between white space, as str.split() gives them."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    """How many; a pattern for the words themselves takes three times as long as the split."""
    return F.size(words(text))


def once(d: DataFrame, **columns: Column) -> DataFrame:
    """``d`` with columns computed once a row, whatever reads them later: an optimiser copies no expression through a generator."""
    made = F.explode_outer(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("_made")
    return d.select(*[c for c in d.columns if c not in columns], made).select("*", "_made.*").drop("_made")


def _length_of(text: Column, runs: str) -> Column:
    """Characters in the runs of a class: what is missing once they are taken out."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, runs, ""))


def letters(text: Column) -> Column:
    return _length_of(text, "\\p{L}+")


def digits(text: Column) -> Column:
    """Digits of str.isdigit: decimal digits, superscripts and enclosed digits."""
    return _length_of(text, "[\\p{Nd}\\u00b2\\u00b3\\u00b9\\u2070\\u2074-\\u2079\\u2080-\\u2089\\u2460-\\u2468\\u2474-\\u247c\\u2488-\\u2490\\u24ea]+")


def collapse(text: Column) -> Column:
    return F.array_join(words(text), " ")


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, f"^{SPACE}|{SPACE}$", "")


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", " ")


def _compatible(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


_compatible.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}


def compatible(text: Column) -> Column:
    """NFKC. Text of ASCII and composed Latin letters is its own normal form and never leaves the JVM."""
    plain = text.rlike(f"^{PLAIN}*$")
    return F.when(text.isNull() | plain, text).otherwise(F.pandas_udf(_compatible, "string")(F.when(~plain, text)))


def normalise(text: Column, nfkc: bool = True) -> Column:
    """NFKC, no control or format characters but newline and tab, runs of blanks as one, of newlines as two at most, stripped."""
    t = compatible(text) if nfkc else text
    t = F.regexp_replace(t, CONTROL, "")
    t = F.regexp_replace(F.regexp_replace(t, "[ \\t]+", " "), "\\n{3,}", "\n\n")
    return strip(t)


def _first(rules: list[tuple[Column, object]], other: object) -> Column:
    return reduce(lambda rest, rule: F.when(rule[0], F.lit(rule[1])).otherwise(rest), reversed(rules), F.lit(other))


def classify_url(url: Column) -> Column:
    return _first([(matches(url, p, False), t) for p, t in fixed.URL_TYPES], "unknown")


def classify_text(text: Column) -> Column:
    return let(F.struct(F.lower(text).alias("low"), F.greatest(n_words(text), F.lit(1)).alias("n")), lambda x: _first([(counted(text, x["low"], p, i) / x["n"] >= least, t) for p, i, t, least in fixed.TEXT_TYPES], "unknown"))


def url_path(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))


def code_language(url: Column) -> Column:
    path = F.lower(url_path(url))
    return _first([(path.endswith(e), name) for e, name in fixed.CODE_LANGUAGES.items()], "")


def reclassify(content_type: Column, text: Column) -> Column:
    count = lambda low, keys: reduce(lambda a, b: a + b, [low.contains(k).cast("int") for k in keys])
    made = let(F.lower(text), lambda low: _first([(count(low, k) >= 2, t) for k, t in fixed.TYPE_KEYWORDS], "unknown"))
    return F.when(content_type.isin("unknown", "") | content_type.isNull(), made).otherwise(content_type)


def _sum(parts: list[Column], start: Column) -> Column:
    return reduce(lambda a, b: a + b, parts, start)


def _hits(text: Column, patterns: list[tuple[str, bool]]) -> Column:
    return let(F.lower(text), lambda low: _sum([found(text, low, p, i).cast("int") for p, i in patterns], F.lit(0)))


def _clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def score_document(url: Column, text: Column) -> Column:
    """Signal of a page, 0 to 1: its URL's type, rewarded and penalised patterns, length, share of letters, words and digits."""
    base = _first([(classify_url(url) == t, s) for t, s in fixed.SIGNAL_BASE.items()], 0.4)
    chars = F.greatest(F.char_length(text), F.lit(1))
    hits = _hits(text, fixed.SIGNAL_REWARDS) * 0.03 - _hits(text, fixed.SIGNAL_PENALTIES) * 0.08
    less = F.when(letters(text) / chars < 0.5, 0.1).otherwise(0.0), F.when(digits(text) / chars > 0.3, 0.1).otherwise(0.0)

    def by_words(w: Column) -> Column:
        n = F.size(w)
        s = base + hits + F.when(n > 500, 0.05).otherwise(0.0) + F.when(n > 2000, 0.05).otherwise(0.0) - less[0]
        s = s - F.when(F.size(F.array_distinct(F.transform(w, F.lower))) / n < 0.2, 0.15).otherwise(0.0) - less[1]
        return F.when(text.isNull() | (n < 30), F.lit(0.1)).otherwise(_clamp(s, 0.0, 1.0))

    return let(words(text), by_words)


def quality_score(text: Column) -> Column:
    """Quality of a text, 0.05 to 1; 0.1 below the least number of words."""
    b = fixed.QUALITY_BOUNDS
    text = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.char_length(text), F.lit(1))
    less = F.when(digits(text) / chars > b["digits"], 0.1).otherwise(0.0), F.when(letters(text) / chars < b["letters"], 0.15).otherwise(0.0)
    hits = 0.05 * _hits(text, [(p, True) for p in fixed.QUALITY_REWARDS]), 0.08 * _hits(text, [(p, True) for p in fixed.QUALITY_PENALTIES])

    def long_enough(n: Column) -> Column:
        return let(F.char_length(F.regexp_replace(text, SPACE, "")) / n, lambda x: x.between(*b["word_length"]))

    def by_words(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1))
        s = F.lit(0.5) - F.when(n > b["words"][1], 0.1).otherwise(0.0)
        s = s - F.when(long_enough(n), 0.0).otherwise(0.15)
        s = s - F.when(F.size(F.array_distinct(w)) / n < b["unique"], 0.2).otherwise(0.0) - less[0] - less[1] + hits[0] - hits[1]
        return F.when(n < b["words"][0], F.lit(0.1)).otherwise(_clamp(s, 0.05, 1.0))

    # lower case neither makes nor ends a word, and a word's lower case is the same in its text
    return let(words(F.lower(text)), by_words)


def domain_rule(domain: Column, what: int) -> Column:
    """Weight (1) or category (2) of the first domain rule that matches as a glob or as a part."""
    rules = []
    for rule in fixed.DOMAIN_WEIGHTS:
        p = rule[0]
        hit = F.lit(True) if p == "*" else domain.contains(p) | (domain.endswith(p[1:]) if p.startswith("*") else F.lit(False))
        rules.append((hit, rule[what]))
    return _first(rules, 0.8 if what == 1 else "general_web")


def type_weight(content_type: Column) -> Column:
    return _first([(content_type == t, w) for t, w in fixed.TYPE_WEIGHTS.items()], fixed.TYPE_WEIGHTS["unknown"])


def code_weight(lang: Column) -> Column:
    return _first([(lang == t, w) for t, w in fixed.CODE_WEIGHTS.items()], fixed.CODE_WEIGHTS["unknown"])


def final_weight(domain: Column, content_type: Column, lang: Column, quality: Column) -> Column:
    t = type_weight(content_type)
    return domain_rule(domain, 1) * F.when((content_type == "source_code") & (lang != ""), t * code_weight(lang)).otherwise(t) * quality


def exclusion_tags(text: Column, tags: list[str] | None = None) -> Column:
    """Sorted tags of which a pattern occurs in the text."""
    every = [(t, p) for t in (tags if tags is not None else fixed.EXCLUSIONS) for p in fixed.EXCLUSIONS.get(t, [])]
    if not every:
        return F.array().cast("array<string>")
    return let(F.lower(text), lambda low: F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(found(text, low, p, True, True), F.lit(t)) for t, p in every])))))


def split_bucket(doc_id: Column, seed: int) -> Column:
    """First four bytes of sha256(seed:id), big-endian, modulo a million."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("long") % 1_000_000


def host(url: Column) -> Column:
    """Lower-case host with its port."""
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")))


def page_title(html: Column) -> Column:
    return strip(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1))


def field_text(fields: list[str]) -> Column:
    """Named fields as 'name: value' paragraphs; empty and missing ones are left out."""
    parts = [F.when(strip(F.col(f).cast("string")) != "", F.concat(F.lit(f"{f}: "), strip(F.col(f).cast("string")))) for f in fields]
    return F.array_join(F.array_compact(F.array(*parts)), "\n\n")
