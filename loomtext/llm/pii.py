"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over a text and finds anchors: at-signs (also spelled), digits, plus signs, schemes, and cues such as
``IBAN`` or ``token``. At each anchor a local parser expands to the left and right as far as its kind allows, and checks what it holds: domains have
two labels, addresses have parts up to 255, cards pass Luhn, IBANs the remainder of 97. Every parser reads a stretch that no other anchor of its kind
reads again, so a text takes time in proportion to its length, however long its runs of letters or digits are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .arrowtext import kept, steps, text_column, tidy

#: The base kinds in the order of their spans, and the kinds that schemes, spelled at-signs and cues add.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "spelled_email", "url", "account")
SPANS = ArrayType(StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType()))

SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "ws://", "wss://")
SPELLED = ("[at]", "(at)", "{at}", "＠")
CUES = ("account", "acct", "iban", "passport", "ssn", "token", "secret", "password", "passwd", "api key", "api_key", "apikey", "customer id", "user id", "licence no", "license no")

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
QUADS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
NUMBERS = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]++")
SPELLED_DOMAIN = re.compile(r" ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\{dot\}|\.) ?[A-Za-z0-9-]{1,63})+", re.I)
URL = re.compile(r"[^\s<>\"'`\x00-\x20]++")
HOST = re.compile(r"(?:[^/@\s]*@)?((?:[A-Za-z0-9-]+\.)+[A-Za-z0-9-]+|localhost|\[[0-9A-Fa-f:.]+\])(?::[0-9]{1,5})?(?=[/?#]|$)")
BETWEEN = re.compile(r"(?: ?(?:no|nr|number|id|key|code)\b\.?)?[ \t]{0,3}(?:[:=#][ \t]{0,3})?[\"']?", re.I)
IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]{5,255}+(?![A-Za-z0-9_-])")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")


def automaton() -> ahocorasick.Automaton:
    """All anchors, each with its kind and length; words in lower case, capitals and with a first capital."""
    a = ahocorasick.Automaton()
    a.add_word("@", ("@", 1))
    a.add_word("+", ("+", 1))
    for d in "0123456789":
        a.add_word(d, ("0", 1))
    for what, anchors in (("s", SPELLED), ("u", SCHEMES), ("c", CUES)):
        for w in anchors:
            for form in {w, w.upper(), w.capitalize()}:
                a.add_word(form, (what, len(form)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of those before it."""
    low = sum(map(int, digits[-1::-2]))
    return (low + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def iban(code: str) -> bool:
    """Whether a compact IBAN has 15 to 34 characters and leaves 1 of 97."""
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def run_before(text: str, end: int, least: int, chars: str) -> int:
    """Start of the run of ``chars`` that ends before ``end``, not before ``least``."""
    width = 64
    while True:
        a = max(least, end - width)
        n = len(text[a:end].rstrip(chars))
        if n or a == least:
            return a + n
        width *= 8


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


class Finder:
    """Spans (kind's place in ``KINDS``, start, end) of a text, in code points, the end exclusive; sorted, and none overlaps another of its kind."""

    def __init__(self) -> None:
        self.anchors = automaton()

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = []
        done = [0] * len(KINDS)  # up to where each kind's stretches have been read
        for last, (what, n) in self.anchors.iter(text):
            at = last - n + 1
            if what == "0":
                if at >= done[2]:
                    self._card(text, at, out, done)
                if at >= done[1]:
                    self._addresses(text, at, out, done)
            elif what == "@":
                self._email(text, at, out, done)
            elif what == "+":
                self._phone(text, at, out)
            elif what == "s":
                self._spelled(text, at, last + 1, out, done)
            elif what == "u":
                self._url(text, at, last + 1, out, done)
            else:
                self._account(text, at, last + 1, out, done)
        out.sort()
        return out

    def _email(self, text: str, at: int, out: list, done: list) -> None:
        start = run_before(text, at, done[0], LOCAL)
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            done[0] = m.end()

    def _addresses(self, text: str, at: int, out: list, done: list) -> None:
        m = QUADS.match(text, at)
        done[1] = m.end()
        parts = m.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            own = parts[i : i + 4]
            end = at + sum(map(len, own)) + 3
            if octets(own):
                out.append((1, at, end))
            at = end + 1

    def _card(self, text: str, at: int, out: list, done: list) -> None:
        end = done[2] = NUMBERS.match(text, at).end()
        if 16 <= end - at <= 37:
            digits = text[at:end].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, at, end))

    def _phone(self, text: str, at: int, out: list) -> None:
        if m := PHONE.match(text, at):
            held = m.group().rstrip(" ().-")
            if len(held) >= 4 and 8 <= sum(map(held.count, "0123456789")) <= 15:
                out.append((3, at, at + len(held)))

    def _spelled(self, text: str, at: int, after: int, out: list, done: list) -> None:
        end = at - 1 if at and text[at - 1] == " " else at
        start = run_before(text, end, done[4], LOCAL)
        if start < end and (m := SPELLED_DOMAIN.match(text, after)):
            out.append((4, start, m.end()))
            done[4] = m.end()

    def _url(self, text: str, at: int, after: int, out: list, done: list) -> None:
        if at < done[5]:
            return
        if m := URL.match(text, after):
            done[5] = m.end()
            rest = m.group().rstrip(".,;:!?)]}*")
            if HOST.match(rest):
                out.append((5, at, after + len(rest)))

    def _account(self, text: str, at: int, after: int, out: list, done: list) -> None:
        if at < done[6] or (at and text[at - 1].isalnum()) or text[after : after + 1].isalnum():
            return
        start = BETWEEN.match(text, after).end()
        if text[at:after].lower() == "iban":
            m = IBAN.match(text, start)
            good = m and iban(m.group().replace(" ", ""))
        else:
            m = IDENTIFIER.match(text, start)
            good = m and sum(map(m.group().count, "0123456789")) >= 4
        if good:
            out.append((6, start, m.end()))
            done[6] = m.end()


def find_personal_data(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, spans_col: str = "spans") -> DataFrame:
    """Rows of ``docs`` with their columns (or those of ``keep``) and ``spans_col``: structs of kind, start and end (code points, end exclusive), ordered by kind as in ``KINDS``, then start.

    Base kinds are leftmost and don't overlap within a kind: ``email``, ``ip`` (parts up to 255), ``card`` (16 to 19 digits with single blanks or hyphens between, Luhn) and ``phone``
    (a plus, 8 to 15 digits); a stretch that fails its check is left out and not tried again from within. Added: ``spelled_email`` (``[at]`` and the like), ``url`` (a scheme and a
    host) and ``account`` (an identifier of 6 to 256 characters with four digits or more, or a valid IBAN, after a cue). Kinds may overlap one another. A null or empty text has no spans; texts are read
    whole, in time proportional to their length; equal rows give equal rows; an empty table gives an empty result. A column named like ``spans_col`` is replaced.
    """
    docs = docs.drop(spans_col)
    kept_cols = docs.columns if keep is None else keep
    places = [docs.columns.index(c) for c in kept_cols]
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = kept("personal data", None, Finder)
        for batch in batches:
            texts = text_column(batch, text_col)
            for a, b in steps(texts):
                found = [[{"kind": KINDS[k], "start": s, "end": e} for k, s, e in finder.spans(t)] for t in texts.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(a, b - a) for k in places], pa.array(found, kind_type)], names=[*kept_cols, spans_col])

    schema = StructType([docs.schema[c] for c in kept_cols]).add(spans_col, SPANS)
    return docs.mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span as ``<kind>``; overlapping spans are one, named by the first, the longest of equal starts."""
    out, at = [], 0
    merged: list[list[int]] = []
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([k, s, e])
    for k, s, e in merged:
        out += [text[at:s], f"<{KINDS[k]}>"]
        at = e
    return "".join(out) + text[at:]


def mask_personal_data(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, columns in their order, with every span of personal data replaced by its kind in brackets; null texts stay null."""
    place = docs.columns.index(text_col)
    schema = StructType([StructField(f.name, StringType()) if i == place else f for i, f in enumerate(docs.schema)])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = kept("personal data", None, Finder)
        for batch in batches:
            texts = text_column(batch, text_col)
            null = batch.column(place).is_null().to_pylist()
            for a, b in steps(texts):
                new = [None if n else masked(t, finder.spans(t)) for t, n in zip(texts.slice(a, b - a).to_pylist(), null[a:b], strict=True)]
                columns = [pa.array(new, pa.string()) if i == place else c.slice(a, b - a) for i, c in enumerate(batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, schema)


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 of the base spans' digest, spans: the digest of all.

    Odd rows are those of ``find_personal_data``; a row without id keeps a null id.
    """
    found = find_personal_data(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), keep=["doc_id"], text_col="text")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))
