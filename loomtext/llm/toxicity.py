"""Toxicity by noisy-channel deobfuscation.

1. A character trigram model is counted over all documents.
2. Words that may be disguised (leetspeak, separators inside a word, letters spaced out, letters repeated) become lattices of
   what each character may stand for; Viterbi search finds the most probable reading under channel costs and the language model.
3. Of restored words and their beginnings, those that mark either label best in a bounded sample of labelled rows form a lexicon.
4. A logistic model over the restored lexicon words, fitted on the same sample, scores every whole text.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .arrowtext import coded, kept, steps, text_column, tidy, words
from .common import durable, held_out, small_batches, training_row

#: Letters that a character may stand for, with the channel's cost (a negative log probability).
LEET = {
    "0": [("o", 1.0)], "1": [("i", 1.0), ("l", 1.2)], "2": [("z", 2.0)], "3": [("e", 1.0)], "4": [("a", 1.0)], "5": [("s", 1.0)], "6": [("g", 1.5)],
    "7": [("t", 1.0)], "8": [("b", 1.0)], "9": [("g", 1.2)], "@": [("a", 0.7)], "$": [("s", 0.7)], "!": [("i", 1.0)], "|": [("l", 1.0), ("i", 1.0)],
    "+": [("t", 1.2)], "(": [("c", 1.5)], "€": [("e", 1.0)], "£": [("l", 1.5)], "*": [(v, 2.0) for v in "aeiou"], "#": [(v, 2.5) for v in "aeiouh"],
}
#: Costs of leaving out a separator, a mask that may stand for any vowel, another sign that may stand for a letter, a digit, a third or
#: later equal letter, a second equal letter. A reading gets cheaper with every sign left out, so what may be a letter costs more.
DROP_MARK, DROP_MASK, DROP_SIGN, DROP_DIGIT, DROP_THIRD, DROP_SECOND = 0.7, 2.5, 9.0, 9.0, 0.2, 3.0
#: Cost of a word's end among letters that are spaced out, and of a separator that is one.
BREAK, END_MARK = 1.0, 0.7
#: What a word of digits alone costs when read as a number, for the word and for each digit; words of letters' stand-ins cost what their reading costs.
NUMBER, NUMERAL = 3.0, math.log(10)
#: Bytes of text that are counted, and that are read, at a time: a worker holds some thirty times as many.
COUNT_BYTES, READ_BYTES = 1 << 19, 1 << 20
#: Words a worker remembers.
CACHE_WORDS = 150_000
#: Lengths of the beginnings of words that are features, and the share of a text's words that makes a feature frequent.
STEMS, SHARE = (4, 5, 6), 0.01
A = 28  # 0: word edge, 1 to 26: a to z, 27: any other letter


def _symbols() -> np.ndarray:
    t = np.zeros(0x3000, np.uint8)
    for c in range(0x3000):
        x = chr(c)
        if x.isalpha():
            base = unicodedata.normalize("NFKD", x.lower())[:1]
            t[c] = ord(base) - 96 if "a" <= base <= "z" else 27
    return t


SYMBOLS = _symbols()


def symbols_of(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(cp < 0x3000, SYMBOLS[np.minimum(cp, 0x2FFF)], 27)


def character_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts [a, b, c] over all documents; 0 stands for everything that is no letter, runs of it count as one edge."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("toxicity counts")
        acc = np.zeros(A**3, np.int64)
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in steps(texts, COUNT_BYTES):
                s = symbols_of(" ".join(["", *texts.slice(a, b - a).to_pylist(), ""])).astype(np.int32)
                s = s[(s > 0) | np.append(True, s[:-1] > 0)]  # one edge between words
                s = np.repeat(s, np.where(s == 0, 2, 1))  # that ends a word and begins the next
                acc += np.bincount((s[:-2] * A + s[1:-1]) * A + s[2:], minlength=A**3)
        k = np.flatnonzero(acc)
        yield pa.RecordBatch.from_pydict({"k": k.astype(np.int64), "n": acc[k]})

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession):
        rows = counted.collect()  # A³ counts at most
    acc = np.zeros(A**3, np.int64)
    for r in rows:
        acc[r.k] = r.n
    return acc.reshape(A, A, A)


def character_costs(counts: np.ndarray) -> np.ndarray:
    """-log p(c | a, b), the trigram estimate resting on the bigram's and that on the letter's."""
    c = counts.astype(np.float64)
    one = (c.sum((0, 1)) + 1) / (c.sum() + A)
    two = (c.sum(0) + 4 * one) / (c.sum((0, 2))[:, None] + 4)
    three = (c + 4 * two[None]) / (c.sum(2)[:, :, None] + 4)
    return -np.log(three)


class Restorer:
    """Most probable readings of disguised words."""

    def __init__(self, costs: np.ndarray):
        self.cost = costs.tolist()
        self.seen: dict[str, str] = {}

    def lattice(self, word: str, ends: bool = False) -> list[list[tuple[int, float, str]]]:
        """What each character may stand for: (symbol, cost, letter), with symbol -1 for nothing and, with ``ends``, 0 for a separator that ends a word.
        Letters other than a to z stay themselves."""
        out, run, before = [], 0, ""
        for ch in word:
            run = run + 1 if ch == before else 1
            before = ch
            if ch.isalpha():
                base = unicodedata.normalize("NFKD", ch)[:1]
                own = [(ord(base) - 96, 0.0, base) if "a" <= base <= "z" else (27, 0.0, ch)]
                if run > 2:
                    own.append((-1, DROP_THIRD, ""))
                elif run == 2:
                    own.append((-1, DROP_SECOND, ""))
            else:
                own = [(ord(x) - 96, c, x) for x, c in LEET.get(ch, ())]
                if ends and not own:
                    own.append((0, END_MARK, " "))
                own.append((-1, DROP_DIGIT if ch.isdigit() else DROP_MASK if ch in "*#" else DROP_SIGN if ch in LEET else DROP_MARK, ""))
            out.append(own)
        return out

    def decode(self, word: str, breaks: float | None = None) -> str:
        """The reading that ``read`` finds."""
        return self.read(word, breaks)[1]

    def read(self, word: str, breaks: float | None = None, ends: bool = False) -> tuple[float, str]:
        """Cost and letters of the best reading: Viterbi search over states of the last two symbols. With a cost for ``breaks``, words may end between any two letters,
        with ``ends`` at separators."""
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        cost = self.cost
        for options in self.lattice(word, ends):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (s, path) in best.items():
                row = cost[a][b]
                for symbol, c, letter in options:
                    if symbol < 0 or (symbol == 0 and b == 0):
                        key, total, way = (a, b), s + c, path
                    elif symbol == 0:
                        key, total, way = (0, 0), s + c + row[0] + cost[b][0][0], (letter, path)
                    else:
                        key, total, way = (b, symbol), s + c + row[symbol], (letter, path)
                    if key not in after or total < after[key][0]:
                        after[key] = (total, way)
                    if breaks is not None and symbol > 0 and b:
                        key, total = (0, symbol), s + c + breaks + row[0] + cost[b][0][0] + cost[0][0][symbol]
                        if key not in after or total < after[key][0]:
                            after[key] = (total, (letter, (" ", path)))
            best = after
        total, path = min(((s + cost[a][b][0] if b else s, p) for (a, b), (s, p) in best.items()), key=lambda x: x[0])
        out = []
        while path:
            out.append(path[0])
            path = path[1]
        return total, "".join(reversed(out))

    def restore(self, word: str) -> tuple[str, ...]:
        """The word's different keys: its letters, restored if it may be disguised, without accents; '' for no word. A word with separators has several, at any length."""
        if (known := self.seen.get(word)) is not None:
            return known
        out = tuple(dict.fromkeys(_key(x) for x in self._restore(word)))
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
        self.seen[word] = out
        return out

    def restore_spaced(self, letters: str) -> list[str]:
        """Keys of the words that single characters in a row spell."""
        return [_key(w) for w in self.decode(letters, BREAK).split()]

    def _restore(self, word: str) -> list[str]:
        if word.isalpha() and not TRIPLE.search(word):
            return [word]
        w = EDGE.sub("", word)
        if w.isalpha() and not TRIPLE.search(w):
            return [w]
        parts = [x for x in PARTS.split(w) if x]
        if len(parts) > 1:
            out = [x for part in parts for x in self.restore(part)]
            if any(ch.isalpha() for ch in w):  # a separator may also be nothing: between two parts, or wherever that makes the token more probable
                out += [x for a, b in zip(parts, parts[1:], strict=False) for x in self.restore(a + b)]
                out += self.read(LONG_RUN.sub(r"\1\1", w), ends=True)[1].split()
            return out
        if not any(ch.isalpha() for ch in w):
            w = ENDS.sub("", word)  # signs at the edges may be letters here
            if len(w) < 3 or len(set(w)) < 2 or not all(ch in LEET for ch in w):
                return [""]
            total, letters = self.read(LONG_RUN.sub(r"\1\1", w))
            number = w.lstrip("$€£").isdigit()  # an amount or a plain number
            return [letters if not number or total < NUMBER + NUMERAL * len(w) else ""]
        return [self.decode(LONG_RUN.sub(r"\1\1", w))]


#: Decoration round a word: quotes and closing stops, and symbols doubled at its end.
EDGE = re.compile(r"""^["'(\[{<.,;:?¿¡»«“”-]+|(?:["')\]}>.,;:?!»«“”-]|([#$%&*~=_+^|])\1+)+$""")
TRIPLE = re.compile(r"(.)\1\1")
ENDS = re.compile(r"""^["'\[{<.,;:?¿¡»«“”-]+|["')\]}>.,;:?»«“”-]+$""")
#: What parts words: separators, but not the signs that may stand for letters.
PARTS = re.compile(rf"(?:(?![{re.escape(''.join(LEET))}])[\W_])+")
LONG_RUN = re.compile(r"(.)\1{2,}")
REPEAT = re.compile(r"(.)\1+")
THREE = "|".join(chr(97 + k) * 3 for k in range(26))


def _key(word: str) -> str:
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
    return word


def restored_words(texts: pa.Array, restorer: Restorer) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct keys, and (text, key) of every word as two arrays. Single characters in a row, three or more, are read as
    words besides. Words end at Unicode white space."""
    flat, off = words(pc.utf8_lower(texts), unicode=True)
    distinct, code = coded(flat)
    owner = np.repeat(np.arange(len(texts)), np.diff(off))
    keys: dict[str, int] = {}
    # words of a to z, closing stops aside, need no restoring and are their own keys if no letter comes three times in a row
    core = pc.utf8_rtrim(pa.array(distinct, pa.large_string()), ".,;:?!")
    has = lambda pattern: np.asarray(pc.match_substring_regex(core, pattern).to_numpy(zero_copy_only=False), bool)
    plain = (has("^[a-z]+$") & ~has(THREE)).tolist()
    found = [[keys.setdefault(c, len(keys))] if own else [keys.setdefault(x, len(keys)) for x in restorer.restore(w)] for w, c, own in zip(distinct, core.to_pylist(), plain, strict=True)]
    n = np.fromiter(map(len, found), np.int64, len(found))
    start, of = np.cumsum(n) - n, np.fromiter(chain.from_iterable(found), np.int64, int(n.sum()))
    each = n[code]  # a word's keys one after the other
    pair_text, pair_key = [np.repeat(owner, each)], [of[np.repeat(start[code] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))]]
    one = np.asarray(pc.equal(pc.utf8_length(flat), 1).to_numpy(zero_copy_only=False), bool) if len(flat) else np.zeros(0, bool)
    if one.any():
        edge = np.flatnonzero(np.diff(np.concatenate([[0], one.astype(np.int8), [0]])))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            cuts = [a, *[c for c in off[np.searchsorted(off, a, "right") : np.searchsorted(off, b, "left")].tolist() if a < c < b], b]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if y - x >= 3:
                    k = [keys.setdefault(w, len(keys)) for w in restorer.restore_spaced("".join(distinct[i] for i in code[x:y].tolist()))]
                    pair_text.append(np.repeat(owner[x], len(k)))
                    pair_key.append(np.array(k, np.int64))
    return list(keys), np.concatenate(pair_text), np.concatenate(pair_key)


def word_features(key: str) -> list[str]:
    """A restored word's features: itself, its beginnings, so that one stem's forms count together, and after a = its letters with each run of one as one."""
    return [key, *[f"^{key[:n]}" for n in STEMS if len(key) >= n], "=" + REPEAT.sub(r"\1", key)] if key else []


def text_features(texts: pa.Array, restorer: Restorer, known: dict[str, int] | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Feature names and (text, feature) pairs, each once: features that occur, and with a % those that make up ``SHARE`` of a text's words.

    With ``known``, only those features are made, under their numbers there, and the list of names is empty.
    """
    keys, t, k = restored_words(texts, restorer)
    n_words = np.bincount(t, minlength=len(texts))
    names: dict[str, int] = {}
    columns: list[tuple[np.ndarray, np.ndarray]] = []
    if known is None:
        base = [word_features(x) for x in keys]
    else:
        wanted = {f.removeprefix("%") for f in known}
        base = [[f for f in word_features(x) if f in wanted] for x in keys]
    for x in range(max(map(len, base), default=0)):
        of = np.fromiter((names.setdefault(f[x], len(names)) if len(f) > x else -1 for f in base), np.int64, len(base))[k]
        columns.append((t[of >= 0], of[of >= 0]))
    if not columns:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = max(1, len(names))
    pair, count = np.unique(np.concatenate([a * width + b for a, b in columns]), return_counts=True)
    own_t, own_f = pair // width, pair % width
    much = count >= SHARE * n_words[own_t]
    every = list(names)
    if known is None:
        return every + ["%" + f for f in every], np.concatenate([own_t, own_t[much]]), np.concatenate([own_f, own_f[much] + width])
    plain, share = (np.fromiter((known.get(mark + f, -1) for f in every), np.int64, len(every)) for mark in ("", "%"))
    out_t, out_f = np.concatenate([own_t, own_t[much]]), np.concatenate([plain[own_f], share[own_f[much]]])
    return [], out_t[out_f >= 0], out_f[out_f >= 0]


def _restorer(costs: np.ndarray) -> Restorer:
    """The worker's restorer for these costs."""
    return kept("toxicity", (zlib.crc32(costs.tobytes()), float(costs.sum())), lambda: Restorer(costs))


def word_counts(docs: DataFrame, costs: np.ndarray) -> DataFrame:
    """(word, n0, n1): in how many rows of each label y a feature of restored words occurs. ``docs``: text, y."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(costs)
        counts = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            every = list({*counts[0], *counts[1]})
            made = pa.RecordBatch.from_pydict({"word": pa.array(every, pa.string()), "n0": pa.array([counts[0][w] for w in every], pa.int64()), "n1": pa.array([counts[1][w] for w in every], pa.int64())})
            for c in counts:
                c.clear()
            return made

        for batch in batches:
            texts, y = text_column(batch, "text"), batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in steps(texts, READ_BYTES):
                keys, t, k = text_features(texts.slice(a, b - a), restorer)
                for c in (0, 1):
                    n = np.bincount(k[y[a:b][t] == c], minlength=len(keys))
                    for i in np.flatnonzero(n).tolist():
                        counts[c][keys[i]] += int(n[i])
                if len(counts[0]) > CACHE_WORDS:
                    yield out()
        yield out()

    rows = docs.select("text", "y").mapInArrow(run, "word string, n0 long, n1 long")
    return rows.where("word <> ''").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _different(counts: DataFrame) -> DataFrame:
    """``counts`` without words that mark the same rows as their form with each run of a letter as one: of a word without runs that form stays, of one with runs the word."""
    base = F.regexp_replace("word", "^(%?)=", "$1")
    rows = counts.withColumns({"form": F.regexp_replace(base, r"([^%^])\1+", "$1"), "wide": F.col("word").rlike("^%?="), "runs": base.rlike(r"([^%^])\1")})
    both = rows.groupBy("form", "n0", "n1").agg(F.bool_or("wide").alias("has_wide"), F.bool_or(~F.col("wide") & ~F.col("runs")).alias("has_plain"), F.bool_or(~F.col("wide") & F.col("runs")).alias("has_runs"))
    rows = rows.join(both, ["form", "n0", "n1"])
    return rows.where(F.when(F.col("wide"), F.col("has_plain") | ~F.col("has_runs")).otherwise(F.col("runs") | ~F.col("has_wide"))).select("word", "n0", "n1")


@dataclass
class ToxicModel:
    costs: np.ndarray
    lexicon: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def features(self, texts: pa.Array, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
        """(text, lexicon word) pairs, each once."""
        return text_features(texts, restorer, {w: i for i, w in enumerate(self.lexicon)})[1:]

    def score(self, texts: pa.Array, restorer: Restorer) -> np.ndarray:
        t, f = self.features(texts, restorer)
        z = self.bias + np.bincount(t, self.weights[f], minlength=len(texts))[: len(texts)]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logistic(t: np.ndarray, f: np.ndarray, y: np.ndarray, d: int, l2: float = 0.2, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Newton's method on a dense matrix of the bounded sample."""
    x = np.zeros((len(y), d + 1), np.float32)
    x[t, f] = 1
    x[:, d] = 1
    w = np.zeros(d + 1)
    w[d] = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    reg = np.full(d + 1, l2)
    reg[d] = 1e-3
    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.logaddexp(0, z).sum() - z @ y + 0.5 * (reg * v * v).sum())

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + reg * w
        h = (x * (p * (1 - p))[:, None].astype(np.float32)).T @ x + np.diag(reg)
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-4 and (then := loss(w - size * step)) > now:  # Newton's step may be too long
            size /= 2
        if size <= 1e-4 or now - then < 1e-6 * now:
            break
        w, now = w - size * step, then
    return w[:d], float(w[d])


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", lexicon_size: int = 400, sample_rows: int = 8000, least_rows: int = 3, id_col: str = "doc_id", text_col: str = "text") -> ToxicModel:
    """The character model from all documents; lexicon and weights from a bounded sample of labelled training rows.

    The sample has ``sample_rows`` labelled ids of each label at most, those of the smallest xxhash64(doc_id), whole texts; an id that several
    rows share teaches by the text of the smallest xxhash64, and equal labels of an id count once. The bias is then set right for the labels'
    shares among all labelled training ids.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = ToxicModel(character_costs(character_counts(named)))
    y = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y")).where(training_row("doc_id")).distinct()
    chosen = durable(reduce(DataFrame.unionAll, [y.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows) for c in (0, 1)]))
    drawn_texts = named.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = durable(drawn_texts.join(F.broadcast(chosen), "doc_id").select("text", "y"))  # 2 * sample_rows ids are broadcast
    counts = word_counts(rows, model.costs).where(F.col("n0") + F.col("n1") >= least_rows)
    total = {r.y: r["count"] for r in y.groupBy("y").count().collect()}
    drawn = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n0, n1 = drawn.get(0, 0) + 1, drawn.get(1, 0) + 1
    rest = (F.col("n0") + F.col("n1")) / F.lit(n0 + n1)
    z = (F.col("n1") / n1 - F.col("n0") / n0) / F.sqrt(rest * (1 - rest) * (1 / n0 + 1 / n1) + 1e-12)
    marking = _different(counts).select("word", F.abs(z).alias("z")).where("z > 4").orderBy(F.desc("z"), "word").limit(lexicon_size)
    with small_batches(docs.sparkSession):
        model.lexicon = [r.word for r in marking.collect()]

    @tidy
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(model.costs)
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in steps(texts, READ_BYTES):
                t, f = model.features(texts.slice(a, b - a), restorer)
                lists = np.split(f[np.argsort(t, kind="stable")], np.cumsum(np.bincount(t, minlength=b - a))[:-1])
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))], names=["y", "f"])

    with small_batches(docs.sparkSession):
        sample = rows.mapInArrow(features, "y int, f array<int>").collect()  # sample_rows of each label
    got = np.array([r.y for r in sample], np.float64)
    t = np.repeat(np.arange(len(sample)), [len(r.f) for r in sample]) if sample else np.zeros(0, np.int64)
    f = np.array([i for r in sample for i in r.f], np.int64)
    model.weights = np.zeros(len(model.lexicon))
    if len(sample):
        model.weights, model.bias = _logistic(t, f, got, len(model.lexicon))
        model.bias += math.log((total.get(1, 0) + 1) / (total.get(0, 0) + 1)) - math.log(n1 / n0)
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel, *, threshold: float = 0.5, text_col: str = "text", keep: list[str] | None = None, score_col: str = "toxic_score", toxic_col: str = "toxic") -> DataFrame:
    """Rows of ``docs`` with their columns (or those of ``keep``), a ``score_col`` and ``toxic_col`` (1 if score >= threshold, else 0).

    Texts are read whole. A null or empty text has no words and gets the score of none. Columns of these two names are replaced.
    """
    docs = docs.drop(score_col, toxic_col)
    kept = docs.columns if keep is None else keep
    places = [docs.columns.index(c) for c in kept]
    schema = StructType([docs.schema[c] for c in kept] + [StructField(score_col, DoubleType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(model.costs)
        for batch in batches:
            texts = text_column(batch, text_col)
            for a, b in steps(texts, READ_BYTES):
                score = pa.array(model.score(texts.slice(a, b - a), restorer))
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(a, b - a) for k in places], score], names=[*kept, score_col])

    return docs.mapInArrow(run, schema).withColumn(toxic_col, (F.col(score_col) >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= threshold, so a tie is 1).

    Labels are learned only from rows whose crc32(doc_id as text) mod 5 is not 0; labels other than 0 and 1, and rows without id, teach
    nothing, and labels without a document count in the labels' shares alone. Without labelled rows every score is one half. A null or an empty text, or one without words, has the score of
    no words. Texts and words of any length are read whole, by the same rules. Equal texts get equal scores; rows that repeat an id each get their own; a row without id is scored, with
    held_out false. Other columns, whatever their names, are not read. An empty table gives an empty result.
    """
    model = fit_toxicity(docs, labels, id_col=id_col, text_col=text_col)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = score_toxicity(named, model, threshold=threshold, keep=["doc_id"])
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic").alias("predicted"))
