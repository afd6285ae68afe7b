"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance that is shrunk towards the pooled covariance and its diagonal; a document's score is the
posterior of the two Gaussian log densities, whose Mahalanobis distances come from Cholesky factors computed once.
Statistics are taken of every whole text in one vectorised pass; class sums are taken over all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import coded, group_sums, kept, steps, text_column, tidy, words
from .common import durable, held_out, training_row

STATS = (
    "log_words", "word_length", "word_length_sd", "upper", "digit", "stop", "bang", "bar", "symbol", "mark_run", "line_length", "distinct", "short",
    "capital_words",
)
#: Classes of characters: other, lower-case or uncased letter, upper-case letter, digit, white space, newline, stop, bang, bar, symbol.
OTHER, LOWER, UPPER, DIGIT, SPACE, NEWLINE, STOP, BANG, BAR, SYMBOL = range(10)


def _classes() -> np.ndarray:
    t = np.full(0x3000, OTHER, np.uint8)
    for c in range(0x3000):
        x = chr(c)
        t[c] = UPPER if x.isupper() else LOWER if x.isalpha() else DIGIT if x.isdigit() else NEWLINE if x == "\n" else SPACE if x.isspace() else OTHER
    for chars, k in ((".,;:?-'\"()", STOP), ("!", BANG), ("|", BAR), ("#$%&*+/<=>@\\^_`~{}[]", SYMBOL)):
        t[[ord(x) for x in chars]] = k
    return t


CLASSES = _classes()
#: Parts of one into which statistics are rounded for the class sums.
UNIT = 1 << 16


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text; an empty text has those of no words."""
    n = len(texts)
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    off = np.concatenate([[0], np.cumsum(chars)])
    cp = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    kind = np.where(cp < 0x3000, CLASSES[np.minimum(cp, 0x2FFF)], LOWER).astype(np.uint8)
    count = [group_sums((kind == k).astype(np.int64), off) for k in range(10)]
    again = np.zeros(len(cp), bool)
    if len(cp) > 1:
        again[1:] = (cp[1:] == cp[:-1]) & (kind[1:] >= BANG)
        again[off[:-1][chars > 0]] = False  # a text's first character repeats none
    runs = group_sums(again.astype(np.int64), off)
    flat, at = words(texts)
    size = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.float64)
    m = np.diff(at)
    some, letters, full = np.maximum(m, 1), np.maximum(count[LOWER] + count[UPPER], 1), np.maximum(chars - count[SPACE] - count[NEWLINE], 1)
    mean = group_sums(size, at) / some
    sd = np.sqrt(np.maximum(group_sums(size * size, at) / some - mean * mean, 0))
    distinct, code = coded(flat)
    owner = np.repeat(np.arange(n), m)
    pairs = np.unique(owner * max(1, len(distinct)) + code)
    unique = np.bincount(pairs // max(1, len(distinct)), minlength=n)[:n] if len(pairs) else np.zeros(n)
    first = np.asarray(pc.utf8_is_upper(pc.utf8_slice_codeunits(flat, 0, 1)), bool) if len(flat) else np.zeros(0, bool)
    short = group_sums((size <= 3).astype(np.int64), at)
    rate = lambda x, of: np.log(x / of + 1e-3)
    return np.column_stack([
        np.log1p(m), mean, sd, rate(count[UPPER], letters), rate(count[DIGIT], full), rate(count[STOP], full), rate(count[BANG], full), rate(count[BAR], full),
        rate(count[SYMBOL], full), rate(runs, full), np.log1p(m / (count[NEWLINE] + 1)), unique / some, short / some,
        rate(group_sums(first.astype(np.int64), at), some),
    ])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the transformed statistics of every row."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("quality")
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in steps(texts, 4 << 20):
                x = statistics(texts.slice(a, b - a))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Two Gaussians with cached inverse Cholesky factors."""

    means: np.ndarray
    whiteners: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray

    @classmethod
    def fit(cls, n: np.ndarray, s: np.ndarray, ss: np.ndarray, to_pooled: float, to_diagonal: float) -> Discriminant:
        """From counts, sums and sums of products of the classes; a class without rows takes the pooled moments."""
        d = s.shape[1]
        total = max(n.sum(), 1)
        centre = s.sum(0) / total
        means = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], centre)
        scatter = ss - np.einsum("c,ci,cj->cij", n, means, means)
        pooled = scatter.sum(0) / total + 1e-6 * np.eye(d)
        whiteners, dets = [], []
        for c in range(len(n)):
            own = scatter[c] / n[c] if n[c] > d else pooled
            cov = (1 - to_pooled) * own + to_pooled * pooled
            cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(pooled) + np.diag(cov)) / 2
            factor = np.linalg.cholesky(cov + 1e-6 * np.eye(d))
            whiteners.append(np.tril(np.linalg.inv(factor)))  # once: a batch then takes one product
            dets.append(2 * np.log(np.diag(factor)).sum())
        return cls(means, np.array(whiteners), np.array(dets), np.log((n + 1) / (total + len(n))))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1."""
        dens = []
        for mean, whitener, det, prior in zip(self.means, self.whiteners, self.log_dets, self.log_priors, strict=True):
            z = (x - mean) @ whitener.T
            dens.append(prior - 0.5 * (det + (z * z).sum(1)))
        return 1 / (1 + np.exp(np.clip(dens[0] - dens[1], -500, 500)))


def fit(stats: DataFrame, labels: DataFrame, label: str, to_pooled: float, to_diagonal: float) -> Discriminant:
    """Class sums over all labelled training rows, in one distributed aggregation.

    Statistics are rounded to whole multiples of ``1 / UNIT`` and summed as whole numbers, so the sums, and with them all scores, don't depend
    on how rows are dealt to tasks.
    """
    d = len(STATS)
    rows = stats.where(training_row("doc_id")).join(labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y")), "doc_id")

    @tidy
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((2, 1 + d + d * d), object)  # whole numbers of any size
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.rint(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) * UNIT).astype(np.int64)
            for c in (0, 1):
                for a in range(0, len(own := x[y == c]), 256):
                    part = own[a : a + 256]
                    if np.abs(part).max() >= 1 << 27:  # a text of one huge word: sums of squares would not fit a long
                        part = part.astype(object)
                    acc[c] += np.concatenate([[len(part)], part.sum(0), (part.T @ part).ravel()]).astype(object)
        yield pa.RecordBatch.from_pydict({"k": np.arange(acc.size), "v": pa.array([str(v) for v in acc.ravel()], pa.string())})

    whole = rows.select("y", "x").mapInArrow(partial, "k long, v string").select("k", F.col("v").cast("decimal(38,0)").alias("v"))
    sums = {r.k: int(r.v) for r in whole.groupBy("k").agg(F.sum("v").alias("v")).collect()}  # 2 (1 + d + d²) numbers
    power = np.concatenate([[0], np.ones(d, int), np.full(d * d, 2)])
    acc = np.array([sums.get(k, 0) / UNIT ** int(power[k % len(power)]) for k in range(2 * len(power))])
    acc = acc.reshape(2, -1)
    return Discriminant.fit(acc[:, 0], acc[:, 1 : 1 + d], acc[:, 1 + d :].reshape(2, d, d), to_pooled, to_diagonal)


def score_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", threshold: float = 0.3, to_pooled: float = 0.2, to_diagonal: float = 0.1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (posterior of label 1), predicted (score >= threshold).

    Labels are learned from rows whose crc32(doc_id as text) mod 5 is not 0; a document labelled more than once counts once for each
    label, labels other than 0 and 1 are left out. Null and empty texts have the statistics of no words and get a score like any
    other. A null id is never a training row and is not held out. With no labels at all both classes are alike and every score is one
    half. Statistics that are not finite can't arise. Texts of any length are read whole. Rows that repeat an id or a text each get a score, equal texts equal ones; a score at
    the threshold is 1. Other columns, whatever their names, are not read. An empty table gives an empty result.
    """
    stats = durable(document_statistics(docs, id_col, text_col))
    model = fit(stats, labels, label, to_pooled, to_diagonal)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x) if len(x) else np.zeros(0))], names=["doc_id", "score"])

    out = stats.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
