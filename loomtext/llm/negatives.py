"""Hard negatives by product quantisation with stored residual norms.

Vectors become whole numbers. A bounded sample gives each group of components a codebook; every row is stored with its codes and the norm of what they leave
over. For an anchor, a lookup table per group gives the inner product with a row's codes, and by Cauchy-Schwarz the true product lies within
``|anchor| * residual`` of it. These bounds drop rows rigorously: a row is a candidate unless as many others are surely better, or it is surely outside the
window. Candidates get their exact integer product, which alone decides. Rows and anchors meet in blocks of bounded size; a block keeps its best few
rows for each anchor and window, and those meet once more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable

#: Rows and anchors that meet in one task at a time, and anchors whose lookup tables are held at a time.
CHUNK, ANCHORS, TABLES = 8192, 2048, 32
#: Components from this size on would leave the exact range of scores.
LARGEST = 1 << 26


@dataclass
class Quantiser:
    """Codebooks [group, code, component]; groups are ``width`` components wide, the last one filled up with zeros."""

    books: np.ndarray

    @property
    def width(self) -> int:
        return self.books.shape[2]

    def groups(self, x: np.ndarray) -> np.ndarray:
        """Vectors as [row, group, component]."""
        g, _, w = self.books.shape
        out = np.zeros((len(x), g * w))
        out[:, : x.shape[1]] = x
        return out.reshape(len(x), g, w)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes [row, group] of the nearest entries, and an upper bound of each row's residual norm."""
        parts = self.groups(x)
        codes, rest = np.zeros(parts.shape[:2], np.uint8), np.zeros(len(x))
        for g, book in enumerate(self.books):
            near = ((book * book).sum(1)[None] - 2 * parts[:, g] @ book.T).argmin(1)
            codes[:, g] = near
            rest += ((parts[:, g] - book[near]) ** 2).sum(1)
        return codes, np.sqrt(rest) * (1 + 1e-9) + 1e-9

    def tables(self, anchors: np.ndarray) -> np.ndarray:
        """Lookup tables [group, code, anchor]."""
        return np.einsum("agw,gkw->gka", self.groups(anchors), self.books)


def fit_quantiser(x: np.ndarray, *, width: int = 2, codes: int = 256, rounds: int = 12, seed: int = 5) -> Quantiser:
    """Codebooks by Lloyd's rounds over a sample, one for each ``width`` components."""
    d = x.shape[1]
    g = -(-d // width)
    filled = np.zeros((len(x), g * width))
    filled[:, :d] = x
    rng = np.random.default_rng(seed)
    books = np.zeros((g, codes, width))
    for j in range(g):
        part = filled[:, j * width : (j + 1) * width]
        own = np.unique(part, axis=0)
        book = own[rng.permutation(len(own))[:codes]]
        for _ in range(rounds):
            near = ((book * book).sum(1)[None] - 2 * part @ book.T).argmin(1)
            n = np.bincount(near, minlength=len(book))
            sums = np.stack([np.bincount(near, part[:, c], minlength=len(book)) for c in range(width)], 1)
            book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
        books[j] = book[np.arange(codes) % len(book)]
    return Quantiser(books)


def whole_vectors(vectors: DataFrame, label: Column | str, *, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, label, v, row): rows that take part, with components floor(scale * x) in doubles; ``row`` is a hash that tells rows of one id apart.

    Rows that agree in all of id, label and vector are one. The dimension is the most frequent one, ties to the smaller.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / scale))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(fine)
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double"))).distinct().withColumn("row", F.xxhash64("label", "v"))
    rows = durable(rows)
    d = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (d[0].d if d else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


@dataclass
class Block:
    """A chunk of stored rows."""

    id: np.ndarray
    row: np.ndarray
    label: np.ndarray
    v: np.ndarray
    codes: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, t: pa.Table) -> Block:
        return cls(t.column("id").to_numpy(), t.column("row").to_numpy(), t.column("label").to_numpy(), _matrix(t.column("v")), _bytes(t.column("codes")), t.column("rest").to_numpy())

    def bounds(self, q: Quantiser, anchors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each anchor: its place, and lower and upper bounds of its products with all rows."""
        for a in range(0, len(anchors), TABLES):
            own = anchors[a : a + TABLES]
            tables = q.tables(own)
            about = np.zeros((len(self.id), len(own)))
            for g, table in enumerate(tables):
                about += table[self.codes[:, g]]
            slack = np.outer(self.rest, np.linalg.norm(own, axis=1))
            slack += 1e-9 * (1 + np.abs(about))  # sums of rounded numbers
            for k in range(len(own)):
                yield a + k, about[:, k] - slack[:, k], about[:, k] + slack[:, k]

    def exact(self, anchor: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Integer products of the anchor with the rows at ``places``."""
        return self.v[places].astype(np.int64) @ anchor.astype(np.int64)

    def best(self, places: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """The ``k`` first by score, ties by smaller id, then ``row``."""
        return np.lexsort((self.row[places], self.id[places], -score))[:k]


def _least(lower: np.ndarray, k: int) -> float:
    """What ``k`` rows reach for sure; minus infinity if there are fewer."""
    return -np.partition(-lower, k - 1)[k - 1] if len(lower) >= k else -np.inf


def positives_in(q: Quantiser, block: Block, a_id: np.ndarray, a_label: np.ndarray, anchors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor its best ``k`` rows of the same label in the block, with their scores; an anchor's own id is left out."""
    for label in np.unique(a_label):
        mine = np.flatnonzero(block.label == label)
        if not len(mine):
            continue
        part = Block(*[c[mine] for c in (block.id, block.row, block.label, block.v, block.codes, block.rest)])
        own = np.flatnonzero(a_label == label)
        for i, low, high in part.bounds(q, anchors[own]):
            other = part.id != a_id[own[i]]
            places = np.flatnonzero(other & (high >= _least(low[other], k)))
            score = part.exact(anchors[own[i]], places)
            first = part.best(places, score, k)
            if len(first):
                yield int(own[i]), mine[places[first]], score[first]


def negatives_in(q: Quantiser, block: Block, a_id: np.ndarray, a_label: np.ndarray, anchors: np.ndarray, wanted: list[list[int]], k: int, floor: tuple[int, int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each anchor and each positive score in ``wanted``: the block's best ``k`` rows of other labels within the score's window."""
    num, den = floor
    for i, low, high in block.bounds(q, anchors):
        other = (block.label != a_label[i]) & (block.id != a_id[i])
        for top in sorted(set(wanted[i])):
            bottom = -(-num * top // den)
            if bottom > top:
                continue
            may = other & (high >= bottom) & (low <= top)
            sure = may & (low >= bottom) & (high <= top)
            places = np.flatnonzero(may & (high >= _least(low[sure], k)))
            score = block.exact(anchors[i], places)
            inside = (score >= bottom) & (score <= top)
            places, score = places[inside], score[inside]
            first = block.best(places, score, k)
            if len(first):
                yield i, top, places[first], score[first]


def _empty(names: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({n: pa.array([], t) for n, t in names.items()})


FOUND = {"anchor_id": pa.int64(), "anchor_row": pa.int64(), "top": pa.int64(), "id": pa.int64(), "row": pa.int64(), "score": pa.int64()}
FOUND_DDL = ", ".join(f"{n} long" for n in FOUND)


def hard_negatives(
    vectors: DataFrame, *, label: Column | str = "label", anchors: Column | None = None, positives: int = 5, negatives: int = 5, floor: tuple[int, int] = (4, 5), scale: int = 256, sample_rows: int = 8192, width: int = 2,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its ``positives`` best rows of the same label, the first ``negatives``
    rows of other labels whose score is at most the positive's and at least ``floor`` (numerator, denominator) of it.

    Components become floor(scale * x); scores are exact integer inner products, higher first, ties by smaller id. ``anchors`` says which rows are anchors (a
    condition on ``id``; by default ids divisible by 100). Codebooks are fitted on the ``sample_rows`` rows of the smallest xxhash64(id); all rows are encoded and searched, and the bounds
    drop none that could be among the first, so results don't depend on the sample.

    Rows with a null id, label, vector or component, a non-finite component, one of 2^26 or more after scaling, no component, or another dimension than most take no part. Equal rows (id, label,
    vector) are one; other rows of one id are rows of their own, an anchor's own id is never its positive or negative, and an id with several anchor rows has results for each. Fewer rows than
    asked for are all returned; a positive with a negative score has no window. Rows are dealt by a hash of the whole row, so neither a frequent id, label nor vector fills a task. Other
    columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = whole_vectors(vectors, label, scale=scale, id_col=id_col, vector_col=vector_col)
    sample = _matrix(rows.orderBy(F.xxhash64("id"), "id", "row").limit(sample_rows).select("v").toArrow().column(0))
    if not len(sample):
        return spark.createDataFrame([], schema)
    q = fit_quantiser(sample, width=width)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, rest = q.encode(_matrix(batch.column(2))) if batch.num_rows else (np.zeros((0, 1), np.uint8), np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(rest)], names=["id", "label", "v", "row", "codes", "rest"])

    stored = durable(rows.mapInArrow(encode, "id long, label long, v array<double>, row long, codes binary, rest double"))
    asked = stored.where(F.col("id") % 100 == 0 if anchors is None else anchors).select("id", "label", "v", "row")
    chunks, blocks = (max(1, -(-df.count() // most)) for df, most in ((stored, CHUNK), (asked, ANCHORS)))
    dealt = lambda m: F.pmod(F.xxhash64("row", "id"), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    keys = ["chunk", "block"]
    right = stored.withColumn("chunk", dealt(chunks)).withColumn("block", each(blocks)).select(*keys, *stored.columns)

    def meet(left: DataFrame, search: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
        """Each block of anchors with each chunk of rows."""
        left = left.withColumn("block", dealt(blocks)).withColumn("chunk", each(chunks)).select(*keys, *[F.col(c).alias(c) for c in left.columns])
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, FOUND_DDL)

    def table_of(a: pa.Table, block: Block, found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.Table:
        if not found:
            return _empty(FOUND)
        n = [len(p) for _, _, p, _ in found]
        i = np.repeat([x[0] for x in found], n)
        places = np.concatenate([x[2] for x in found])
        columns = (a.column("id").to_numpy()[i], a.column("row").to_numpy()[i], np.repeat([x[1] for x in found], n), block.id[places], block.row[places], np.concatenate([x[3] for x in found]))
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(FOUND, columns, strict=True)})

    def find_positives(a: pa.Table, t: pa.Table) -> pa.Table:
        if not a.num_rows or not t.num_rows:
            return _empty(FOUND)
        block = Block.of(t)
        found = positives_in(q, block, a.column("id").to_numpy(), a.column("label").to_numpy(), _matrix(a.column("v")), positives)
        return table_of(a, block, [(i, 0, p, s) for i, p, s in found])

    def find_negatives(a: pa.Table, t: pa.Table) -> pa.Table:
        if not a.num_rows or not t.num_rows:
            return _empty(FOUND)
        block = Block.of(t)
        return table_of(a, block, list(negatives_in(q, block, a.column("id").to_numpy(), a.column("label").to_numpy(), _matrix(a.column("v")), a.column("tops").to_pylist(), negatives, floor)))

    anchor, order = ["anchor_id", "anchor_row"], [F.desc("score"), "id", "row"]
    near = meet(asked, find_positives).withColumn("r", F.row_number().over(Window.partitionBy(*anchor).orderBy(*order))).where(F.col("r") <= positives)
    near = durable(near.select(*anchor, F.col("id").alias("positive_id"), F.col("score").alias("top")))
    tops = near.groupBy(*anchor).agg(F.collect_set("top").alias("tops"))  # ``positives`` numbers an anchor at most
    ready = asked.join(tops.withColumnsRenamed({"anchor_id": "id", "anchor_row": "row"}), ["id", "row"])
    below = meet(ready, find_negatives).withColumn("rank", F.row_number().over(Window.partitionBy(*anchor, "top").orderBy(*order))).where(F.col("rank") <= negatives)
    out = near.join(below.select(*anchor, "top", "rank", F.col("id").alias("negative_id"), "score"), [*anchor, "top"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", F.col("top").alias("positive_score"), F.col("score").alias("negative_score"))
