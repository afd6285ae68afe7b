"""Approximate nearest neighbours by learned partitions.

Fitting, on a bounded sample: the sample's neighbour graph is cut into balanced parts by recursive bisection (a spectral split at the
median, refined by swaps that keep the halves equal), and a small classifier learns, from a vector alone, how a vector's
neighbours are spread over the parts. Tables too large for one level's parts get a second level: each part is fitted and cut in the same way,
on a bounded sample of its own. Indexing: every row goes to its most probable part. Searching: a query goes to its most probable
parts, as many as hold a certain share of its probability, and all rows there are ranked by their exact inner products. That share is read off the sample, so that
the parts visited hold ``coverage`` of the neighbours there. A query whose parts hold too few rows goes on to further parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable

#: Rows of a part, and queries, that meet in one task at a time.
CHUNK, QUERIES = 4096, 2048
#: Most parts that one level is cut into, and rows whose probabilities over all parts are held at a time.
MOST_PARTS, ROWS = 256, 256


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Each row's ``k`` nearest others by inner product, in blocks."""
    n = len(x)
    k = min(k, n - 1)
    out = np.zeros((n, k), np.int64)
    for a in range(0, n, 512):
        s = x[a : a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _bisect(edges_a: np.ndarray, edges_b: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Sides of a graph's nodes, equal in number but for one: spectral split at the median, then balanced swaps."""
    degree = np.bincount(edges_a, minlength=n) + 1.0
    v = rng.standard_normal(n)
    root = np.sqrt(degree)
    for _ in range(60):
        v -= root * (v @ root) / (root @ root)
        w = v / root
        v = 0.5 * v + 0.5 * (np.bincount(edges_a, w[edges_b], minlength=n) + w) / root
        v /= np.linalg.norm(v) + 1e-12
    side = np.zeros(n, bool)
    side[np.argsort(v / root, kind="stable")[n // 2 :]] = True
    for _ in range(30):
        cross = side[edges_a] != side[edges_b]
        gain = np.bincount(edges_a, np.where(cross, 1.0, -1.0), minlength=n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right), max(8, n // 50))
        good = gain[left[:m]] + gain[right[:m]] > 2
        if not good.any():
            break
        before = cross.sum()
        trial = side.copy()
        trial[left[:m][good]], trial[right[:m][good]] = True, False
        if (trial[edges_a] != trial[edges_b]).sum() >= before:
            break
        side = trial
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """A part for each node; ``parts`` is a power of two and parts differ by a few nodes at most."""
    n, k = graph.shape
    rng = np.random.default_rng(seed)
    a = np.repeat(np.arange(n), k)
    b = graph.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    part = np.zeros(n, np.int64)
    for _ in range(int(math.log2(parts))):
        inside = part[a] == part[b]
        nxt = part * 2
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            if len(own) < 2:
                continue
            place = np.full(n, -1)
            place[own] = np.arange(len(own))
            e = inside & (part[a] == p)
            nxt[own] += _bisect(place[a[e]], place[b[e]], len(own), rng)
        part = nxt
    return part


@dataclass
class Router:
    """A two-layer classifier from vectors to parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    @property
    def parts(self) -> int:
        return len(self.b2)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """How probable each part is, for vectors of any length."""
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        q = np.exp(z - z.max(1, keepdims=True))
        return q / q.sum(1, keepdims=True)


def whole(d: int) -> Router:
    """A router that knows one part."""
    return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))


@dataclass
class Tree:
    """A router and, with a second level, one for each of its parts; leaves are numbered from 0.

    ``share``: how much of a query's probability the leaves it visits hold.
    """

    root: Router
    below: list[Router]
    share: float = 1.0

    @property
    def first(self) -> np.ndarray:
        """The number of each part's first leaf, and of all leaves."""
        return np.concatenate([[0], np.cumsum([r.parts for r in self.below])]) if self.below else np.arange(self.root.parts + 1)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """Each vector's most probable part and there its most probable leaf; ties to the smaller number."""
        out = self.root.probabilities(x).argmax(1) if len(x) else np.zeros(0, np.int64)
        if not self.below:
            return out
        at = self.first
        leaves = np.zeros(len(x), np.int64)
        for p in np.unique(out).tolist():
            own = out == p
            leaves[own] = at[p] + self.below[p].probabilities(x[own]).argmax(1)
        return leaves

    def ordered(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All leaves of each vector, most probable first, and the probability of those before each."""
        q = self.root.probabilities(x)
        if self.below:
            q = np.concatenate([q[:, p : p + 1] * r.probabilities(x) for p, r in enumerate(self.below)], axis=1)
        order = np.argsort(-q, axis=1, kind="stable")
        q = np.take_along_axis(q, order, 1)
        return order, np.cumsum(q, 1) - q

    def visits(self, x: np.ndarray, rows: np.ndarray, least: int) -> list[np.ndarray]:
        """The leaves each query visits: those that hold ``share`` of its probability, and more until there are ``least`` of ``rows``."""
        out = []
        for a in range(0, len(x), ROWS):
            order, before = self.ordered(x[a : a + ROWS])
            held = np.cumsum(rows[order], 1) - rows[order]
            n = np.maximum((before < self.share).sum(1), (held < least).sum(1))
            out += [o[:m] for o, m in zip(order, n.tolist(), strict=True)]
        return out


def fit_router(x: np.ndarray, parts: int, *, neighbours: int = 20, hidden: int = 128, rounds: int = 40, seed: int = 3) -> tuple[Router, np.ndarray, np.ndarray]:
    """Partition the sample's graph and train the classifier; also gives the graph and the fifth of the sample that takes no part in training."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    unit, d = x / norm, x.shape[1]
    graph = neighbour_graph(x, neighbours)
    part = balanced_parts(graph, parts, seed)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(len(x)), part] += graph.shape[1] / 2
    target /= target.sum(1, keepdims=True)
    rng = np.random.default_rng(seed)
    p = [rng.standard_normal((d, hidden)) * math.sqrt(2 / d), np.zeros(hidden), rng.standard_normal((hidden, parts)) * math.sqrt(1 / hidden), np.zeros(parts)]
    m1, m2, t = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p], 0
    every = rng.permutation(len(x))
    tried, learned = every[: len(x) // 5], every[len(x) // 5 :]
    for _ in range(rounds):
        for own in np.array_split(rng.permutation(learned), max(1, len(learned) // 256)):
            xb, yb = unit[own], target[own]
            h = np.maximum(xb @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            q = np.exp(z - z.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            dz = (q - yb) / len(own)
            dh = (dz @ p[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((xb.T @ dh + 1e-4 * p[0], dh.sum(0), h.T @ dz + 1e-4 * p[2], dz.sum(0))):
                m1[i] = 0.9 * m1[i] + 0.1 * g
                m2[i] = 0.999 * m2[i] + 0.001 * g * g
                p[i] -= 2e-3 * (m1[i] / (1 - 0.9**t)) / (np.sqrt(m2[i] / (1 - 0.999**t)) + 1e-8)
    return Router(*p), graph, tried


def choose_share(tree: Tree, x: np.ndarray, graph: np.ndarray, tried: np.ndarray, coverage: float) -> float:
    """The share of probability at which ``coverage`` of the neighbours of the rows ``tried`` lie in the leaves visited."""
    if coverage >= 1 or not len(tried):
        return 1.0
    home, need = tree.leaf(x), []
    for a in range(0, len(tried), ROWS):
        own = tried[a : a + ROWS]
        order, before = tree.ordered(x[own])
        rank = np.argsort(order, axis=1)
        need.append(np.take_along_axis(before, np.take_along_axis(rank, home[graph[own]], 1), 1).ravel())
    return float(np.quantile(np.concatenate(need), coverage, method="higher")) + 1e-12


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): vectors of doubles that take part, each (id, v) once, equal rows being merged before they are exchanged; the dimension is the most frequent one, ties to the smaller."""
    v = F.col(vector_col).cast("array<double>")
    ok = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    ok = ok.where(fine)
    d = ok.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return ok.where(F.size("v") == (d[0].d if d else 0)).distinct()


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _top(q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's ``k`` best ids among the candidates, its own aside, by each id's best row: (query index, candidate index, score).

    The matrix product only narrows the choice; scores and ties come from sums that don't depend on a row's place.
    """
    order = np.argsort(c_id, kind="stable")
    c_id, c = c_id[order], c[order]
    s = q @ c.T
    s[q_id[:, None] == c_id[None, :]] = -np.inf
    starts = np.flatnonzero(np.append(True, c_id[1:] != c_id[:-1]))  # rows of one id lie together
    each = s if len(starts) == len(c_id) else np.maximum.reduceat(s, starts, axis=1)
    at = min(k, each.shape[1]) - 1
    last = np.partition(-each, at, axis=1)[:, at]
    scale = 1e-12 * (1 + np.linalg.norm(q, axis=1) * np.linalg.norm(c, axis=1).max())
    i, j = np.nonzero((s >= (-last - scale)[:, None]) & np.isfinite(s))
    score = np.concatenate([np.zeros(0), *[(q[i[a : a + 65536]] * c[j[a : a + 65536]]).sum(1) for a in range(0, len(i), 65536)]])
    if len(starts) < len(c_id):  # an id's best row speaks for it
        best = np.lexsort((-score, c_id[j], i))
        first = np.append(True, (i[best][1:] != i[best][:-1]) | (c_id[j[best]][1:] != c_id[j[best]][:-1])) if len(best) else np.zeros(0, bool)
        i, j, score = i[best][first], j[best][first], score[best][first]
    by = np.lexsort((c_id[j], -score, i))
    i, j, score = i[by], j[by], score[by]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], order[j[keep]], score[keep]


def fit_tree(rows: DataFrame, n: int, *, sample_rows: int, rows_per_part: int, coverage: float) -> Tree:
    """The partition for ``rows`` (id, v), fitted on the ``sample_rows`` rows of the smallest xxhash64(id), and as many of each part for a second level."""
    x = _matrix(rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow().column(0))
    many = n / rows_per_part
    parts = 1 << max(4, min(int(math.log2(MOST_PARTS)), round(math.log2(max(1, many)))))
    if len(x) <= 4 * parts:
        return Tree(whole(x.shape[1]), [])
    root, graph, tried = fit_router(x, parts)
    tree = Tree(root, [])
    if many > 2 * MOST_PARTS:
        deeper = 1 << min(int(math.log2(MOST_PARTS)), round(math.log2(many / parts)))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tree.leaf(_matrix(batch.column(1))).astype(np.int32))], names=["id", "v", "part"])

        def fit(t: pa.Table) -> pa.Table:
            own = _matrix(t.column("v"))
            r = fit_router(own, deeper)[0] if len(own) > 4 * deeper else whole(own.shape[1])
            flat = [a.ravel().tolist() for a in (r.w1, r.b1, r.w2, r.b2)]
            return pa.table({"part": t.column("part").slice(0, 1), "weights": pa.array([flat], pa.list_(pa.list_(pa.float64())))})

        near = Window.partitionBy("part").orderBy(F.xxhash64("id"), "id")
        drawn = rows.mapInArrow(place, "id long, v array<double>, part int").withColumn("r", F.row_number().over(near)).where(F.col("r") <= sample_rows).select("part", "v")
        d, fitted = x.shape[1], {r.part: r.weights for r in drawn.groupBy("part").applyInArrow(fit, "part int, weights array<array<double>>").collect()}  # MOST_PARTS routers at most
        below = []
        for p in range(parts):
            w = [np.array(v) for v in fitted[p]] if p in fitted else None
            below.append(Router(w[0].reshape(d, -1), w[1], w[2].reshape(len(w[1]), -1), w[3]) if w else whole(d))
        tree = Tree(root, below)
    tree.share = choose_share(tree, x, graph, tried, coverage)
    return tree


def nearest(vectors: DataFrame, *, k: int = 20, every: int = 20, sample_rows: int = 8192, rows_per_part: int = 1500, coverage: float = 0.94, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its ``k`` nearest of all other rows found, all others if they are fewer.

    Nearness is the inner product in double precision, ties go to the smaller id, ranks count from 1. Routers are fitted on the
    ``sample_rows`` rows of the smallest xxhash64(id), of the table and, with a second level, of each part; all rows are indexed. Rows of a null id, and
    vectors that are null, zero, hold null or non-finite components or have another dimension than most (no inner product joins the two), take no part. Equal rows (id and
    vector) are one. Rows of one id are never each other's candidates; an id counts once among a query's results, by its best score, so a query gets ``k`` different ids however many rows each
    has. A part of any size is searched in chunks of its vectors, so neither many equal vectors nor many vectors of one id fill a task. Other columns are not read. An empty table, or one with fewer than two ids, gives an empty result.
    """
    spark = vectors.sparkSession
    rows = durable(valid_vectors(vectors, id_col, vector_col))
    n = rows.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if n < 2:
        return spark.createDataFrame([], schema)
    tree = fit_tree(rows, n, sample_rows=sample_rows, rows_per_part=rows_per_part, coverage=coverage)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            leaf = np.concatenate([np.zeros(0, np.int64), *[tree.leaf(x[a : a + ROWS]) for a in range(0, len(x), ROWS)]])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf.astype(np.int32))], names=["id", "v", "part"])

    index = durable(rows.mapInArrow(place, "id long, v array<double>, part int"))
    leaves = int(tree.first[-1])
    ids = np.zeros(leaves, np.int64)  # each id counts in one part
    for r in index.groupBy("id").agg(F.min("part").alias("part")).groupBy("part").count().collect():  # a row for each part, MOST_PARTS² at most
        ids[r.part] = r["count"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = tree.visits(_matrix(batch.column(1)), ids, k + 1) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([t.astype(np.int32) for t in to], pa.list_(pa.int32()))], names=["id", "v", "parts"])

    queries = rows.where(F.col("id") % every == 0).mapInArrow(route, "id long, v array<double>, parts array<int>")
    queries = durable(queries.select("id", "v", F.explode("parts").alias("part")))
    # a part's rows and queries are cut into chunks that meet pair by pair
    sizes = index.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    asked = queries.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    cuts = F.broadcast(sizes.join(asked, "part"))  # a row for each part
    own = lambda m: F.pmod(F.xxhash64("id", "v"), F.col(m)).cast("int")  # noqa: E731  an id of many vectors is dealt by them
    each = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    left = queries.join(cuts, "part").withColumn("block", own("blocks")).withColumn("chunk", each("chunks"))
    right = index.join(cuts, "part").withColumn("chunk", own("chunks")).withColumn("block", each("blocks"))

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q_id, c_id = q.column("id").to_numpy(), c.column("id").to_numpy()
        i, j, score = _top(q_id, _matrix(q.column("v")), c_id, _matrix(c.column("v")), k)
        return pa.table({"query_id": q_id[i], "vec_id": c_id[j], "score": score})

    keys = ["part", "chunk", "block"]
    found = left.select(*keys, "id", "v").groupBy(*keys).cogroup(right.select(*keys, "id", "v").groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
