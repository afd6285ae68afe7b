"""SimHash near-duplicates: fingerprints, a segment-popcount embedding, a grid range join, exact verification.

A fingerprint's 64 bits are cut into 32 segments of two bits. The vector of the segments' bit counts (0, 1 or 2 each) is
its place in a grid; the Manhattan distance of two places is never more than the Hamming distance of the fingerprints, so
the pairs within Manhattan distance ``radius`` hold every link. The counts are kept in unary (the bits of a segment sorted),
which makes that distance a popcount of an exclusive or.

The range join: coordinates are cut into ``groups`` groups. A pair within Manhattan distance ``radius`` differs in at most
``radius`` groups, so it agrees in ``groups - radius`` whole groups: it shares a grid cell in at least one of
the projections onto ``groups - radius`` groups. Rows are dealt by (projection, cell); in a cell, pairs are held
to the lower bound first and then to the exact distance.

A cell never emits all of its pairs: it emits the links that join it, one at most for each row (a spanning forest),
from which components follow without loss. A cell with more than ``CELL`` fingerprints is cut into blocks and dealt as
pairs of blocks, so no task holds more than two blocks of one cell at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import group_sums, kept, steps, text_column, tidy, words
from .common import durable
from .components import components

#: Most fingerprints of one cell that are compared in one piece.
CELL = 8192
#: Shingles whose bits are counted in one 16-bit lane before lanes are unpacked.
LANE = 65_000


def bit_majorities(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """64-bit words whose bit b is 1 if over half of ``h[off[i]:off[i+1]]`` have it; an empty group gives 0."""
    n = np.diff(off)
    pieces, own = off, np.arange(len(off))
    if n.size and n.max() > LANE:  # long groups are counted in pieces that a lane can hold
        pieces = np.concatenate([np.arange(a, b, LANE) for a, b in zip(off[:-1], off[1:], strict=True)] + [off[-1:]])
        own = np.concatenate([[0], np.cumsum(-(-n // LANE))])
    out = np.zeros(len(n), np.uint64)
    mask = np.uint64(0x0001000100010001)
    for j in range(16):
        lanes = group_sums((h >> np.uint64(j)) & mask, pieces)
        for k in range(4):
            count = group_sums(((lanes >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64), own)
            out |= (count * 2 > n).astype(np.uint64) << np.uint64(j + 16 * k)
    return out


def shingle_hashes(texts: pa.Array, width: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every ``width``-word shingle of each text, repeats included, and each text's offsets.

    A-Z are lower-cased, words are runs without ASCII white space and joined by a space. A text of fewer words has one shingle
    of all of them; one without words has none.
    """
    from xxhash import xxh64_intdigest

    flat, off = words(pc.ascii_lower(texts))
    size = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size + 1) - 1  # in the words joined by a space
    starts = ends - size
    n = np.diff(off)
    m = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(m)])
    first = np.repeat(off[:-1], m) + np.arange(out[-1]) - np.repeat(out[:-1], m)
    last = np.minimum(first + width, np.repeat(off[1:], m)) - 1
    joined = " ".join(flat.to_pylist()).encode()
    h = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)), np.uint64, len(first))
    return h, out


def distinct_in_groups(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each group's distinct values, ascending, and the groups' offsets."""
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(off) - 1))]).astype(np.int64)


def fingerprints(docs: DataFrame, *, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row; fp holds the fingerprint's bits in a long. A null text has fingerprint zero."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("simhash")
        for batch in batches:
            texts, fps = text_column(batch, "text"), []
            for a, b in steps(texts, 4 << 20):
                fps.append(bit_majorities(*shingle_hashes(texts.slice(a, b - a), width)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0, np.uint64), *fps]).view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def projections(groups: int, radius: int) -> list[int]:
    """Bit masks of all choices of ``groups - radius`` groups of whole segments."""
    cuts = [32 * k // groups for k in range(groups + 1)]
    part = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(part[g] for g in c) for c in combinations(range(groups), groups - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = int(parent[i])
    return i


def joined_in_cells(fp: np.ndarray, place: np.ndarray, end: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each cell's rows: row i's cell reaches up to row ``end[i]``. A spanning forest, as index pairs."""
    parent, left, right = np.arange(len(fp)), [], []
    live, d = np.nonzero(end > np.arange(len(fp)) + 1)[0], 1
    while len(live):
        a, b = live, live + d
        near = np.bitwise_count(place[a] ^ place[b]) <= radius
        near[near] = np.bitwise_count(fp[a[near]] ^ fp[b[near]]) <= radius
        a, b = a[near], b[near]
        if len(a):
            apart = parent[a] != parent[b]
            for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
                p, q = find(parent, x), find(parent, y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    left.append(x)
                    right.append(y)
            if d % 16 == 0 or len(left) < 64:
                parent = parent[parent]
        d += 1
        live = live[end[live] > live + d]
    return np.array(left, np.int64), np.array(right, np.int64)


def unary_counts(fp: np.ndarray) -> np.ndarray:
    """The segments' bit counts in unary: each segment's bits sorted."""
    five = np.uint64(0x5555555555555555)
    one = np.uint64(1)
    return ((fp & (fp >> one) & five) << one) | ((fp | (fp >> one)) & five)


def links(fps: DataFrame, *, radius: int = 3, groups: int = 6) -> DataFrame:
    """(a, b): links that join all fingerprints within ``radius``; ``fps``: distinct fp (long).

    Every pair within the radius is linked, or joined by a path of links within the radius. No pair above it is linked.
    ``groups`` must exceed ``radius``; more groups make more, smaller cells.
    """
    x, five = F.col("fp"), F.lit(_signed(0x5555555555555555))
    half = F.shiftrightunsigned(x, 1)
    place = F.shiftleft(x.bitwiseAND(half).bitwiseAND(five), 1).bitwiseOR(x.bitwiseOR(half).bitwiseAND(five))
    masks = F.array(*[F.lit(_signed(m)) for m in projections(groups, radius)])
    celled = fps.select("fp", place.alias("place"), F.posexplode(masks).alias("side", "mask")).select("fp", F.xxhash64("side", F.col("place").bitwiseAND(F.col("mask"))).alias("cell"))
    big = durable(celled.groupBy("cell").count().where(F.col("count") > CELL).select("cell", F.ceil(F.col("count") / (CELL // 2)).cast("int").alias("blocks")))
    n_big = big.count()
    if n_big:
        celled = celled.join(F.broadcast(big) if n_big <= 50_000 else big, "cell", "left")
        own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
        with_each = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.least(k, own) * F.col("blocks") + F.greatest(k, own))
        dealt = celled.select("fp", "cell", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(with_each)).alias("block"))
    else:
        dealt = celled.select("fp", "cell", F.lit(0).alias("block"))
    dealt = dealt.repartition("cell", "block").sortWithinPartitions("cell", "block")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def out(fp: np.ndarray, cell: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
            new = np.flatnonzero((cell[1:] != cell[:-1]) | (block[1:] != block[:-1])) + 1
            bounds = np.concatenate([[0], new, [len(cell)]])
            u = fp.view(np.uint64)
            a, b = joined_in_cells(u, unary_counts(u), np.repeat(bounds[1:], np.diff(bounds)), radius)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            same = (now[1] == now[1][-1]) & (now[2] == now[2][-1])  # rows of the last cell wait for the next batch
            cut = int(np.argmax(same))
            if cut:
                yield out(*[x[:cut] for x in now])
            held = [x[cut:] for x in now]
        if held is not None:
            yield out(*held)

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, *, width: int = 3, radius: int = 3, groups: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Rows link at ``radius`` or fewer differing bits; component_id is the smallest doc_id that can be reached, itself included.
    Equal fingerprints, those of exact copies among them, are one node. Texts without words, null ones too, have
    fingerprint zero and link like any other. A null doc_id is never a component's id unless it is alone with others like it;
    such a component's id is null. Repeated rows stay repeated. Texts of any length are read whole; a bit that exactly half of the
    shingles have set is 0. Other columns are not read. An empty table gives an empty result.
    """
    fps = durable(fingerprints(docs, width=width, id_col=id_col, text_col=text_col))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # nodes are numbered by fingerprint, so that ids that are null or occur twice do no harm
    roots = components(links(distinct.select("fp"), radius=radius, groups=groups))
    member = durable(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(ids, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
