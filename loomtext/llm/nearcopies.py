"""Near copies by the exact similarity of word shingles: SimHash first, an exact prefix filter for what lies beyond its radius.

1. Every text gets the SimHash fingerprint of its shingles; ``simhash.links`` joins fingerprints within the radius, and the groups that
   come of it are held to the exact similarity. That settles most copies with few edits.
2. Between the groups of step 1, the rest is found by a prefix filter, which leaves nothing out: in one order of all shingles, two sets as similar
   as ``threshold`` share one of their first ``n - ceil(t n) + 1``. Texts that meet there are held to a lower bound of their sets' difference (sizes
   and parities) and then to the exact similarity. Shingles whose texts are all of one group of step 1 are no longer looked at, nor are those whose
   texts are of sizes too far apart.

Groups are verified in blocks of bounded size that emit spanning forests. In a group of more than ``BLOCK`` texts all are first compared with a few pivots; only texts
that hang on none of the largest part's are compared further, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrowtext import group_sums, kept, release, steps, text_column, tidy
from .common import durable, fresh, row_key, small_batches
from .components import components
from .simhash import CELL, bit_majorities, distinct_in_groups, find, links, shingle_hashes

#: Bytes of text that are shingled at a time: a worker holds some twenty times as many.
STEP = 1 << 19
#: Texts of one group that are compared in one piece; pivots of a larger group and rounds in which they are drawn.
BLOCK, PIVOTS, ROUNDS = 512, 4, 2
#: Up to how many rows a list of row keys or shingles is broadcast, and shingles of pivots.
BROADCAST_ROWS, BROADCAST_SHINGLES = 1_000_000, 2_000_000
#: Texts that are drawn to see which shingles are common, and how many of those are told apart. They set an order, which any order may replace.
#: Shingles of ``HOT`` of the drawn texts or more are counted before they are exchanged.
SAMPLE_TEXTS, COMMON, HOT = 8192, 100_000, 8
#: Parities have 64 * 2**c bits, as many as a set's shingles or, within a step of sizes, nearly so, up to this c; beyond it the bound they give is weaker, never wrong.
LARGEST = 6


def _prefixes(h: np.ndarray, off: np.ndarray, threshold: float, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set's first ``n - ceil(t n) + 1`` values, in the one order of all sets: rare ones before ``common`` (ascending), then by value."""
    n = np.diff(off)
    owner = np.repeat(np.arange(len(n)), n)
    late = common[np.minimum(np.searchsorted(common, h), len(common) - 1)] == h if len(common) else np.zeros(len(h), bool)
    h = h[np.lexsort((h, late, owner))]
    need = np.where(n > 0, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1, 0)
    place = np.arange(len(h)) - np.repeat(off[:-1], n)
    return h[place < np.repeat(need, n)], np.concatenate([[0], np.cumsum(need)])


def _parities(h: np.ndarray, off: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each set, the parities of how many of its values fall on each of ``64 << level`` bits (none at a level below 0).

    Two sets' parities differ in no more bits than the sets differ in values.
    """
    wide = np.where(level < 0, 0, 1 << np.maximum(level, 0)).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(wide)])
    n = np.where(wide > 0, np.diff(off), 0)
    h = h[np.repeat(wide > 0, np.diff(off))]
    at = h & (np.repeat(wide, n).astype(np.uint64) * np.uint64(64) - np.uint64(1))
    out = np.zeros(ends[-1], np.uint64)
    np.bitwise_xor.at(out, np.repeat(ends[:-1], n) + (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out, ends


def maybe_similar_in_cells(bits: np.ndarray, size: np.ndarray, own: np.ndarray, group: np.ndarray, end: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each cell's rows of different groups whose sizes and parities leave a similarity of ``threshold`` open: a spanning forest, as index pairs."""
    parent, left, right = np.arange(len(size)), [], []
    most = (1 - threshold) / (1 + threshold)
    live, d = np.nonzero(end > np.arange(len(size)) + 1)[0], 1
    while len(live):
        a, b = live, live + d
        fits = (group[a] != group[b]) & (own[a] | own[b]) & (np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b]) - 1e-9)
        a, b = a[fits], b[fits]
        fits = np.bitwise_count(bits[a] ^ bits[b]).sum(1, dtype=np.int64) <= most * (size[a] + size[b]) + 1e-6
        for x, y in zip(a[fits].tolist(), b[fits].tolist(), strict=True):
            p, q = find(parent, x), find(parent, y)
            if p != q:
                parent[max(p, q)] = min(p, q)
                left.append(x)
                right.append(y)
        d += 1
        live = live[end[live] > live + d]
    return np.array(left, np.int64), np.array(right, np.int64)


def _bucket(size, threshold: float):
    """Sizes in steps of ``1 / threshold``: sets as similar as ``threshold`` are of one step or of neighbouring ones."""
    return np.floor(np.log(np.maximum(size, 1)) / -np.log(threshold) + 1e-9).astype(np.int64)


def _level(bucket, threshold: float):
    """The level of the parities that sets of this step and the next are held against each other by."""
    least = np.power(threshold, -np.asarray(bucket, np.float64))
    return np.minimum(np.ceil(np.log2(np.maximum(least, 64) / 64)).astype(np.int64), LARGEST)


def _cells(gram: np.ndarray, size_step: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that meet another group's, as (row, step, own): each row stands in the cell of its shingle and step, its own, and in that of the step below."""
    n = len(gram)
    row, own = np.concatenate([np.arange(n)] * 2), np.repeat([True, False], n)
    step = np.concatenate([size_step, size_step - 1])
    order = np.lexsort((step, gram[row]))
    row, own, step = row[order], own[order], step[order]
    g, grp = gram[row], group[row]
    first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (step[1:] != step[:-1])])) if n else np.zeros(0, np.int64)
    if not n:
        return row, step, own
    meets = (np.minimum.reduceat(grp, first) < np.maximum.reduceat(grp, first)) & np.logical_or.reduceat(own, first)
    keep = np.repeat(meets, np.diff(np.append(first, len(g))))
    return row[keep], step[keep], own[keep]


def _meeting(one: DataFrame, hot: DataFrame, threshold: float) -> DataFrame:
    """(gram, step, node, group, own): texts that share a shingle of their prefixes with a text of another group and of a size near enough.

    ``one``: node, group, step, grams; ``hot``: gram, the most common ones. Those are counted before any exchange, and exchanged only if texts of several groups
    have them; the others are exchanged once.
    """
    grams = one.select("node", "group", "step", F.explode("grams").alias("gram"))
    hot = F.broadcast(hot)  # COMMON rows at most
    crowd = grams.join(hot, "gram")
    sides = F.explode(F.array(*[F.struct((F.col("step") - k).alias("step"), F.lit(k == 0).alias("own")) for k in (0, 1)]))
    crowd = crowd.select("gram", "node", "group", sides.alias("s")).select("gram", "s.step", "node", "group", "s.own")
    apart = crowd.groupBy("gram", "step").agg(F.min("group").alias("a"), F.max("group").alias("z"), F.max("own").alias("any")).where("a < z and any").select("gram", "step")
    crowd = crowd.join(apart, ["gram", "step"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def out(gram: np.ndarray, node: np.ndarray, group: np.ndarray, step: np.ndarray) -> pa.RecordBatch:
            row, at, own = _cells(gram, step, group)
            return pa.RecordBatch.from_arrays([pa.array(gram[row]), pa.array(at.astype(np.int32)), pa.array(node[row]), pa.array(group[row]), pa.array(own)], names=["gram", "step", "node", "group", "own"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            cut = int(np.searchsorted(now[0], now[0][-1]))  # rows of the last shingle wait for the next batch
            if cut:
                yield out(*[x[:cut] for x in now])
            held = [x[cut:] for x in now]
        if held is not None:
            yield out(*held)

    rest = grams.join(hot, "gram", "left_anti").select("gram", "node", "group", "step").repartition("gram").sortWithinPartitions("gram")
    return crowd.unionByName(rest.mapInArrow(run, "gram long, step int, node long, group long, own boolean"))


def _loose_links(cells: DataFrame, one: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join the texts of different groups that meet in a cell and that sizes and parities leave open.

    ``cells``: gram, step, node, group, own; ``one``: node, size, level, bits, half. In a cell of more than ``CELL`` texts those of its largest group
    meet the others, in blocks, but not each other.
    """
    lead = ["gram", "step"]
    big = durable(cells.groupBy(*lead).count().where(F.col("count") > CELL).select(*lead))
    n_big = big.count()
    plain = cells.withColumn("block", F.lit(0).cast("long"))
    if n_big:
        big = F.broadcast(big) if n_big <= 50_000 else big
        plain = plain.join(big, lead, "left_anti")
        large = cells.join(big, lead)
        parts = large.groupBy(*lead, "group").count().groupBy(*lead).agg(F.max(F.struct("count", "group")).alias("m"), F.sum("count").alias("n"))
        parts = parts.select(*lead, F.col("m.group").alias("main"), F.ceil((F.col("n") - F.col("m.count")) / (CELL // 2)).alias("ub"), F.ceil(F.col("m.count") / (CELL // 2)).alias("mb"))
        large = large.join(F.broadcast(parts) if n_big <= 50_000 else parts, lead).withColumn("out", F.col("group") != F.col("main"))
        mine = F.when(F.col("out"), F.pmod(F.xxhash64("node", F.lit(7)), F.col("ub"))).otherwise(F.col("ub") + F.pmod(F.xxhash64("node", F.lit(7)), F.col("mb")))
        large = large.withColumn("mine", mine)
        meets = F.transform(F.sequence(F.lit(0).cast("long"), F.when(F.col("out"), F.col("ub") + F.col("mb")).otherwise(F.col("ub")) - 1), lambda k: F.least(k, "mine") * (F.col("ub") + F.col("mb")) + F.greatest(k, "mine"))
        plain = plain.unionByName(large.withColumn("block", F.explode(meets)).select(plain.columns))
    # parities come last: they are wider than a shingle
    steps_ = np.arange(-1, 200)
    levels = F.array(*[F.lit(int(x)) for x in _level(steps_, threshold)])
    at = F.element_at(levels, F.col("step") + 2)
    met = plain.withColumn("cell", F.xxhash64(*lead)).drop("gram").join(one.select("node", "size", "level", "bits", "half"), "node").withColumn("at", at)
    met = met.withColumn("bits", F.when(F.col("level") == F.col("at"), F.col("bits")).otherwise(F.col("half")))
    dealt = met.select("node", "cell", "block", F.col("at").alias("level"), "size", "own", "group", "bits")
    dealt = dealt.repartition("cell", "block").sortWithinPartitions("level", "cell", "block")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def out(t: pa.Table) -> Iterator[pa.RecordBatch]:
            node, cell, block, level, size = [t.column(k).to_numpy() for k in range(5)]
            own, group = t.column(5).to_numpy().astype(bool), t.column(6).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(level[1:] != level[:-1]) + 1, [len(level)]])
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                flat = pc.list_flatten(t.column(7).slice(x, y - x)).to_numpy().view(np.uint64)
                new = np.flatnonzero((cell[x + 1 : y] != cell[x : y - 1]) | (block[x + 1 : y] != block[x : y - 1])) + 1
                bounds = np.concatenate([[0], new, [y - x]])
                a, b = maybe_similar_in_cells(flat.reshape(y - x, -1), size[x:y].astype(np.int64), own[x:y], group[x:y], np.repeat(bounds[1:], np.diff(bounds)), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(node[x:y][a]), pa.array(node[x:y][b])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now])
            cell, block = now.column(1).to_numpy(), now.column(2).to_numpy()
            cut = int(np.argmax((cell == cell[-1]) & (block == block[-1])))  # rows of the last cell wait for the next batch
            if cut:
                yield from out(now.slice(0, cut))
            held = now.slice(cut)
        if held is not None:
            yield from out(held)

    return dealt.mapInArrow(run, "a long, b long")


def _whole_hashes(texts: pa.Array) -> np.ndarray:
    """64-bit hashes of the whole sequences of words (0: no words)."""
    whole, off = shingle_hashes(texts, 1 << 40, 43)
    out = np.zeros(len(texts), np.uint64)
    out[np.diff(off) > 0] = whole
    return out


def similar_in_group(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Links that join the sets whose Jaccard similarity is ``threshold`` or more: a spanning forest, as index pairs."""
    size = np.array([len(s) for s in sets])
    if not size.sum():
        return []
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    _, code = np.unique(flat, return_inverse=True)
    start = np.searchsorted(code, np.arange(code[-1] + 2))
    mine = np.argsort(owner, kind="stable")
    codes, at = code[mine], np.concatenate([[0], np.cumsum(size)])
    parent, out = np.arange(len(sets)), []
    for i in range(len(sets)):
        own = codes[at[i] : at[i + 1]]
        n = start[own + 1] - start[own]
        if n.sum() == len(own):
            continue
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        both = np.bincount(owner[np.repeat(start[own], n) + step], minlength=len(sets))
        near = np.flatnonzero(both >= threshold * (size + size[i] - both) - 1e-9)
        for j in near[near > i].tolist():
            p, q = find(parent, i), find(parent, j)
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((i, j))
    return out


def _few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _once(rows: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """``rows`` (k0, k1 and others) with one row of each key of ``repeated``; which one is left open."""
    if repeated is None:
        return rows
    return rows.join(repeated, ["k0", "k1"], "left_anti").unionByName(rows.join(repeated, ["k0", "k1"], "left_semi").dropDuplicates(["k0", "k1"]))


def _blocked(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links inside each (loose, block) of ``sets``: loose, block, node, hs."""

    def verify(t: pa.Table) -> pa.Table:
        node = t.column("node").to_numpy()
        found = similar_in_group([np.asarray(x.values) for x in t.column("hs").combine_chunks()] if t.num_rows > 1 else [], threshold)
        if t.num_rows > BLOCK // 8:  # idle workers outlive the stage: they keep nothing of a large group
            release()
        return pa.table({"a": pa.array([int(node[i]) for i, _ in found], pa.int64()), "b": pa.array([int(node[j]) for _, j in found], pa.int64())})

    return sets.select("loose", "block", "node", "hs").groupBy("loose", "block").applyInArrow(verify, "a long, b long")


def _large_links(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join all similar texts of groups of any size; ``sets``: loose, node, hs.

    All of a group meet its pivots, one row each. A part is what these links join; pairs inside the group's largest part need no more looking at,
    so the texts outside it meet each other and all the others in blocks, and the largest part's texts don't meet among themselves.
    """
    nodes = durable(sets.select("loose", "node"))
    found, outside = None, nodes
    for k in range(ROUNDS):
        rank = F.row_number().over(Window.partitionBy("loose").orderBy(F.xxhash64("node", F.lit(k)), "node"))
        drawn = durable(outside.withColumn("r", rank).where(F.col("r") <= PIVOTS).select("loose", F.col("node").alias("pivot")))
        pivots = durable(drawn.join(sets.select(F.col("node").alias("pivot"), F.col("hs").alias("ps")), "pivot"))
        size = pivots.agg(F.coalesce(F.sum(F.size("ps")), F.lit(0)).alias("n")).first().n
        pivots = F.broadcast(pivots) if size <= BROADCAST_SHINGLES else pivots
        both = F.size(F.array_intersect("hs", "ps"))
        near = sets.join(pivots, "loose").where((F.col("node") != F.col("pivot")) & (both >= threshold * (F.size("hs") + F.size("ps") - both) - 1e-9)).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        found = durable(near if found is None else found.unionAll(near))
        labelled = durable(nodes.join(components(found), "node", "left").select("loose", "node", F.coalesce("root", "node").alias("part")))
        parts = labelled.groupBy("loose", "part").count()
        main = durable(parts.groupBy("loose").agg(F.max(F.struct("count", "part")).alias("m"), F.sum("count").alias("n")).select("loose", F.col("m.part").alias("main"), F.col("m.count").alias("inside"), (F.col("n") - F.col("m.count")).alias("u")).where("u > 0"))
        placed = labelled.join(_few(main), "loose").withColumn("out", F.col("part") != F.col("main"))
        outside = durable(placed.where("out").select("loose", "node"))
        if not outside.count():
            return found
    blocks = lambda n: F.ceil(F.col(n) / (BLOCK // 2)).cast("int")
    own = F.when(F.col("out"), F.pmod(F.xxhash64("node"), F.col("ub"))).otherwise(F.col("ub") + F.pmod(F.xxhash64("node"), F.col("mb"))).cast("int")
    placed = placed.withColumns({"ub": blocks("u"), "mb": blocks("inside")}).withColumn("mine", own)
    meets = F.transform(F.sequence(F.lit(0), F.when(F.col("out"), F.col("ub") + F.col("mb")).otherwise(F.col("ub")) - 1), lambda k: F.least(k, "mine") * (F.col("ub") + F.col("mb")) + F.greatest(k, "mine"))
    dealt = placed.select("loose", "node", F.explode(meets).alias("block")).join(sets.select("node", "hs"), "node")
    return found.unionAll(_blocked(dealt, threshold))


def verified(docs: DataFrame, candidates: DataFrame, nodes: DataFrame, repeated: DataFrame | None, *, width: int, threshold: float) -> DataFrame:
    """(a, b): links between texts as similar as ``threshold``, which join all such texts of each component of ``candidates`` (a, b).

    ``docs``: k0, k1, text; ``nodes``: node, k0, k1. Candidates' texts are read again and shingled; a group of more than ``BLOCK`` goes through pivots.
    """
    loose = components(candidates).withColumnRenamed("root", "loose")
    members = durable(nodes.join(loose, "node").select("node", "k0", "k1", "loose"))
    chosen = _once(docs.join(_few(members), ["k0", "k1"]), repeated).select("node", "loose", "text")

    @tidy
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in steps(texts, STEP):
                h, off = distinct_in_groups(*shingle_hashes(texts.slice(a, b - a), width))
                sets = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), sets], names=["node", "loose", "hs"])

    sets = chosen.mapInArrow(shingle, "node long, loose long, hs array<long>")
    large = durable(members.groupBy("loose").count().where(F.col("count") > BLOCK).select("loose"))
    if not large.count():
        return durable(_blocked(sets.withColumn("block", F.lit(0)), threshold))
    sets, large = durable(sets), _few(large)
    small = sets.join(large, "loose", "left_anti").withColumn("block", F.lit(0))
    return durable(_blocked(small, threshold).unionAll(_large_links(sets.join(large, "loose", "left_semi"), threshold)))


def near_copies(docs: DataFrame, *, width: int = 5, threshold: float = 0.8, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k0, k1, root, stays, repeated): the distinct rows of ``docs`` that have a copy or near copy, by the key of their id and text (``common.row_key``).

    Texts of one sequence of words (A-Z lower-cased, split at ASCII white space) are copies. Others are near copies if the sets of
    their ``width``-word shingles have a Jaccard similarity of ``threshold`` or more; groups are closed under that. ``root`` names
    the group, and of its rows that of the smallest ``id_col`` stays (null last, then the smaller key). ``repeated``: rows of one id and text occur
    several times. Texts without words, null ones too, are left alone, each a document of its own. Long texts are compared whole. Other columns are not
    read. An empty table gives an empty result.

    Which pairs are found doesn't depend on ``radius``: SimHash settles pairs within it, the prefix filter finds all the others. ``docs`` may be
    split and ordered in another way each time it is read, as long as it gives the same rows.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed = named.select(*row_key("id", "text"), "id", "text")

    @tidy
    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near copies")
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in steps(texts, STEP):
                yield pa.RecordBatch.from_arrays([pa.array(distinct_in_groups(*shingle_hashes(texts.slice(a, b - a), width))[0].view(np.int64))], names=["h"])

    every_nth = max(1, docs.count() // SAMPLE_TEXTS)
    often = keyed.where(F.pmod(F.col("k0"), F.lit(every_nth)) == 0).select("text").mapInArrow(drawn, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    with small_batches(docs.sparkSession):
        drawn_often = often.orderBy(F.desc("n"), "h").limit(COMMON).collect()
    common = np.sort(np.array([r.h for r in drawn_often], np.int64).view(np.uint64))
    hot = docs.sparkSession.createDataFrame([(r.h,) for r in drawn_often if r.n >= HOT], "gram long")

    @tidy
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near copies")
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in steps(texts, STEP):
                some = texts.slice(a, b - a)
                h, off = shingle_hashes(some, width)
                fp, again = bit_majorities(h, off), group_sums(h, off)  # the sums: 64 bits more that equal texts share
                h, off = distinct_in_groups(h, off)
                size = np.diff(off)
                step = _bucket(size, threshold)
                level, below = _level(step, threshold), _level(step - 1, threshold)
                lists = [pa.ListArray.from_arrays(pa.array(e.astype(np.int32)), pa.array(x.view(np.int64))) for x, e in (_prefixes(h, off, threshold, common), _parities(h, off, level), _parities(h, off, np.where(below < level, below, -1)))]
                marks = [pa.array(x.view(np.int64)) for x in (_whole_hashes(some), again, fp)] + [pa.array(x.astype(np.int32)) for x in (size, step, level)] + lists
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(a, b - a) for k in range(4)] + marks, names=["at", "k0", "k1", "id", "whole", "again", "fp", "size", "step", "level", "grams", "bits", "half"])

    schema = "at long, k0 long, k1 long, id long, whole long, again long, fp long, size int, step int, level int, grams array<long>, bits array<long>, half array<long>"
    # numbered here once: the numbers are laid down with the marks
    marked = durable(keyed.select(F.monotonically_increasing_id().alias("at"), "k0", "k1", "id", "text").mapInArrow(mark, schema).where("whole <> 0"))
    rows = marked.select("at", "k0", "k1", "id", "whole", "again")
    twice = durable(rows.groupBy("k0", "k1").count().where("count > 1").select("k0", "k1"))
    repeated = _few(twice) if twice.count() else None
    texts_ = durable(rows.groupBy("whole", "again").agg(F.min("at").alias("node")))
    # copies of a text stay out
    copies = durable(rows.join(texts_, ["whole", "again"]).where("at <> node").select(F.col("at").alias("copy")))
    one = marked.join(_few(copies), F.col("at") == F.col("copy"), "left_anti").withColumnRenamed("at", "node")
    nodes, check = one.select("node", "k0", "k1"), {"width": width, "threshold": threshold}
    # SimHash: equal fingerprints, and fingerprints within the radius, by one text of each
    heads = durable(one.groupBy("fp").agg(F.min("node").alias("head"), F.count("*").alias("n")))
    same = one.join(heads.where("n > 1"), "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    apart = links(heads.select("fp"), radius=radius)
    apart = apart.join(heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a").join(heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    first = verified(keyed, same.unionAll(apart), nodes, repeated, **check)
    settled = durable(components(first).withColumnRenamed("root", "group"))
    # the rest: shingles of prefixes that texts of different groups have
    one = one.join(_few(settled), "node", "left").withColumn("group", F.coalesce("group", "node"))
    cells = durable(_meeting(one.select("node", "group", "step", "grams"), hot, threshold))
    second = verified(keyed, _loose_links(cells, one, threshold), nodes, repeated, **check)
    near = components(first.unionAll(second))
    named_ = texts_.join(near, "node", "left").select("whole", "again", F.coalesce("root", "node").alias("root"))
    every = rows.join(named_, ["whole", "again"]).groupBy("k0", "k1", "id", "root").agg(F.count("*").alias("n"))
    leads = durable(every.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k0", "k1")).alias("f"), F.sum("n").alias("all")).where("all > 1").select("root", F.col("f.k0").alias("f0"), F.col("f.k1").alias("f1")))
    return every.join(_few(leads), "root").select("k0", "k1", "root", ((F.col("k0") == F.col("f0")) & (F.col("k1") == F.col("f1"))).alias("stays"), (F.col("n") > 1).alias("repeated"))


def without_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs``, all their columns as they are, without those for which ``near_copies`` keeps another row.

    Of rows of equal id and text one stays, whichever; the rest of their columns may differ.
    """
    found = durable(near_copies(docs, id_col=id_col, text_col=text_col, **options).where("repeated or not stays"))
    a, b, id_, text = fresh(docs, "key a", "key b", "id", "text")
    keyed = docs.withColumns({id_: F.col(id_col).cast("long"), text: F.col(text_col).cast("string")})
    keyed = keyed.withColumns(dict(zip((a, b), row_key(id_, text), strict=True))).drop(id_, text)
    names = {"k0": a, "k1": b}
    out = keyed.join(_few(found.where("not stays").select(*names).withColumnsRenamed(names)), [a, b], "left_anti")
    many = found.where("stays").select(*names).withColumnsRenamed(names)
    if many.count():
        many = _few(many)
        out = out.join(many, [a, b], "left_anti").unionByName(out.join(many, [a, b], "left_semi").dropDuplicates([a, b]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
