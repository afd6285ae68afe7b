"""Mixing sources to target weights: budgets down a tree of domain, language and source, then seeded token prefixes.

DataFrame functions alone. Tokens are words between ASCII white space. A node can take its children's capacity, a leaf its
own tokens times ``max_epochs``. From the root down, each node's budget is shared among its children by weight; a child that can't
take its share is filled, and its shortage goes to its siblings. As a node is never given more than its whole subtree
can take, a shortage leaves a subtree, for the siblings of an ancestor, only when all of the subtree is full.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, fresh

#: Rows of one leaf for each bucket of its seeded order, and the most buckets of a leaf.
BUCKET_ROWS, MOST_BUCKETS_LOG2 = 1024, 16
#: Leaves up to which the plan is broadcast (about 100 bytes each); beyond it the plan is joined by a shuffle.
BROADCAST_LEAVES = 50_000


@dataclass(frozen=True)
class Level:
    """One level of the tree: its column, what the column is made of, and each node's whole-number weight."""

    name: str
    value: Column
    weight: Column


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0)).cast("long")


def share(children: DataFrame, parent: list[str], amount: Column) -> DataFrame:
    """``children`` (with ``cap`` and ``weight``) and each one's ``alloc`` of its parent's amount; whole tokens, rounded down.

    Water-filling without iteration: in ascending order of cap per weight, a child is full if its cap is no more than its share of
    what the children before it leave. A child of weight 0, or less, gets nothing.
    """
    by = Window.partitionBy(*parent)
    live = F.col("weight") > 0
    order = by.orderBy(F.when(live, F.col("cap") / F.col("weight")).asc_nulls_first(), F.col("cap"), *[F.col(c) for c in children.columns if c not in ("cap", "weight")])
    c = children.withColumn("weight", F.when(live, F.col("weight")).otherwise(0).cast("long")).withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0))
    c = c.withColumn("_amount", F.least(amount, F.sum("cap").over(by)))
    c = c.withColumn("_before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")).withColumn("_rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    # in decimals: the products exceed a long at large corpora
    d = lambda x: F.col(x).cast("decimal(19,0)")
    c = c.withColumn("_full", (F.col("weight") == 0) | (d("cap") * d("_rest") <= (d("_amount") - d("_before")) * d("weight")))
    c = c.withColumn("_left", F.col("_amount") - F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(by)).withColumn("_w", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(by))
    alloc = F.when(F.col("_full"), F.col("cap")).otherwise(F.expr("cast((cast(_left as decimal(19,0)) * cast(weight as decimal(19,0))) div cast(_w as decimal(19,0)) as long)"))
    return c.withColumn("alloc", alloc).drop("_amount", "_before", "_rest", "_full", "_left", "_w")


def budgets(leaves: DataFrame, levels: list[Level], budget: Column, max_epochs: int) -> DataFrame:
    """``leaves`` (level columns, tokens, n_docs) with ``alloc``. ``budget``: an expression over ``total``, the corpus' tokens."""
    names = [x.name for x in levels]
    nodes = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    # subtree capacities from the leaves up; a node of weight 0 has none
    tables = []
    for k in range(len(names), 0, -1):
        at = nodes.withColumn("weight", levels[k - 1].weight.cast("long")).withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0))
        tables.insert(0, at.select(*names[:k], "cap", "weight"))
        nodes = at.groupBy(*names[: k - 1]).agg(F.sum("cap").alias("cap"))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total")).select(budget.cast("long").alias("amount"))
    given = share(tables[0].join(F.broadcast(total)), [], F.col("amount")).select(names[0], "alloc")
    for k in range(1, len(names)):
        up = given.select(*names[:k], F.col("alloc").alias("amount"))
        given = share(tables[k].join(up, names[:k]), names[:k], F.col("amount")).select(*names[: k + 1], "alloc")
    return leaves.join(given, names)


def plan(docs: DataFrame, levels: list[Level], budget: Column, *, seed: int, max_epochs: int, id_col: str, text_col: str) -> DataFrame:
    """One row per leaf: level columns, n_docs, tokens, alloc, epochs (whole passes) and last_key.

    ``last_key`` ends the prefix of the pass after those: the largest key up to which the leaf's tokens fit what is left.
    """
    names = [x.name for x in levels]
    rows = durable(docs.select(*[x.value.alias(x.name) for x in levels], F.col(id_col).cast("string").alias("id"), n_tokens(F.col(text_col)).alias("n")))
    leaves = durable(rows.groupBy(*names).agg(F.sum("n").alias("tokens"), F.count("*").alias("n_docs")))
    b = budgets(leaves, levels, budget, max_epochs)
    full = F.when(F.col("tokens") > 0, F.expr("alloc div tokens")).otherwise(0)
    log2 = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n_docs") / BUCKET_ROWS)))
    b = b.withColumns({"epochs": full.cast("int"), "log2": F.least(log2, F.lit(MOST_BUCKETS_LOG2)).cast("int")}).withColumn("rest", F.col("alloc") - F.col("epochs") * F.col("tokens"))
    b = durable(b)
    # buckets of the seeded order, so that only one bucket of a leaf is ever put in order
    keyed = rows.join(_small(b.where("rest > 0").select(*names, "epochs", "log2", "rest")), names).withColumn("key", _key(seed, F.col("epochs"), F.col("id")))
    keyed = keyed.withColumn("bucket", F.expr("shiftright(cast(conv(substr(key, 1, 4), 16, 10) as int), 16 - log2)"))
    sums = keyed.groupBy(*names, "rest", "bucket").agg(F.sum("n").alias("s"))
    run = sums.withColumn("upto", F.sum("s").over(Window.partitionBy(*names).orderBy("bucket")))
    edge = run.where("upto > rest").groupBy(*names).agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("s")).alias("before")), "bucket").alias("e")).select(*names, "e.*")
    inside = keyed.join(_small(durable(edge)), [*names, "bucket"])
    cum = F.sum("n").over(Window.partitionBy(*names).orderBy("key"))
    upto = inside.withColumn("cum", F.col("before") + cum).where("cum <= rest").groupBy(*names).agg(F.max("key").alias("inner_key"))
    # without a row of the edge bucket, the prefix ends with the bucket before it
    ends = edge.join(upto, names, "left").select(*names, "bucket", "inner_key")
    b = b.join(ends, names, "left")
    start = F.expr("substr(concat(lpad(lower(hex(shiftleft(bucket, 16 - log2))), 4, '0'), repeat('0', 28)), 1, 32)")
    last = F.when(F.col("rest") <= 0, F.lit("")).when(F.col("bucket").isNull(), F.lit("g")).otherwise(F.coalesce("inner_key", start))
    return b.select(*names, "n_docs", "tokens", "alloc", "epochs", last.alias("last_key"))


def _key(seed: int, epoch: Column, row_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(row_id, F.lit("null"))))


def _small(plan_: DataFrame) -> DataFrame:
    return F.broadcast(plan_) if plan_.count() <= BROADCAST_LEAVES else plan_


def mix(docs: DataFrame, levels: list[Level], budget: Column, *, seed: int = 1, max_epochs: int = 1, id_col: str = "doc_id", text_col: str = "text", describe: bool = True) -> DataFrame:
    """Rows of ``docs``, with all their columns, as often as the mix takes them; adds the level columns, n_tokens, epoch if told to ``describe``.

    ``epoch`` counts a row's passes from 0. Columns of ``docs`` that bear an added column's name are replaced; without ``describe`` every column
    comes out as it is. A leaf's whole passes take every row; the pass after them takes the rows in ascending order of md5(seed:epoch:id) while the
    tokens fit, rows of one key (repeated ids) together or not at all. So a leaf falls short of its budget by less
    than the row, or rows of one id, that come next. Null values of a level are a node like any other ('unknown'); a null text has
    no tokens; a null id has the key of the text 'null'. An empty table gives an empty result.
    """
    levels = [Level(x.name, F.coalesce(x.value.cast("string"), F.lit("unknown")), x.weight) for x in levels]
    names = [x.name for x in levels]
    p = durable(plan(docs, levels, budget, seed=seed, max_epochs=max_epochs, id_col=id_col, text_col=text_col))
    mine = dict(zip([*names, "_epochs", "_last", "_times", "_copy"], fresh(docs, *[f"level {n}" for n in names], "epochs", "last", "times", "copy"), strict=True))
    out = docs.withColumns({mine[x.name]: x.value for x in levels})
    q = _small(p.select(*[F.col(n).alias(mine[n]) for n in names], F.col("epochs").alias(mine["_epochs"]), F.col("last_key").alias(mine["_last"])))
    out = out.join(q, [mine[n] for n in names])
    epochs, times = F.col(mine["_epochs"]), F.col(mine["_times"])
    more = (_key(seed, epochs, F.col(id_col).cast("string")) <= F.col(mine["_last"])).cast("int")
    out = out.withColumn(mine["_times"], epochs + more).where(times > 0)
    out = out.withColumn(mine["_copy"], F.explode(F.sequence(F.lit(0), times - 1)))
    if not describe:
        return out.select(*[F.col(f"`{c}`") for c in docs.columns])
    added = {n: F.col(mine[n]) for n in names} | {"n_tokens": n_tokens(F.col(text_col)), "epoch": F.col(mine["_copy"])}
    return out.withColumns(added).drop(*mine.values())
