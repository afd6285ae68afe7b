"""Audit of how filters interact: survivors, losses and Shapley shares of each filter, for each part of a corpus and each order of the filters.

DataFrame functions alone. A document's failures are one bit each. Per part, the counts of documents by their set of failures give a
removal polynomial: with ``x_f`` the chance that filter f is applied, the documents removed are

    R(x) = sum over failure sets m of n(m) * (1 - product over f in m of (1 - x_f)) = sum over T of c(T) * x^T,   c(T) = -(-1)^|T| * sum over m that contain T of n(m),

which is linear in each ``x_f``. At a corner (each filter on or off) it says how many documents a set of filters removes; its partial derivative along the
diagonal, integrated from 0 to 1, is a filter's Shapley share: ``sum over T with f of c(T) / |T|``, exact in whole numbers once scaled by the number of orders.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

#: Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> dict[str, Column]:
    """The four filters that look at a text alone, by their letters; true where a text fails. ``text`` must not be null."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    return {
        "A": F.size(words) < 50,
        "B": F.lit(100) * F.size(F.array_distinct(words)) < F.lit(65) * F.size(words),
        "C": F.lit(100).cast("long") * (F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))) > F.lit(5).cast("long") * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask, n): rows of the same id, part and failures are counted together; bit k of ``mask`` is the k-th letter of ABCDE.

    E, a text that some smaller id has too, is told from the smallest id of each text (by its 256-bit hash). Groups of any size are
    reduced to counts and minima before they are exchanged, and met by (text, id), which no group of copies shares.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    bits = [F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, fails in enumerate(text_failures(F.col("text")).values())]
    base = base.select("id", "part", F.unhex(F.sha2("text", 256)).alias("h"), reduce(Column.__add__, bits).alias("mask"))
    rows = durable(base.groupBy("id", "h", "part", "mask").agg(F.count("*").alias("n")))
    first = rows.where(F.col("id").isNotNull()).groupBy("h").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    later = rows.join(first, ["h", "id"], "left").withColumn("mask", F.col("mask") + F.when(F.col("first").isNotNull() | F.col("id").isNull(), 0).otherwise(16))
    return later.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))


def mask_counts(masks: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents by their set of failures, and of them those labelled quality 1 and toxic 1."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long"))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(one("quality").alias("q"), one("toxic").alias("t"))
    marked = masks.join(known.where("q + t > 0"), "id", "left")
    counts = {"n": F.col("n"), "good": F.col("n") * F.coalesce("q", F.lit(0)), "toxic": F.col("n") * F.coalesce("t", F.lit(0))}
    return marked.groupBy("part", "mask").agg(*[F.sum(v).alias(k) for k, v in counts.items()])


def removal_polynomial(sets: Column, count: str, filters: int) -> Column:
    """Coefficients c(T) of the removal polynomial as an array, T from 0 to 2^filters - 1 (c(0) = 0). ``sets``: an array of structs with ``mask`` and ``count``."""
    covering = lambda t: F.aggregate(sets, F.lit(0).cast("long"), lambda acc, s: acc + F.when(s["mask"].bitwiseAND(t) == t, s[count]).otherwise(0))
    sign = lambda t: F.when(F.bit_count(t) % 2 == 1, 1).otherwise(-1)
    return F.transform(F.sequence(F.lit(0), F.lit((1 << filters) - 1)), lambda t: F.when(t == 0, F.lit(0).cast("long")).otherwise(sign(t) * covering(t)))


def removed_at(polynomial: Column, filters: int) -> Column:
    """The polynomial at every corner: how many documents each set of filters removes, as an array by the set's bits."""
    terms = F.sequence(F.lit(0), F.lit((1 << filters) - 1))
    at = lambda s: F.aggregate(terms, F.lit(0).cast("long"), lambda acc, t: acc + F.when(t.bitwiseAND(s) == t, F.get(polynomial, t)).otherwise(0))
    return F.transform(terms, at)


def shapley_shares(polynomial: Column, filters: int) -> Column:
    """Each filter's Shapley share times the number of orders: the integral of its partial derivative along the diagonal is the sum of c(T) / |T| over T that hold it.

    The number of orders is a multiple of every |T|, so the rationals stay whole numbers.
    """
    scale = F.array(*[F.lit(math.factorial(filters) // k).cast("long") for k in range(1, filters + 1)])
    terms = F.sequence(F.lit(1), F.lit((1 << filters) - 1))
    term = lambda t: F.get(polynomial, t) * F.element_at(scale, F.bit_count(t))
    share = lambda f: F.aggregate(terms, F.lit(0).cast("long"), lambda acc, t: acc + F.when(F.getbit(t, f) == 1, term(t)).otherwise(0))
    return F.transform(F.sequence(F.lit(0), F.lit(filters - 1)), share)


def filter_audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): one row per part, order of the filters ABCDE and step.

    A: under 50 words; B: 100 * distinct words < 65 * words; C: 100 * capitals A-Z > 5 * code points; D: holds one of ``#$%&*|``; E: identical to the text of
    any smaller id, table-wide, removed or not. Per step's filter: documents kept after it, removed by it, failing it but removed earlier, failing it alone, removed by it with quality 1 and
    with toxic 1, and its removals summed over all orders.

    A null text is the empty text (fails A only, and E if a smaller id has it), a null part the empty string. A row without an id is nobody's copy and makes no copies. Rows that
    repeat an id count each; only a smaller id makes a copy, so equal rows of one id don't fail E by each other. Labels count by id, once however often they are
    given; other values and nulls are no label. Long texts are read whole. An empty table has no parts and gives an empty result. Other columns are not read.
    """
    masks = failure_masks(docs, id_col=id_col, text_col=text_col, part_col=part_col)
    return audit_steps(mask_counts(masks, labels, id_col=id_col), "ABCDE")


def audit_steps(counts: DataFrame, letters: str) -> DataFrame:
    """The rows of ``filter_audit`` from (part, mask, n, good, toxic), for filters named by ``letters``."""
    k = len(letters)
    # 2^k failure sets a part at most; each becomes a term of the part's polynomials
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets"), F.sum("n").alias("total"))
    for name in ("n", "good", "toxic"):
        parts = parts.withColumn(f"p_{name}", removal_polynomial(F.col("sets"), name, k))
    parts = parts.select("part", "total", *[removed_at(F.col(f"p_{name}"), k).alias(name) for name in ("n", "good", "toxic")], shapley_shares(F.col("p_n"), k).alias("shares"))
    orders = F.array(*[F.lit("".join(o)) for o in permutations(letters)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    earlier = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    before = reduce(Column.__add__, [F.when(F.contains(earlier, F.lit(f)), 1 << b).otherwise(0) for b, f in enumerate(letters)])
    steps = steps.withColumns({"f": F.instr(F.lit(letters), F.substring("filter_order", F.col("step"), F.lit(1))) - 1, "before": before})
    own, every = F.call_function("shiftleft", F.lit(1), F.col("f")), (1 << k) - 1
    steps = steps.withColumns({"own": own, "upto": F.col("before").bitwiseOR(own)})
    at = lambda name, corner: F.get(F.col(name), corner)
    here = lambda name: at(name, F.col("upto")) - at(name, F.col("before"))
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - at("n", F.col("upto"))).alias("kept"),
        here("n").alias("removed"),
        (at("n", F.col("own")) - here("n")).alias("redundant"),
        (at("n", F.lit(every)) - at("n", F.lit(every) - F.col("own"))).alias("unique_fails"),
        here("good").alias("good_lost"),
        here("toxic").alias("toxic_lost"),
        F.get("shares", F.col("f")).alias("shapley"),
    )
