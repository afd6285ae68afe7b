"""Small tables with the cases that every operator must stand: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "su", "ta", "vo") for b in ("ra", "den", "fol", "gim", "hus")]


#: Names that operators give to columns of their own.
CLASHES = (
    "at key size fp h id item mark words shard n x score y cell root node k0 k1 group gram hs loose block stays toxic toxic_score domain epoch n_tokens epochs last_key alloc tokens _hit _mark _score "
    "_toxic _key_a _key_b _id _text _at _gone _level_lang _level_domain _epochs _last _times _copy"
).split()


def prose(seed: int, n: int = 80) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(n))


def odd_rows() -> list[tuple]:
    base = prose(1)
    near = base.split()
    near[40] = "changed"
    rows = [
        (1, base, "en", "a1", 0), (2, base, "en", "a1", 0), (2, base, "en", "a1", 0), (3, " ".join(near), "de", "a2", 0), (4, None, None, None, None), (5, "", "en", "a3", 0),
        (6, "   \n\t ", "en", "a3", 0), (None, prose(2), "fr", "a2", 0), (None, None, None, None, None), (7, "one two", "en", "a4", 0), (8, "é ü 日本 ß", None, "a4", 0),
        (9, prose(3, 30_000), "en", "a1", 0), (10, "x" * 50_000, "en", "a1", 0), (11, "\n".join([prose(4, 8), prose(5, 8), prose(6, 8)] * 3), "es", "a1", 0), (12, "! ? . , ;", "en", "a5", 0),
    ]
    return rows + [(100 + i, prose(100 + i), ("en", "de")[i % 2], "a1", 0) for i in range(12)]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """Extra columns of names that operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in CLASHES})
