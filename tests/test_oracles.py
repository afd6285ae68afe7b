"""Every registered query against its SQL on the smallest tables, and the invariants of those without SQL."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from loomtext.plans.registry import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(v):
    return None if pd.isna(v) else float(v) if isinstance(v, float) else str(v)


def rows(frame):
    return sorted((tuple(str(plain(v)) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, duck, name):
    mine, sql = QUERIES[name](spark, sf).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(mine.columns) == sorted(sql.columns)
    assert rows(mine) == rows(sql)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
