"""Every registered query against its DuckDB twin on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from folio.plans import catalog, oracle

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"id", "word", "rank", "freq"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, res.fetchall())


def test_every_query_has_an_oracle():
    """The optional training-text queries are tested against brute force in ``tests/llm``.

    Approximate search has no SQL: its recall is measured in ``test_cells.py``.
    """
    assert set(catalog.QUERIES) - {"knn_approx"} == set(oracle.SQL) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
