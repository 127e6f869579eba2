"""Every registered query of the library gives the rows of its SQL, on the smallest tables."""

import os

import pytest

from pulsegrid.plans import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    def one(x):
        if x is None or x != x:
            return "null"
        if isinstance(x, float):
            return f"{x + 0.0:.6f}"
        if isinstance(x, int) and not isinstance(x, bool):
            return f"{x:.6f}"
        return str(x)

    return sorted(tuple(one(x) for x in r) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.sql(f"create view {t} as select * from '{p}/*.parquet'" if os.path.isdir(p) else f"create view {t} as select * from '{p}'")
    return c


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    rows = [tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()]
    if name not in SQL:
        assert rows
        return
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    assert plain(rows) == plain([tuple(r[i] for i in order) for r in want.fetchall()])
