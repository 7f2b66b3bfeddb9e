"""Every query against its SQL in DuckDB, and those without SQL by their invariants."""

from pathlib import Path

import duckdb
import pytest

from winnowry.plans.queries import QUERIES, SQL


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, duck, name):
    found = QUERIES[name](spark, sf)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(found.columns) == sorted(names)
    assert rows(found.columns, found.collect()) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_same_twice(spark, sf, name):
    a, b = QUERIES[name](spark, sf), QUERIES[name](spark, sf)
    assert rows(a.columns, a.collect()) == rows(b.columns, b.collect())
    assert a.count() > 0
