"""Every query with SQL equals it in DuckDB; the others run and give rows."""

import duckdb
import pytest

from tidemark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Nothing of this size repeats in the smallest tables.
MAY_BE_EMPTY = {"furniture_runs", "furniture_cuts", "stage_collisions"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    found = duck.execute(registry.SQL[name])
    columns = [d[0] for d in found.description]
    want = found.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert want or name in MAY_BE_EMPTY
    assert plain(df.collect(), df.columns) == plain(want, columns)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0
