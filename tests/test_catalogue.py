"""Every query with SQL gives DuckDB's rows."""

import duckdb
import pytest

from sluice import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows(spark, duck, small, name):
    df = catalogue.queries()[name](spark, small)
    got = sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    found = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    assert sorted(names) == sorted(df.columns)
    assert got == sorted(str(tuple(r[i] for i in order)) for r in found.fetchall())
    assert got


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_gives_rows(spark, small, name):
    assert not catalogue.queries()[name](spark, small).isEmpty()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns
