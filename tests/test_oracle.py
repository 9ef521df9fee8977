"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import datetime
from pathlib import Path

import pytest

from newsweft.plans import registry

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone='UTC'")
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, datetime.date):
        return str(v)[:10]
    return round(v, 5) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, con, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    mine = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    cursor = con.execute(registry.oracle_sql()[name])
    theirs = [d[0] for d in cursor.description]
    assert columns == sorted(theirs)
    at = [theirs.index(c) for c in columns]
    assert mine == sorted(str([plain(r[i]) for i in at]) for r in cursor.fetchall())


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
