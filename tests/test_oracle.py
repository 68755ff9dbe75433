"""Every query with SQL gives the rows that DuckDB gives on the smallest tables."""

import os

import duckdb
import pytest

from lumenmap.plans import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return int(v)
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) if not hasattr(r[i], "isoformat") else str(r[i]).split("+")[0] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLE_SQL:
        rel = duck.sql(ORACLE_SQL[name])
        assert sorted(rel.columns) == sorted(df.columns)
        want = rows_of(rel.columns, [tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r) for r in rel.fetchall()])
        assert got == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
