"""Every query runs on the smallest data; those with SQL give what the SQL gives."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if not (n[0] == "p" and n[1].isdigit())]


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return c


def test_registry():
    from corpusforge import catalog

    assert len(NAMES) > 80 and set(entry.oracle_sql()) <= set(entry.queries())
    assert len(catalog.covered()) > 110 and all(set(v) <= set(catalog.QUERIES) for v in catalog.covered().values())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    rows = entry.queries()[name](spark, DATA)
    got = rows.toPandas()
    assert len(got) > 0
    if name in entry.oracle_sql():
        want = con.execute(entry.oracle_sql()[name]).df()
        assert sorted(want.columns) == sorted(got.columns)
        flat = lambda d: sorted(str([round(float(v), 6) if isinstance(v, float) else str(v) for v in r]) for r in d[sorted(d.columns)].itertuples(index=False))
        assert flat(got) == flat(want)
