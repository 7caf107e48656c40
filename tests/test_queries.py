"""Every core query with SQL gives the rows of its SQL on the smallest test tables."""

import glob
import os
from collections import Counter

import pytest

from catalink.plans import general, reference

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
QUERIES = {**reference.queries(), **general.queries()}
SQL = {**reference.oracle_sql(), **general.oracle_sql()}


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = [tuple(round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in df.collect()]
    if name not in SQL:
        return
    found = duck.sql(SQL[name])
    at = [found.columns.index(c) for c in columns]
    expected = [tuple(round(v, 6) if isinstance(v, float) else v for v in (r[i] for i in at)) for r in found.fetchall()]
    assert Counter(rows) == Counter(expected)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
