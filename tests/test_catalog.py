"""Every query runs at the smallest size and equals its SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpusmill import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name not in catalog.ORACLE_SQL:
        assert len(got)
        return
    want = duck.sql(catalog.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(got) == len(want)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    for c in columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


def test_entry(spark):
    assert entry.entry(spark).columns == ["issue_type", "severity", "n", "first_line"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
