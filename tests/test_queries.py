"""Every query with SQL gives what DuckDB gives on the driver's smallest tables."""

import os

import duckdb
import pytest

from sieveyard.plans.registry import ORACLE_SQL, QUERIES

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DIR).toPandas()
    want = duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(str(r) for r in df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None).values.tolist())
    assert rows(got) == rows(want)
