import os

import duckdb
import pytest

from sieveyard.llm.queries import ORACLE_SQL, QUERIES

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DIR}/documents.parquet'")
    want = con.execute(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, DIR).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and sorted(got[columns].values.tolist()) == sorted(want[columns].values.tolist())


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0
