"""Every registered query against its DuckDB oracle on the smallest tables."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_rows_only_queries_run(spark):
    for name in set(E.queries()) - set(E.oracle_sql()):
        assert E.queries()[name](spark, SF).count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 44 and df.count() == 5902
