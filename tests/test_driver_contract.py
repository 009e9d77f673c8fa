"""Driver contract: every registered query equals its DuckDB oracle (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
# the corpus queries are tested in their own folder
QUERIES = {k: v for k, v in E.queries().items() if k in E.standins.queries()}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for tb in E.standins.TABLES:
        c.execute(f"CREATE VIEW {tb} AS SELECT * FROM '{SF}/{tb}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["ip_office", "application_number", "application_date", "registration_date"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    assert len(set(cols)) == len(cols)
    res = con.execute(ORACLES[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows) == digest(ocols, orows)
