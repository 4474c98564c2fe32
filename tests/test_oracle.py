"""Every query with a DuckDB twin gives the same rows on the smallest tables."""

import duckdb
import pytest

import check_oracle
from patio.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in check_oracle.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = check_oracle.rows_of(columns, result.fetchall())
    assert sorted(columns) == sorted(df.columns)
    assert check_oracle.rows_of(df.columns, df.collect()) == want
