"""Every query with an oracle gives the rows DuckDB gives, on the smallest tables."""
import duckdb
import pytest

from cohortloom.queries import ORACLES, QUERIES
from tools.check import TABLES, canon


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(name, spark, duck, sf):
    df = QUERIES[name](spark, sf)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == canon(columns, cur.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
