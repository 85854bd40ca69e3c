"""SQL reconciliation: every registered query against its DuckDB oracle on
the sf0.001 tables (order-insensitive, column names sorted)."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerflow.plans import catalog
from scripts.oracle_check import TABLES, rows_of
from tests.conftest import SF_SMALL

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_a_callable():
    qs = catalog.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) - len(ORACLES) <= 3  # edit-distance pairs and components: brute-force tests


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got, gcols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[name])
    want, wcols = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert gcols == wcols
    assert got == want
