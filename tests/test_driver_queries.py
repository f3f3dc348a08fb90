"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracles import TABLES, digest

from conftest import SF_SMALL

from shoal.plans import driver_queries as DQ
from shoal.streaming import checks as SC

OWN = {**DQ.QUERIES, **SC.QUERIES}  # tests/llm checks those of its subpackage
BATCH = list(DQ.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.queries()) and set(OWN) == set(E.oracle_sql()) & set(OWN)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "mac" in df.columns and "event_date" in df.columns


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    orows = res.fetchall()
    ocols = [d[0] for d in res.description]
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
