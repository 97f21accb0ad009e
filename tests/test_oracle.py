"""Every registered query against its DuckDB oracle on sf0.001 (same rules as the driver's check)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMOKE
from tools.check_oracle import TABLES, rows_of

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _dealt(name):
    """Training-data queries may be beyond SQL; those are tested against brute force elsewhere."""
    return name == "pipeline" or name[:2] == "op" and name[2].isdigit()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES) and set(QUERIES) - set(ORACLE) <= {q for q in QUERIES if _dealt(q)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMOKE)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert rows_of(srows, scols) == rows_of(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "p12m_avgrating" in df.columns
