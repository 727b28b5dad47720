"""Every registered query against its DuckDB SQL on the shared sf0.01 tables."""

import os

import pytest

import __spark_entry__ as E
from eligo.plans.registry import QUERIES
from tools.oracle_check import canon, duck

SF = os.environ.get("ELIGO_ORACLE_SF", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_sql():
    """All of the library's own queries; a training-data operator may be beyond SQL."""
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows, s_cols = [tuple(r) for r in df.collect()], df.columns
    rel = con.sql(E.oracle_sql()[name])
    d_rows, d_cols = rel.fetchall(), rel.columns
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert canon(s_rows, s_cols) == canon(d_rows, d_cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.queries()["q_state_batch"](spark, "/root/testdata/sf0.001").columns
