"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from shopline.plans.catalog import QUERIES
from shopline.plans.oracle_sql import ORACLES
from tools.oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    """Those of the optional parts are held against theirs beside their own tests."""
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_mod.queries().items() and ORACLES.items() <= entry_mod.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLES[name])
    drows = rel.fetchall()
    dcols = [d[0] for d in rel.description]
    exact, close, msg = compare(rows, df.columns, drows, dcols)
    assert exact, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["family", "total_sales", "avg_sales", "pct_of_total"]
    assert df.count() > 0
