"""Every registered query against its DuckDB oracle (or a run, for rows-only ones) on sf0.001."""

import pytest

from oracle_compare import compare, duck
from conftest import SF_SMALL
from __spark_entry__ import entry
from terrace.queries import ORACLES, QUERIES

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF_SMALL)
    assert r["status"] in ("match", "rows-only"), r
    assert r["rows"] > 0


def test_every_query_but_rows_only_has_oracle():
    rows_only = set(QUERIES) - set(ORACLES)
    assert rows_only == set()


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "o_totalprice" in df.columns
