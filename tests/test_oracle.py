"""The correctness gate: every catalogue query equals its DuckDB oracle at sf0.01."""

import os
import sys

import pytest

from conftest import ROOT, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from skillstream.plans import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, queries()[name], oracle_sql()[name], SF01)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) == set(QUERIES) & set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["skill", "job_count"] and 0 < df.count() <= 10
