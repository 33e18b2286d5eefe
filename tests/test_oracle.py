"""Every catalogue query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from dispersa.plans.queries import QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, entry.queries()[key], entry.oracle_sql().get(key), SF)
    assert res["status"] in ("MATCH", "rows-only"), res


def test_every_catalogue_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns == ["round", "id"]
