"""Every harness query against its independent SQL oracle (DuckDB) at sf0.001."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry_mod  # noqa: E402
from oracle_check import compare_key, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="harness tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(entry_mod.oracle_sql()) >= set(entry_mod.QUERIES)


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    ok, n_spark, n_oracle, detail = compare_key(spark, con, name, SF)
    assert ok, (name, n_spark, n_oracle, detail)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert "avg_daily_return" in df.columns
    assert df.count() > 0
