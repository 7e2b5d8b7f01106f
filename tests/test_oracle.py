"""Every query of the catalogue equals its DuckDB SQL on sf0.001.

The two queries that boost 300 rounds are held against the same SQL with a
few rounds in test_quality_model.
"""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_util import compare, duck
from postlake.plans.catalog import ORACLE, QUERIES

ELSEWHERE = {"m6_boosted", "m10_run_log"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - ELSEWHERE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "vai_bombar" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())
