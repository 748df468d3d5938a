"""Driver contract: entry smoke check and the oracle comparison at sf0.001."""

import os
import sys

import pytest

from tests.conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "lifetime_revenue" in df.columns


def test_every_query_has_oracle():
    import __spark_entry__ as E
    assert set(E.QUERIES) == set(E.ORACLE_SQL)
    assert set(E.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(__import__("__spark_entry__").QUERIES))
def test_oracle_matches_sf0001(spark, key):
    from oracle_check import compare
    res = compare(spark, SF001, [key])
    assert res[key]["ok"], res[key]
