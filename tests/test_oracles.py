"""Every registered query equals its DuckDB statement on the smallest tables."""

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from tools.oracle_check import check

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def results(spark):
    return check(spark, SF_SMALL, NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(results, name):
    r = results[name]
    assert not r.get("error"), r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_match"], r


def test_every_query_has_an_oracle():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    missing = set(qs) - set(E.oracle_sql()) - set(E.LLM_QUERIES)  # those have tests of their own
    assert not missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 33
