"""Every registered query with oracle SQL matches DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare

from conftest import SF_SMALL

SQL_KEYS = sorted(E.oracle_sql())


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SQL_KEYS)
def test_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res["ok"], res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 2 + 1 + 36
    assert df.count() > 0
