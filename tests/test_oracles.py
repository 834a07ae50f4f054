"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_support import compare

ORACLES = entry.oracle_sql()


def test_every_query_is_registered_with_a_callable():
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    assert all(callable(f) for f in qs.values())


def test_entry_runs_on_smoke_tables(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["subject_id", "hadm_id"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, name, SF_SMALL, entry.queries(), ORACLES)
    assert res["rows_match"], res
    assert res["columns_match"], res
    assert res["hash_match"] or res["close_match"], res
