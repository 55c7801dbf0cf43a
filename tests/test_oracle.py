"""Every SQL-checked case must match its DuckDB oracle (row multiset, names)."""

import pytest

from driftwood.plans.registry import load_all, queries

CASES = load_all()
SQL_KEYS = sorted(k for k, c in CASES.items() if c.sql)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_matches_oracle(spark, duck, sf, key):
    from oracle_check import compare

    r = compare(spark, duck, key, queries()[key], CASES[key].sql, sf)
    assert r["ok"], r.get("detail")


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
