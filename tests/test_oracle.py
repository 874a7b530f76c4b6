"""Every registered query against its DuckDB oracle (as the driver checks it)."""

import os

import pytest

from tests.oracle_compare import compare

SF = os.environ.get("LAKENORM_ORACLE_SF", "/root/testdata/sf0.001")


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "user_id", "event_type", "value", "k", "dt"]


def test_every_query_has_an_oracle_or_is_listed():
    from lakenorm.plans.registry import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)


def test_queries_match_oracle(spark):
    from lakenorm.plans.registry import QUERIES
    res = compare(spark, SF, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    assert not bad, bad
