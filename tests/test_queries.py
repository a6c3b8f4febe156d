"""Every registered query runs; those with SQL give its rows."""

import pytest
from oracle import same

from strataframe.plans import all_oracles, all_queries

QUERIES, ORACLE = all_queries(), all_oracles()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    got, want = same(spark, sf, QUERIES[name], ORACLE[name])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert len(df.columns) == len(set(df.columns))
    df.collect()


def test_sql_names_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
