"""Queries of the texts' problems: all run, those with SQL give its rows."""

import pytest
from oracle import same

from strataframe.llm import plans


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, sf, name):
    if name in plans.ORACLE:
        got, want = same(spark, sf, plans.QUERIES[name], plans.ORACLE[name])
        assert got == want
    else:
        df = plans.QUERIES[name](spark, sf)
        assert len(df.columns) == len(set(df.columns))
        df.collect()


def test_found_columns(spark, sf):
    want = {"p3_found": ["doc_id", "anchor"], "p4_found": ["doc_id", "anchor", "markup"], "p5_found": ["doc_id", "anchor", "noise"], "p6_found": ["doc_id", "anchor", "language"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "shape"]}
    for name, columns in want.items():
        df = plans.QUERIES[name](spark, sf)
        assert df.columns == columns
        assert df.count() == df.distinct().count()
