import odd
import pytest

from strataframe.llm import plans


@pytest.fixture(scope="module")
def tables(spark, sf, tmp_path_factory):
    return {e: odd.write(spark, sf, str(tmp_path_factory.mktemp("odd")), e) for e in (False, True)}


@pytest.mark.parametrize("empty", [False, True])
@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_odd_tables(spark, tables, name, empty):
    rows = plans.QUERIES[name](spark, tables[empty]).collect()
    assert not (empty and rows and name != "p9_fill")


def test_large_keys_are_kept(spark, tables):
    for name in ("p8_ids", "p9_pack", "p10_stats"):
        assert odd.LARGE in {r.doc_id for r in plans.QUERIES[name](spark, tables[False]).collect()}
