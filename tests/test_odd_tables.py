import odd
import pytest

from strataframe.plans import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def tables(spark, sf, tmp_path_factory):
    return {e: odd.write(spark, sf, str(tmp_path_factory.mktemp("odd")), e) for e in (False, True)}


@pytest.mark.parametrize("empty", [False, True])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_tables(spark, tables, name, empty):
    rows = QUERIES[name](spark, tables[empty]).collect()
    if empty and name.startswith("p"):
        assert not rows


def test_large_keys_are_kept(spark, tables):

    assert odd.LARGE in {r.record_id for r in QUERIES["p7_nodes"](spark, tables[False]).collect()}
    assert odd.LARGE in {r.atom_no for r in QUERIES["module_classify"](spark, tables[False]).collect()}
