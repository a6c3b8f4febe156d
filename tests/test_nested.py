import json

import pytest

from strataframe.operators import nested as N


def tree(*children, **kw):
    return {"node_id": "root", "title": "", "children": list(children), **kw}


def paths(kind, text):
    try:
        value = N.parse(text)
    except ValueError:
        return []
    return [(r[3], r[4]) for r in N.visit(kind, 1, value) if r[0] == "node"]


def test_positions_count_every_entry():
    t = tree({"title": "a"}, None, {"title": "b", "children": [None, {"title": "c"}]})
    assert paths("index_trees", json.dumps(t)) == [("1", None), ("1.1", "1"), ("1.3", "1"), ("1.3.2", "1.3")]


@pytest.mark.parametrize("children", [{"title": "x"}, json.dumps([{"title": "x"}]), json.dumps({"title": "x"}), [{"title": "x"}], {"0": {"title": "x"}}])
def test_children_in_other_forms(children):
    assert paths("index_trees", json.dumps({"node_id": "root", "children": children})) == [("1", None), ("1.1", "1")]


@pytest.mark.parametrize("children", [None, [], "not json", 5, ""])
def test_no_children(children):
    assert paths("index_trees", json.dumps({"node_id": "root", "children": children})) == [("1", None)]


def test_envelopes_and_categories():
    assert paths("index_trees", json.dumps({"doc_id": "d", "index": tree({"title": "a"}), "meta": {}})) == [("1", None), ("1.1", "1")]
    assert paths("index_trees", json.dumps({"x": 1})) == []
    assert paths("taxonomies", json.dumps({"categories": [{"slug": "a", "children": [{"slug": "b"}]}, {"slug": "c"}]})) == [("1", None), ("1.1", "1"), ("2", None)]


@pytest.mark.parametrize("text", [None, "", "{", '{"a": NaN}', "[1,]", '{"a" 1}', "nul"])
def test_invalid_texts_give_nothing(text):
    assert paths("index_trees", text) == []


def test_own_parser_agrees():
    for text in ('{"a": [1, 2.5e3, -0, "x\\n\\u00e9", true, null, {}], "b": {"c": []}}', "[]", '"s"', " 12 ", '[[[{"k":[{}]}]]]'):
        assert N._deep_loads(text) == json.loads(text)
    for text in ("", "[", "[1 2]", "{,}", '{"a":}', "[1,]", "{}{}", '{"a":1,}', "]", '[1}'):
        with pytest.raises(ValueError):
            N._deep_loads(text)


def test_very_deep_tree():
    deep = '{"node_id":"root","children":[' + '{"t":1,"children":[' * 30_000 + "]}" * 30_000 + "]}"
    value = N._deep_loads(deep)
    assert sum(1 for _ in N.visit("index_trees", 1, value)) == 30_001


def test_tables(spark, tmp_path):
    t = tree({"node_id": "n1", "title": "a", "level": 1, "assets": [{"kind": "image", "rel_path": "p", "page": 2, "alt": None}, None], "tables": [{"anchor": "t1", "rows": [["1", "mm"], [None, 2]]}]})
    rows = [("index_trees", 7, json.dumps(t)), ("index_trees", 8, None), ("taxonomies", 7, json.dumps({"categories": [{"slug": "s", "keywords": ["k", "k"]}]}))]
    tagged = N.flatten(spark.createDataFrame(rows, "record_kind string, record_id long, text string"))
    N.write_tables(tagged, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert N.typed(back, "node").count() == 3
    a = N.typed(back, "asset").collect()
    assert [(r.parent_path, r.rel_path, r.page, r.alt) for r in a] == [("1.1", "p", 2, None)]
    cells = sorted((r.ord, r.cells) for r in N.typed(back, "table_row").collect())
    assert cells == [(1, ["1", "mm"]), (2, [None, "2"])]
    assert N.typed(back, "entry").count() == 2


HOSTILE = [
    '{"node_id":"root","children":[{"title":"\\ud800 half"},{"title":"\\ud83d\\ude42"}]}',
    '{"node_id":"root","deep":' + "[" * 20_000 + "]" * 20_000 + ',"children":[{"title":"a"}]}',
    '{"node_id":"root","assets":[{"x":' + '{"y":' * 20_000 + "1" + "}" * 20_000 + '}],"children":[{"title":"b"}]}',
    '{"node_id":"root","tables":[{"rows":[[' + "[" * 20_000 + "]" * 20_000 + ']]}],"keywords":[' + "[" * 20_000 + "]" * 20_000 + '],"children":[{"title":"c"}]}',
    '{"node_id":"root","level":' + "9" * 6000 + ',"size":1e999,"children":[{"title":"d"}]}',
]


def test_no_record_ends_the_query(spark):
    rows = [("index_trees", i, t) for i, t in enumerate(HOSTILE)] + [("index_trees", 9, json.dumps(tree({"title": "e"})))]
    trees = N.flatten(spark.createDataFrame(rows, "record_kind string, record_id long, text string"))
    titles = {r.record_id: r.title for r in N.typed(trees, "node").filter("node_path = '1.1'").collect()}
    assert titles == {0: "\ufffd half", 1: "a", 2: "b", 3: "c", 4: "d", 9: "e"}
    assert N.typed(trees, "node").filter("title = '\U0001f642'").count() == 1
    assert N.typed(trees, "caught").count() == 0 and N.typed(trees, "table_row").count() == 1


def test_what_fails_is_caught(spark, monkeypatch):
    def broken(kind, number, value):
        yield ("node", kind, number, "1", None, 1, "{}")
        raise MemoryError("too much")

    monkeypatch.setattr(N, "visit", broken)
    got = list(N._emit(iter([__import__("pandas").DataFrame({"record_kind": ["k"], "record_id": [1], "text": ["{}"]})])))[0]
    assert list(got.tag) == ["node", "caught"] and "MemoryError" in got.payload[1]


def test_dumps_of_any_depth():
    value = {"a": [1, "x\n", None, {"b": []}, {}], "c": 2.5, "d": [[], [[1]], True]}
    assert json.loads(N.dumps(value)) == value
    for _ in range(20_000):
        value = {"n": [value, 1], "m": "é"}
    assert N._deep_loads(N.dumps(value))["n"][1] == 1


def test_records_are_parsed_once(spark, sf, monkeypatch):
    from strataframe.plans import problems

    problems.tagged(spark, sf)
    monkeypatch.setattr(N, "write_tables", lambda *_: pytest.fail("written again"))
    assert problems.tagged(spark, sf).count() > 0


def test_empty(spark):
    assert N.flatten(spark.createDataFrame([], "record_kind string, record_id long, text string")).count() == 0
