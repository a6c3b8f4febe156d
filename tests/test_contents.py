"""Contents pages with numbers and titles on lines of their own, pages and checks, on small tables."""

import hashlib

import pytest

from strataframe.operators import contents, invariants, sections

PAGE = """# Other

1
NOT AN ENTRY ..... 1

#### CONTENTS

![x.png](assets/x.png)
Page 4 of  69
7
Acme Confidential
PUMP ........ 11
7.1

HOUSING ..... 13
7.1.1
7.1.2
COVER ....... 14 2
7.2
..... 15
LOST ........ 16
7.3
HOUSING ..... 17
8.2.1
ORPHAN ...... 18
9
PUMP ........ 19
9.1.4
SEAL ........ 20
9.1.5
SEAL ........ 21
# Body
9.2
AFTER ....... 22
"""


def test_numbers_and_titles(spark):
    df = spark.createDataFrame([("d", PAGE), ("e", "1\nNO HEADING .... 1"), ("n", None), ("z", "# Contents")], "doc_id string, text string")
    pairs = contents.number_title_pairs(df)
    got = [(r.number, r.title, r.depth) for r in pairs.orderBy("pos").collect()]
    assert got == [("7", "PUMP", 1), ("7.1", "HOUSING", 2), ("7.1.1", "COVER", 3), ("7.3", "HOUSING", 2), ("8.2.1", "ORPHAN", 3), ("9", "PUMP", 1), ("9.1.4", "SEAL", 3), ("9.1.5", "SEAL", 3)]
    tree = {r.number: (r.layer, r.path) for r in contents.contents_tree(pairs).collect()}
    assert tree == {"7": ("subsystem", "pump"), "7.1": ("part", "pump/housing"), "7.1.1": ("function", "pump/housing/cover"), "7.3": ("part", "pump/housing-2"), "9": ("subsystem", "pump-2"), "9.1.4": ("function", "pump-2/seal"), "9.1.5": ("function", "pump-2/seal-2")}
    paths = contents.contents_paths(contents.contents_tree(pairs))
    asked = spark.createDataFrame([("d", n) for n in ("7.1.9", "7.3", "9.9", "12")], "doc_id string, number string")
    assert {r.number: r.entry for r in sections.toc_rollup(asked, paths).collect()} == {"7.1.9": "7.1", "7.3": "7.3", "9.9": "9", "12": "root"}
    assert contents.contents_tree(pairs.limit(0)).count() == 0


def test_running_lines_are_left_out(spark):
    pages = spark.createDataFrame([("a", 1, "HEAD\none\nfoot "), ("a", 2, " HEAD\r\ntwo\nfoot"), ("b", 1, "\nHEAD\n"), ("a", 3, None)], "source string, page int, text string")
    got = {(r.source, r.page): r.text for r in sections.without_running_lines(pages, sections.running_lines(pages)).collect()}
    assert got == {("a", 1): "one", ("a", 2): "two", ("b", 1): "\nHEAD\n", ("a", 3): None}


def test_front_matter_and_one_heading_a_page(spark):
    e = spark.createDataFrame([("a", 5, 2, "x", 3), ("a", 6, 1, "y", 2), ("b", 1, 1, "z", 1), ("c", 1, 1, "w", None), ("c", 2, 1, "v", 0)], "doc_id string, ord int, level int, title string, page_start int")
    got = {tuple(r) for r in sections.with_front_matter(e).collect()}
    assert got == {("a", 5, 2, "x", 3), ("a", 6, 1, "y", 2), ("b", 1, 1, "z", 1), ("a", 4, 1, "Front matter", 1)}
    h = spark.createDataFrame([("a", 1, 2, "x"), ("a", 1, 1, "z"), ("a", 1, 1, "y"), ("a", 2, 3, "w")], "doc_id string, page int, level int, title string")
    assert {tuple(r) for r in sections.one_heading_per_page(h).collect()} == {("a", 1, 1, "y"), ("a", 2, 3, "w")}


@pytest.mark.parametrize("query", [sections.nest_by_level, sections.section_end_pages])
def test_levels_beyond_the_bound_raise(spark, query):
    rows = spark.createDataFrame([("a", 1, sections.MAX_LEVEL, 1, 9)], "doc_id string, ord int, level int, page_start int, n_pages int")
    with pytest.raises(Exception, match="level of"):
        query(rows).collect()


def test_assets(spark):
    def of(*names):
        return spark.createDataFrame([("d", n) for n in names], "doc_id string, rel_path string")

    got = {(r.rel_path, r.rule) for r in invariants.asset_closure(of("a", "b", "c", "a"), of("a", "x"), of("a", "b", "y", "x", None)).collect()}
    assert got == {("b", "not recorded"), ("c", "not recorded"), ("c", "no file"), ("y", "orphan file")}


def test_hashes_and_origins(spark):
    files = spark.createDataFrame([("p", b"one"), ("q", b"two")], "path string, content binary")
    good = hashlib.sha256(b"one").hexdigest()
    records = spark.createDataFrame([("p", good), ("q", good), ("r", good), ("p", None)], "path string, sha256 string")
    assert sorted((r.path, r.recorded == good, r.actual is None) for r in invariants.hash_truth(records, files).collect()) == [("p", False, False), ("q", True, False), ("r", True, True)]
    want = spark.createDataFrame([("s", "1"), ("s", "2"), ("t", None)], "slug string, source_sha256 string")
    assert [tuple(r) for r in invariants.missing_origins(want.limit(1), want).collect()] == [("s", "2")]


def test_violations_of_all_checks(spark):
    a = spark.createDataFrame([("d", "x", None), ("e", "y", 2)], "doc_id string, anchor string, n int")
    got = {tuple(r) for r in invariants.violations(H3=a, H10=a.select("doc_id")).collect()}
    assert got == {("H3", "d", "x "), ("H3", "e", "y 2"), ("H10", "d", ""), ("H10", "e", "")}
