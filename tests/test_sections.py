import random

from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.operators import invariants, sections, topics


def one(spark, column, *values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(column(F.col("x"))).collect()]


def brute_chunks(body, most):
    if len(body) <= most:
        return [body]
    units = []
    for p in body.split("\n\n"):
        if len(p) <= most:
            units.append(p)
            continue
        for line in p.split("\n"):
            units += [line] if len(line) <= most else [line[i : i + most] for i in range(0, len(line), most)]
    out, now = [], ""
    for u in units:
        joined = u if not now else f"{now}\n\n{u}"
        if len(joined) <= most:
            now = joined
        else:
            out += [now] if now else []
            now = u
    return out + ([now] if now else [])


def test_chunks_equal_brute_force(spark):
    random.seed(1)
    texts = ["", "x" * 25, "a\n\nb", *("".join(random.choices("ab \n", k=random.randint(0, 90))) for _ in range(60)), "\n\n" * 20, "日本語の文章です" * 5]
    got = one(spark, lambda c: sections.chunks(c, 10), *texts)
    assert got == [brute_chunks(t, 10) for t in texts]


def test_nesting_follows_levels(spark):
    random.seed(2)
    levels = [0] + [random.randint(0, 5) for _ in range(80)]
    rows = spark.createDataFrame([("d", i, k) for i, k in enumerate(levels)], "doc_id string, ord int, level int")
    got = {r.ord: r.parent_ord for r in sections.nest_by_level(rows).collect()}
    for i, k in enumerate(levels):
        assert got[i] == next((j for j in range(i - 1, -1, -1) if levels[j] < k), None)


def test_segments_and_categories(spark):
    text = 'x\n<a id="sec-0001"></a>\n# One\n\n<a id="sec-0002"></a>\n## Two\n\nbody <a id="tbl-0001"></a> more\n<a id="sec-0003"></a>\nno heading\n<a id="sec-0004"></a>\n# Three\nlast'
    df = spark.createDataFrame([("d", text), ("e", None), ("f", "plain"), ("g", "")], "doc_id string, text string")
    got = [(r.anchor, r.title, r.level, r.category, r.body) for r in sections.content_sections(df).orderBy("anchor").collect()]
    assert got == [("sec-0002", "Two", 2, "One", 'body <a id="tbl-0001"></a> more'), ("sec-0004", "Three", 1, "Three", "last")]


def test_running_lines(spark):
    rows = [("s", i, f"HEAD\nHEAD\nline {i}\n") for i in range(4)] + [("t", 1, "HEAD")]
    df = spark.createDataFrame(rows, "source string, page int, text string")
    assert [tuple(r) for r in sections.running_lines(df).collect()] == [("s", "HEAD", 4)]


def test_toc(spark):
    df = spark.createDataFrame([("d", "Contents\n1 Intro ..... 3\n1.2 Wide part .... 4\n 2 x\n")], "doc_id string, text string")
    toc = sections.toc_lines(df)
    assert [(r.number, r.title, r.depth, r.page) for r in toc.collect()] == [("1", "Intro", 1, 3), ("1.2", "Wide part", 2, 4)]
    asked = spark.createDataFrame([("d", "1.2.9"), ("d", "1.3"), ("d", "7.1"), ("d", "1")], "doc_id string, number string")
    assert {(r.number, r.entry) for r in sections.toc_rollup(asked, toc).collect()} == {("1.2.9", "1.2"), ("1.3", "1"), ("7.1", "root"), ("1", "1")}


def test_components_of_long_chains(spark):
    n = 200
    nodes = spark.createDataFrame([(f"{i:04d}",) for i in range(n + 2)], "node string")
    edges = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(n - 1)], "a string, b string")
    got = {r.node: r.component for r in topics.components(nodes, edges).collect()}
    assert {got[f"{i:04d}"] for i in range(n)} == {"0000"}
    assert got["0200"] == "0200" and got["0201"] == "0201"


def test_topics(spark):
    rows = [("d1", "s1", "battery thermal limits"), ("d2", "s1", "battery cell thermal"), ("d1", "s2", "power supply"), ("d3", "s1", "1.4"), ("d3", "s2", "the of")]
    df = spark.createDataFrame(rows, "doc_id string, anchor string, title string")
    got = {r.title: (r.n_evidence, r.n_docs) for r in topics.discover_topics(df).collect()}
    assert got["battery"] == (2, 2) and got["power"] == (1, 1) and got["the of"] == (1, 1)
    assert {r.title for r in topics.discover_topics(df, min_evidence=2, skip_numeric=True).collect()} == {"battery"}


def test_text_functions(spark):
    assert one(spark, X.tokens, "The Thermal-pad of A 12 散热垫", None) == [["12", "pad", "thermal", "散热垫"], None]
    assert one(spark, lambda c: X.slug(c, "topic"), " Dock  Connector! ", "***", "a-b--c") == ["dock-connector", "topic", "a-b-c"]
    assert one(spark, X.is_numeric_title, "1.4", "", "Compliance") == [True, True, False]
    assert one(spark, X.normal_markdown, "﻿a\r\nb\r\n\r\n", "") == ["a\nb\n", "\n"]
    assert one(spark, X.natural_key, "10_b", "2_a", "Misc") == sorted(one(spark, X.natural_key, "10_b", "2_a", "Misc"), key=lambda k: k)[::-1][1:2] + one(spark, X.natural_key, "2_a", "Misc")
    assert one(spark, X.suffix, "a/b.PDF", "a.b/c", ".x") == [".pdf", "", ""]
    assert one(spark, lambda c: X.section_body(c, "sec-1"), '<a id="sec-1"></a>\nabc  \n<a id="sec-2"></a>x', "none", '<a id="sec-1"></a>' + "y" * 2000) == ["abc", "", "y" * 1499 + "…"]
    assert one(spark, X.json_list, 'So:\n```json\n[{"a":1}]\n```', "[1]", "none") == ['[{"a":1}]', "[1]", None]


def test_tables(spark):
    rows = [[["a", "b"], ["1"], ["x", "y", "z"]]]
    got = spark.createDataFrame([(r,) for r in rows], "x array<array<string>>").select(X.pipe_table(F.col("x"))).first()[0]
    assert got == "| a | b |\n| --- | --- |\n| 1 |  |\n| x | y |"


def test_tree_violations(spark):
    rows = [(1, "1", None, "a", "system"), (1, "1.1", "1", "b", "part"), (1, "1.2", "1", "c", "subsystem"), (1, "1.3", "1", "c", "subsystem"), (1, "2", None, "", "odd")]
    df = spark.createDataFrame(rows, "record_id long, node_path string, parent_path string, slug string, layer string")
    got = {(r.node_path, r.rule) for r in invariants.tree_violations(df).collect()}
    assert got == {("1.1", "wrong layer"), ("1.2", "duplicate slug"), ("1.3", "duplicate slug"), ("2", "empty slug"), ("2", "unknown layer")}
