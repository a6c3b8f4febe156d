import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataframe.operators import facts, routing, store


def t(n):
    return dt.datetime(2024, 1, n)


def test_upsert_and_status(spark):
    rows = [("a", t(1), "ok", "s1"), ("a", t(2), "failed", None), ("b", t(1), "ok", "s2"), ("a", t(2), "failed", None)]
    df = spark.createDataFrame(rows, "key string, loaded_at timestamp, status string, sha string")
    assert {(r.key, r.status, r.sha) for r in store.upserted(df, "key", ["loaded_at"]).collect()} == {("a", "failed", None), ("b", "ok", "s2")}
    assert {(r.key, r.status, r.sha) for r in store.status_merged(df, "key", "loaded_at", "status", ["sha"]).collect()} == {("a", "failed", "s1"), ("b", "ok", "s2")}
    assert store.upserted(df.limit(0), "key", ["loaded_at"]).count() == 0


def test_plan(spark):
    files = spark.createDataFrame([("a", "x.pdf", "1"), ("b", "y.pdf", "2"), ("c", "z.odd", "3"), ("d", "w.PDF", None)], "key string, source_path string, source_sha256 string")
    have = spark.createDataFrame([("a", "1", "ok"), ("b", "2", "failed"), ("d", None, "ok")], "key string, source_sha256 string, status string")
    kinds = spark.createDataFrame([(".pdf",)], "suffix string")
    got = {r.key: r.action for r in store.incremental_plan(files, have, kinds).collect()}
    assert got == {"a": "unchanged", "b": "extract", "c": "skipped", "d": "extract"}
    assert {r.action for r in store.incremental_plan(files, have, kinds, True, True).collect()} == {"dry_run", "skipped"}


def test_report(spark):
    df = spark.createDataFrame([("ok",), ("failed",), (None,)], "status string")
    r = store.run_report(df).first()
    assert (r.n, r.n_ok, r.n_failed, r.overall) == (3, 1, 1, "partial")


def test_modules_in_order(spark):
    rows = [("a", "hinge", "x", "appendix"), ("b", "wake circuit", "x", ""), ("c", "zz", "x", None), ("d", "battery cover", "x", "none")]
    df = spark.createDataFrame(rows, "k string, entity string, parameter string, category string")
    m, p = facts.module_of(F.col("entity"), F.col("parameter"), F.col("category"))
    assert [(r.m, r.p) for r in df.select(m.alias("m"), p.alias("p")).collect()] == [("Subsystems", False), ("State Machine", False), ("Subsystems", True), ("Mechanical", False)]


def test_edges(spark):
    e = spark.createDataFrame([(1, "d", "a", "b", "Affects ", "r", 0.9), (2, "d", "a", "b", "affects", None, 0.9), (3, "d", "a", "a", "affects", "r", 0.9), (4, "d", "a", "z", "affects", "r", 0.9), (5, "d", "a", "b", "odd", "r", 0.9), (6, "d", "b", "a", "depends_on", " ", None)], "edge_no long, doc_id string, source_id string, target_id string, relation string, evidence_ref string, confidence double")
    a = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "id string")
    got = {(r.edge_no, r.source_id, r.confidence, r.flag) for r in facts.valid_edges(e, a).collect()}
    assert got == {(1, "a", 0.9, ""), (6, "b", 0.0, facts.PENDING)}


def test_routes(spark):
    specs = spark.createDataFrame([(2, "two", "*x*"), (1, "one", "a?x")], "ord int, slug string, glob string")
    docs = spark.createDataFrame([("A.X",), ("bx",), ("none",)], "doc_id string")
    assert {(r.doc_id, r.slug) for r in routing.by_spec(docs, specs).collect()} == {("A.X", "one"), ("bx", "two")}
    words = spark.createDataFrame([(1, "one", "thermal pad"), (2, "two", "pad screw")], "ord int, slug string, keyword string")
    titles = spark.createDataFrame([("Pad",), ("pad screw",), ("other",)], "title string")
    assert {(r.title, r.slug, r.overlap) for r in routing.by_keywords(titles, words).collect()} == {("Pad", "one", 1), ("pad screw", "two", 2)}


def test_quotes(spark):
    df = spark.createDataFrame([("a  b", "x a\nb y"), ("", "x"), ("zz", "z z")], "q string, b string")
    assert [r[0] for r in df.select(facts.quote_found(F.col("q"), F.col("b"))).collect()] == [True, False, False]


def test_sources_are_converted_again_for_another_converter_or_policy(spark):
    files = spark.createDataFrame([(k, "s1") for k in "abcdefg"] + [("h", None)], "key string, source_sha256 string")
    rows = [("a", "s1", "v1", "p", "ok"), ("b", "s0", "v1", "p", "ok"), ("c", "s1", "v0", "p", "ok"), ("d", "s1", "v1", "q", "ok"), ("e", "s1", "v1", None, "ok"), ("f", "s1", "v1", "p", "failed"), ("h", None, "v1", "p", "ok")]
    m = spark.createDataFrame(rows, "key string, source_sha256 string, version string, policy_sha256 string, status string")
    assert {r.key for r in store.source_plan(files, m, "v1", "p").filter("action = 'unchanged'").collect()} == {"a"}
    assert {r.key for r in store.source_plan(files, m, "v1").filter("action = 'unchanged'").collect()} == {"e"}


def test_too_many_adapters_raise(spark):
    with pytest.raises(ValueError, match="adapters"):
        store.incremental_plan(spark.createDataFrame([("a", "x.pdf", "s")], "key string, source_path string, source_sha256 string"), spark.createDataFrame([], "key string, source_sha256 string, status string"), spark.range(store.MAX_ADAPTERS + 1).selectExpr("cast(id as string) as suffix"))
