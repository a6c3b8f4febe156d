"""Prompts, pages of shared sources, topics inside paths, on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from strataframe.operators import facts, pages, routing, topics


def test_prompts_of_sections(spark):
    df = spark.createDataFrame([("sec-1", 'A "b"', "x\ny\té"), ("sec-2", None, None)], "anchor string, title string, body string")
    m = pages.section_messages("Be brief.", "E:\n{evidence_content}\nEnd", F.col("anchor"), F.col("title"), F.col("body"))
    for r in df.select("anchor", "title", "body", m.alias("m")).collect():
        want = json.dumps([{"id": r.anchor, "type": "text", "section": r.title or "", "content": r.body or ""}], ensure_ascii=False, indent=2)
        assert [tuple(x) for x in r.m] == [("system", "Be brief."), ("user", f"E:\n{want}\nEnd")]


def test_numbered_evidence(spark):
    df = spark.createDataFrame([("s", k, "d", f"T{k}", " b" * 1000) for k in range(1, 31)] + [("t", 1, None, None, None)], "slug string, ev_no int, doc_id string, section_title string, body string")
    got = {r.slug: r.user for r in pages.numbered_evidence(df).collect()}
    parts = got["s"].split("\n\n")
    assert len(parts) == 30 and parts[9].startswith("[10] d / T10\nb b") and all(len(p.split("\n")[1]) == 1200 for p in parts)
    assert got["t"] == "[1]  / \n"


def test_pages_of_shared_sources(spark):
    rows = [("d1", "a", "a", "t1"), ("d1", "b", "b/c", "t2"), ("d1", "a", "a", "t1"), ("d2", "a", "a", "t1"), ("d2", "a", "a", "t3")]
    found = pages.candidates(spark.createDataFrame(rows, "key string, domain string, category_path string, slug string"))
    r = found.withColumn("m", pages.candidate_messages(found, "S")).collect()
    assert [(x.key, x.domains, x.links) for x in r] == [("d1", ["a", "b"], ["a/t1", "b/c/t2"])]
    assert r[0].m[1].content == "Shared source: d1\nConnected domains: a, b\nReferenced by topics: a/t1, b/c/t2"
    text = pages.entity_pages(found.withColumn("summary", F.lit(" All. "))).first().markdown
    assert text.endswith("---\n\n# d1\n\nAll.\n\n## Appears in\n\n- [[a/t1|t1]]\n- [[b/c/t2|t2]]\n") and "  - domain/a\n  - domain/b\n  - domain/entity\n" in text


def test_topics_inside_paths_are_those_of_each_alone(spark):
    titles = ["battery thermal limits", "battery cell thermal", "hinge torque", "torque of hinge", "fan", "", "the of", "battery fan noise"]
    rows = [(f"d{i % 3}", f"s{i}", titles[i % len(titles)], ("p/a", "p/b", "q")[i % 3 if i % 5 else 0]) for i in range(48)]
    df = spark.createDataFrame(rows, "doc_id string, anchor string, title string, path string")
    got = sorted(tuple(r) for r in topics.topics_by_path(df, 0.7).collect())
    want = []
    for path in ("p/a", "p/b", "q"):
        alone = topics.discover_topics(df.filter(F.col("path") == path), 0.7).select("title", "n_evidence", "n_docs").collect()
        want += [(path, *r) for r in alone if r.title not in ("", "the of")]
    assert got == sorted(want)


def test_near_sets_are_all_pairs(spark):
    """The prefix filter misses no pair, at any threshold."""
    import itertools
    import random

    r = random.Random(6)
    words = [f"w{i}" for i in range(14)]
    sets = {" ".join(sorted(r.sample(words, min(len(words), 1 + int(r.expovariate(0.4)))))) for _ in range(70)}
    df = spark.createDataFrame([(x,) for x in sets], "tokens string")
    for most in (0.0, 0.2, 0.5, 0.85, 0.95):
        want = set()
        for a, b in itertools.combinations(sorted(sets), 2):
            x, y = set(a.split()), set(b.split())
            if x & y and 1 - len(x & y) / len(x | y) <= most:
                want.add((a, b))
        assert {(p.a, p.b) for p in topics.jaccard_pairs(df, most).collect()} == want


def test_paths_of_sections_come_before_specs(spark):
    e = spark.createDataFrame([("m1", "n1", "a1", "x"), ("m1", "n2", "a2", "x"), ("own", "n1", "a3", "x")], "doc_id string, node_id string, anchor string, title string")
    specs = spark.createDataFrame([(1, "s/u", "m*")], "ord int, slug string, glob string")
    words = spark.createDataFrame([(1, "w", "zzz")], "ord int, slug string, keyword string")
    heads = spark.createDataFrame([(1, "h", "top")], "ord int, slug string, heading string")
    nodes = spark.createDataFrame([("own", "n1", 1, 1, "Top")], "doc_id string, node_id string, ord int, depth int, title string")
    paths = spark.createDataFrame([("m1", "n1", "s/u/p/f"), ("own", "n1", "never")], "doc_id string, node_id string, path string")
    got = {r.anchor: r.slug for r in routing.route(e, specs, words, heads, nodes, "own", True, paths).collect()}
    assert got == {"a1": "s/u/p/f", "a2": "s/u", "a3": "h"}


@pytest.mark.parametrize(("text", "want"), [("0.876", 0.88), ("0.125", 0.12), (" 0.5 ", 0.5), ("high", 0.0), (None, 0.0), ("NaN", 0.0), ("1e-1", 0.1)])
def test_confidences_from_texts(spark, text, want):
    assert spark.createDataFrame([(text,)], "c string").select(facts.confidence(F.col("c"))).first()[0] == want


def test_rules_of_modules_are_data(spark):
    module, pending = facts.module_of(F.lit("Pump"), F.lit("flow"), F.lit("Water"), [("water", "Wet")], [("Moving", ("pump",))], "Rest")
    assert tuple(spark.range(1).select(module, pending).first()) == ("Wet", False)
    module, pending = facts.module_of(F.lit("Lamp"), F.lit("light"), F.lit(None).cast("string"), [], [], "Rest")
    assert tuple(spark.range(1).select(module, pending).first()) == ("Rest", True)
