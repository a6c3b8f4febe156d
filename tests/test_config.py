import json

import pytest
from pyspark.sql import functions as F

from strataframe.operators import routing
from strataframe.sources import config, sinks


def test_policy(tmp_path):
    p = tmp_path / "redaction.toml"
    assert config.policy(str(p)) is None
    with pytest.raises(config.ConfigError):
        config.policy(str(p), True)
    p.write_text("[redaction]\nenabled = true\n[[redaction.text]]\npattern = '[MH]\\d{6,}'\nreplacement = 'X'\n[redaction.logos]\nsha256 = ['a']\n")
    got = config.policy(str(p))
    assert got.enabled and got.rules == ((r"[MH]\d{6,}", "X"),) and got.logo_sha256 == ("a",)
    p.write_text("[[redaction.text]]\npattern = '['\n")
    with pytest.raises(config.ConfigError):
        config.policy(str(p))
    p.write_text("= broken")
    with pytest.raises(config.ConfigError):
        config.policy(str(p))


def test_trees(tmp_path, spark):
    one = {"version": 1, "source_prd": "P", "categories": [{"slug": "a", "title": "A", "keywords": ["k"], "linked_specs": ["M1*"]}]}
    two = config.upgraded(one)
    assert two["categories"][0]["layer"] == "system" and config.upgraded(two) is two and config.tree_problems(two) == []
    path = str(tmp_path / "t.json")
    config.save_tree(two, path)
    assert config.load_tree(path) == two
    bad = {"version": 2, "categories": [{"slug": "a", "layer": "system", "children": [{"slug": "", "layer": "part"}, {"slug": "", "layer": "odd"}]}, {"slug": "a", "layer": "system"}]}
    assert len(config.tree_problems(bad)) == 5
    with pytest.raises(config.ConfigError):
        config.save_tree(bad, path)
    assert json.load(open(path)) == two
    two["categories"][0]["children"] = [{"slug": "b", "layer": "subsystem", "keywords": ["x"]}]
    _, words, _ = config.rows_of(spark, two)
    assert [tuple(r) for r in words.collect()] == [(1, "a", "k"), (2, "a/b", "x")]


def test_canonical_json(spark):
    df = spark.createDataFrame([('{"b": [1, {"z": "é"}], "a": null}',), (None,)], "t string")
    got = [r[0] for r in df.select(config.canonical_json(F.col("t"))).collect()]
    assert got == ['{\n  "a": null,\n  "b": [\n    1,\n    {\n      "z": "é"\n    }\n  ]\n}\n', None]


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("d", '<a id="sec-0001"></a>\n# T\nsee [x](../kb/d/main.md#sec-0002)')], "doc_id string, text string")
    sinks.export_files(sinks.vault_files(docs), str(tmp_path / "v"))
    assert (tmp_path / "v" / "d.md").read_text() == '<a id="sec-0001"></a>\n# T\n^sec-0001\nsee [x](#^sec-0002)'
    sinks.export_files(docs.select(F.lit("d.md").alias("path"), F.lit("new").alias("text")), str(tmp_path / "v"), True)
    assert (tmp_path / "v" / "d.md").read_text() != "new"
    with pytest.raises(Exception, match="leaves"):
        sinks.export_files(docs.select(F.lit("../x").alias("path"), F.lit("").alias("text")), str(tmp_path / "v"))
    pages = spark.createDataFrame([("hw", "B", "hw/b.md", ["d2", "d1", "d1"]), ("hw", "A", "A", [])], "domain string, title string, path string, sources array<string>")
    assert sinks.catalog(pages).first().text == "## hw\n\n- [[A]]\n- [[hw/b|B]] - sources: d1, d2\n"
    t = spark.createDataFrame([("s", "T")], "slug string, title string")
    e = spark.createDataFrame([("s", 2, "d", "b"), ("s", 1, "d", "a")], "slug string, ev_no int, doc_id string, anchor string")
    assert json.loads(sinks.index_json(t, e).first().json)["evidence"][0]["anchor"] == "a"
    assert sinks.page_files(spark.createDataFrame([("s", "m", "c")], "slug string, markdown string, category string")).first().path == "c/s.md"


def test_owners(spark):
    docs = spark.createDataFrame([("M1 Speaker Bracket PES",), ("M2 Thermal",), ("M3 none",)], "doc_id string")
    sub = spark.createDataFrame([("audio", "bracket", "Speaker bracket", None), ("audio", "boot", "Boot", None), ("thermal", "pad", "Pad", "*thermal*")], "system string, subsystem string, title string, glob string")
    sys_ = spark.createDataFrame([("audio", "*speaker*"), ("thermal", "*")], "system string, glob string")
    assert {tuple(r) for r in routing.spec_owners(docs, sub, sys_).collect()} == {("M1 Speaker Bracket PES", "audio", "bracket"), ("M2 Thermal", "thermal", "pad")}
