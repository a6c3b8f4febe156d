"""Queries that do the whole job, on small tables made for it."""

import hashlib
import re

from strataframe.operators import routing, sections
from strataframe.plans import all_queries, page_queries

SECTIONS = "doc_id string, node_id string, parent_node_id string, ord int, depth int, level int, title string, anchor string, page_start int, page_end int, is_leaf boolean"


def node(doc, k, depth, title, parent="root", leaf=False):
    return (doc, f"n{k:03d}", parent, k, depth, depth, title, f"sec-{k:04d}", 1, 1, leaf)


def written(spark, folder, rows):
    spark.createDataFrame(rows, SECTIONS).write.parquet(f"{folder}/sections.parquet")
    return str(folder)


def test_prompts_number_all_evidence(spark, tmp_path):
    # the answer follows from the prompt, so the title of the last section changes the page
    one, two = ([node("d", k, 1, f"T{k}" if k < 60 else last, leaf=True) for k in range(1, 61)] for last in ("x", "y"))
    hashes = [page_queries.wiki_pages(spark, written(spark, tmp_path / str(i), rows)).first().markdown_sha256 for i, rows in enumerate((one, two))]
    assert hashes[0] != hashes[1]
    evidence = spark.createDataFrame([("s", k, f"T{k}") for k in range(1, 61)], "slug string, ev_no int, section_title string")
    assert page_queries._numbered(evidence).first().user == "\n".join(f"[{k}] T{k}" for k in range(1, 61))


def excerpt_of(text, anchor):
    """The surveyed operator's rule for one anchor."""
    start = text.find(f'<a id="{anchor}"></a>') + len(f'<a id="{anchor}"></a>')
    start += text[start : start + 1] == "\n"
    stop = re.compile(r'<a id="sec-\d+"></a>').search(text, start)
    body = text[start : stop.start() if stop else len(text)].rstrip()
    return body if len(body) <= 1500 else body[:1499].rstrip() + "…"


def test_every_section_has_its_body(spark, tmp_path):
    long, edge = "é" * 1400 + " " * 200 + "x", "y" * 1500
    text = f'before<a id="sec-0003"></a>\n\na <a id="tbl-0001"></a> b \x1f\n<a id="sec-0004"></a>{long}<a id="sec-0007"></a>\n{edge}\n<a id="sec-0009"></a>'
    rows = [(1, text), (2, None), (3, "none"), (4, '<a id="sec-0001"></a>\nfirst　\n<a id="sec-0002"></a> last')]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.anchor): (r.n_chars, r.body_sha256) for r in all_queries()["section_body"](spark, str(tmp_path)).collect()}
    want = {(k, a): excerpt_of(t, a) for k, t in rows if t for a in re.findall(r'<a id="(sec-\d+)"></a>', t)}
    assert got == {k: (len(b), hashlib.sha256(b.encode()).hexdigest()) for k, b in want.items()}
    assert len(got) == 6


def test_contents_of_odd_pages_count(spark, tmp_path):
    text = "1 One ..... 2\n1.1 Sub ..... 3\n3 Three ..... 5\n"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.number, r.entry) for r in all_queries()["toc_rollup"](spark, str(tmp_path)).collect()}
    assert got == {("1.1", "1.1"), ("1.1.1", "1.1"), ("3.1", "3")}


def test_numbers_without_entry_go_to_the_root(spark):
    asked = spark.createDataFrame([("d", n) for n in ("2", "2.1", "1.10", "11", "3.1.4")] + [("e", "1")], "doc_id string, number string")
    toc = spark.createDataFrame([("d", "1"), ("d", "1.1"), ("d", "3.1")], "doc_id string, number string")
    got = {(r.doc_id, r.number): r.entry for r in sections.toc_rollup(asked, toc).collect()}
    assert got == {("d", "2"): "root", ("d", "2.1"): "root", ("d", "1.10"): "1", ("d", "11"): "root", ("d", "3.1.4"): "3.1", ("e", "1"): "root"}


def test_functions_of_odd_positions_have_their_path(spark, tmp_path):
    thermal = [node("M1 Thermal PES", 1, 1, "Part"), *(node("M1 Thermal PES", k, 2, t, "n001") for k, t in ((2, "Even"), (3, "Odd"), (4, " ")))]
    got = {r.node_id: r.path for r in all_queries()["spec_section_map"](spark, written(spark, tmp_path, thermal + [node("other", 1, 1, "Part")])).collect()}
    assert got == {"n001": "thermal/pads/part", "n002": "thermal/pads/part/even", "n003": "thermal/pads/part/odd"}


def test_unknown_functions_fall_back_to_their_part(spark):
    rows = spark.createDataFrame([node("d", 1, 1, "Part"), node("d", 2, 2, "Known", "n001"), node("d", 3, 2, "New", "n001"), node("d", 4, 1, "Elsewhere"), node("d", 5, 2, "Known", "n004")], SECTIONS)
    owners = spark.createDataFrame([("d", "s", "u")], "doc_id string, system string, subsystem string")
    parts = spark.createDataFrame([("s", "u", "part", "known")], "system string, subsystem string, part string, function string")
    got = {r.node_id: r.path for r in routing.spec_sections(rows, owners, parts).collect()}
    assert got == {"n001": "s/u/part", "n002": "s/u/part/known", "n003": "s/u/part"}


def test_trees_have_all_nodes_of_four_layers(spark, tmp_path):
    own, spec, more = "M0900001 Platform PES", "M1 Thermal PES", "M2 Thermal PES"
    rows = [node(own, 1, 1, "Thermal"), node(own, 2, 2, "Zinc", "n001"), node(own, 3, 2, "Air", "n001"), node(own, 4, 2, " ", "n001"), node(own, 5, 1, "THERMAL"), node(own, 6, 2, "Last", "n005")]
    rows += [node(spec, 1, 1, "Fan"), node(spec, 2, 2, "Speed", "n001"), node(spec, 3, 2, "Noise", "n001"), node(more, 1, 1, "FAN"), node(more, 2, 2, "SPEED", "n001"), node(more, 3, 2, "speed", "n001")]
    got = all_queries()["taxonomy_v2"](spark, written(spark, tmp_path, rows)).collect()
    tree = {(r.layer, r.path): (r.slug, r.title) for r in got if r.tree == own}
    assert len(got) == len({(r.tree, r.path) for r in got})
    assert {p: t for (k, p), (_, t) in tree.items() if k == "subsystem" and p.startswith("thermal/")} == {"thermal/zinc": "Zinc", "thermal/air": "Air", "thermal/last": "Last", "thermal/pads": "Thermal pad"}
    assert tree["system", "thermal"] == ("thermal", "THERMAL") and tree["system", "audio"] == ("audio", "audio")
    assert {p: t for (k, p), t in tree.items() if k in ("part", "function")} == {"thermal/pads/fan": ("fan", "Fan"), "thermal/pads/fan/speed": ("speed", "SPEED"), "thermal/pads/fan/noise": ("noise", "Noise")}
    assert {(r.layer, r.path) for r in got if r.tree == spec} == {("system", "fan"), ("subsystem", "fan/speed"), ("subsystem", "fan/noise")}
    assert all(p.rpartition("/")[0] in {q for _, q in tree} for _, p in tree if "/" in p)
