"""Queries over section trees, section texts, topics and invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.operators import contents, invariants, nested, sections, store, topics
from strataframe.plans.problems import TREES, tagged
from strataframe.plans.text_queries import BODIES, DOCS, slug_sql, tokens_sql
from strataframe.plans.text_queries import _bodies as bodies
from strataframe.plans.text_queries import _docs as docs
from strataframe.tables import deliveries, read

CHUNK = 1500


def nodes(s: SparkSession, d: str) -> DataFrame:
    """Section nodes without deliveries."""
    c = ["doc_id", "node_id", "parent_node_id", "ord", "depth", "level", "title", "anchor", "page_start", "page_end", "is_leaf"]
    return read(s, d, "sections").select(*c).distinct()


def leaves(s: SparkSession, d: str) -> DataFrame:
    return sections.evidence_leaves(nodes(s, d)).select("doc_id", "node_id", "anchor", "title")


def evidence_leaves(s: SparkSession, d: str) -> DataFrame:
    return leaves(s, d)


def content_sections(s: SparkSession, d: str) -> DataFrame:
    return sections.content_sections(docs(s, d)).select("doc_id", "anchor", "title", "level", "category", X.sha(F.col("body")).alias("body_sha256"))


def section_body(s: SparkSession, d: str) -> DataFrame:
    """The excerpt of every section of every text."""
    b = X.excerpt(F.col("segment"))
    return sections.segments(docs(s, d)).select("doc_id", "pos", "anchor", F.length(b).alias("n_chars"), X.sha(b).alias("body_sha256"))


def next_anchor(s: SparkSession, d: str) -> DataFrame:
    return sections.next_anchors(sections.segments(docs(s, d)))


def chunk_body(s: SparkSession, d: str) -> DataFrame:
    rows = bodies(s, d).filter("body is not null").select("doc_id", "anchor", F.posexplode(sections.chunks(F.col("body"), CHUNK)).alias("chunk_no", "chunk"))
    return rows.select("doc_id", "anchor", "chunk_no", F.length("chunk").alias("n_chars"), X.sha(F.col("chunk")).alias("chunk_sha256"))


def nest_by_level(s: SparkSession, d: str) -> DataFrame:
    return sections.nest_by_level(nodes(s, d)).select("doc_id", "node_id", "ord", "parent_ord")


def section_end_page(s: SparkSession, d: str) -> DataFrame:
    n = nodes(s, d).filter("page_start is not null and level > 0")
    last = n.groupBy("doc_id").agg(F.max("page_end").alias("n_pages"))
    return sections.section_end_pages(n.join(last, "doc_id")).select("doc_id", "node_id", "page_start", "end_page")


def _pages(s: SparkSession, d: str) -> DataFrame:
    once = deliveries(s, d, "documents", ["doc_id"], ["source", "text"])
    return once.filter("text is not null and source is not null").select("source", F.col("doc_id").alias("page"), "text")


def running_lines(s: SparkSession, d: str) -> DataFrame:
    return sections.running_lines(_pages(s, d), 0.05)


def heading_inference(s: SparkSession, d: str) -> DataFrame:
    """Parts as the spans of brands' documents: the size is the font's, the price's last digit is bold."""
    p = read(s, d, "part")
    spans = p.select(F.col("p_brand").alias("doc_id"), (F.col("p_partkey") % 50).alias("page"), F.col("p_partkey").alias("pos"), (F.col("p_size") / 3.0).alias("size"), (F.col("p_partkey") % 7 == 0).alias("bold"), F.col("p_name").alias("text"))
    return sections.inferred_headings(spans).select("doc_id", "page", "level", "title")


def toc_parse(s: SparkSession, d: str) -> DataFrame:
    return sections.toc_lines(docs(s, d))


def toc_rollup(s: SparkSession, d: str) -> DataFrame:
    """Numbers one level below those of contents pages, led to the entry of their longest prefix."""
    toc = sections.toc_lines(docs(s, d))
    return sections.toc_rollup(toc.select("doc_id", F.concat("number", F.lit(".1")).alias("number")), toc)


def _contents(s: SparkSession, d: str) -> DataFrame:
    """Contents pages with numbers and titles on lines of their own, as some readers give them: lines
    that hold both are parted, under a heading and nine chapters."""
    chapters = "".join(f"{k}\nCHAPTER {k} ...... {k}\n" for k in range(1, 10))
    text = F.concat(F.lit("# Contents\n" + chapters), F.regexp_replace("text", r"(?m)^[ \t]*(\d+(?:\.\d+)*)[ \t]+(\S)", "$1\n$2"))
    return docs(s, d).filter(F.col("text").contains("....")).select("doc_id", text.alias("text"))


def toc_pairs(s: SparkSession, d: str) -> DataFrame:
    return contents.number_title_pairs(_contents(s, d))


def toc_tree(s: SparkSession, d: str) -> DataFrame:
    return contents.contents_tree(contents.number_title_pairs(_contents(s, d))).select("doc_id", "number", "layer", "title", "path")


def toc_section_map(s: SparkSession, d: str) -> DataFrame:
    """Numbers one level below the entries of contents pages, and the path that they belong to; the root's is empty."""
    pairs = contents.number_title_pairs(_contents(s, d))
    paths = contents.contents_paths(contents.contents_tree(pairs))
    asked = pairs.select("doc_id", F.concat("number", F.lit(".1")).alias("number")).distinct()
    led = sections.toc_rollup(asked, paths)
    hit = led.join(paths.select("doc_id", F.col("number").alias("entry"), "path"), ["doc_id", "entry"], "left")
    return hit.select("doc_id", "number", F.coalesce("path", F.lit("")).alias("path"))


def page_bodies(s: SparkSession, d: str) -> DataFrame:
    """Pages without the running lines of their document."""
    pages = _pages(s, d)
    found = sections.without_running_lines(pages, sections.running_lines(pages, 0.05))
    return found.select("source", "page", F.length("text").alias("n_chars"), X.sha(F.col("text")).alias("text_sha256"))


def outline_padding(s: SparkSession, d: str) -> DataFrame:
    return sections.with_front_matter(nodes(s, d).filter("level > 0"))


def page_headings(s: SparkSession, d: str) -> DataFrame:
    """One inferred heading a page."""
    return sections.one_heading_per_page(heading_inference(s, d))


def h18_missing_origins(s: SparkSession, d: str) -> DataFrame:
    """Sources behind each title's evidence that a page would not declare if it knew well extracted ones only."""
    m = read(s, d, "manifest").select(X.file_stem(F.col("source_path")).alias("doc_id"), "source_sha256", "status").distinct()
    e = leaves(s, d).join(m, "doc_id").select(X.slug(F.col("title"), "topic").alias("slug"), "source_sha256", "status")
    return invariants.missing_origins(e.filter("status = 'ok'"), e)


def all_violations(s: SparkSession, d: str) -> DataFrame:
    """All violations of the structural checks in one table, each once."""
    found = {"H3": h3_duplicate_anchors(s, d), "H4": h4_missing_anchors(s, d), "H9": h9_page_gaps(s, d), "H10": h10_untitled(s, d), "H14": wiki_verify(s, d)}
    return invariants.violations(**found).groupBy("invariant", "doc_id", "detail").agg(F.count("*").alias("n"))


def jaccard_pairs(s: SparkSession, d: str) -> DataFrame:
    return topics.jaccard_pairs(topics.token_sets(leaves(s, d))).select("a", "b", F.round("distance", 6).alias("distance"))


def topic_components(s: SparkSession, d: str) -> DataFrame:
    sets = topics.token_sets(leaves(s, d))
    return topics.components(sets.select(F.col("tokens").alias("node")), topics.jaccard_pairs(sets, 0.5)).select("node", "component")


def discover_topics(s: SparkSession, d: str) -> DataFrame:
    return topics.discover_topics(leaves(s, d), 0.5)


def discover_topics_filtered(s: SparkSession, d: str) -> DataFrame:
    return topics.discover_topics(leaves(s, d), 0.5, 2, True)


def slug_dedup(s: SparkSession, d: str) -> DataFrame:
    """Slugs of the titles of each document, numbered where they come again in document order."""
    n = nodes(s, d).filter("title is not null").withColumn("base", X.slug(F.col("title"), "section"))
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("doc_id", "base").orderBy("ord", "node_id"))
    return n.withColumn("k", k).select("doc_id", "node_id", F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat("base", F.lit("-"), "k")).alias("slug"))


def evidence_origins(s: SparkSession, d: str) -> DataFrame:
    """Hashes of the files that each title's evidence comes from."""
    m = read(s, d, "manifest").select(X.file_stem(F.col("source_path")).alias("doc_id"), "source_sha256").filter("source_sha256 is not null").distinct()
    e = leaves(s, d).join(m, "doc_id").select(X.slug(F.col("title"), "topic").alias("slug"), "source_sha256").distinct()
    return e.groupBy("slug").agg(F.count("*").alias("n_origins"), F.min("source_sha256").alias("first_origin"), F.max("source_sha256").alias("last_origin"))


def h3_duplicate_anchors(s: SparkSession, d: str) -> DataFrame:
    """Anchors that the pages of one source set more than once."""
    return invariants.duplicate_anchors(_pages(s, d).select(F.col("source").alias("doc_id"), "text"))


def h4_missing_anchors(s: SparkSession, d: str) -> DataFrame:
    return invariants.missing_anchors(leaves(s, d), bodies(s, d))


def h5_asset_closure(s: SparkSession, d: str) -> DataFrame:
    """Images that texts name against the records of section trees; the images of all texts are the files."""
    refs = bodies(s, d).select("doc_id", F.explode(F.regexp_extract_all("body", F.lit(r"!\[[^\]]*\]\(([^)\s]+)\)"), F.lit(1))).alias("rel_path"))
    owner = read(s, d, "index_trees").select("record_id", "doc_id").distinct()
    have = nested.typed(tagged(s, d).filter("record_kind = 'index_trees'"), "asset").join(owner, "record_id").select("doc_id", "rel_path")
    return invariants.asset_closure(refs, have, refs)


def _n_pages(s: SparkSession, d: str) -> DataFrame:
    return nodes(s, d).filter("node_id = 'root'").groupBy("doc_id").agg(F.max("page_end").alias("n_pages"))


def h9_page_gaps(s: SparkSession, d: str) -> DataFrame:
    return invariants.page_gaps(nodes(s, d).filter("node_id <> 'root'"), _n_pages(s, d))


def h9_page_bounds(s: SparkSession, d: str) -> DataFrame:
    return invariants.page_bounds(nodes(s, d), _n_pages(s, d)).select("doc_id", "node_id", "page_start", "page_end", "n_pages")


def h10_untitled(s: SparkSession, d: str) -> DataFrame:
    return invariants.untitled_documents(nodes(s, d).filter("level <= 1"))


def wiki_verify(s: SparkSession, d: str) -> DataFrame:
    """Evidence of all section trees against the anchors of the texts of their document's pages."""
    have = _pages(s, d).select(F.col("source").alias("doc_id"), F.explode(X.anchors(F.col("text"))).alias("anchor"))
    return invariants.evidence_anchors(leaves(s, d), have)


def dead_wikilinks(s: SparkSession, d: str) -> DataFrame:
    notes = nodes(s, d).select(F.col("title").alias("name")).filter("name is not null")
    return invariants.dead_wikilinks(bodies(s, d), notes)


def h21_validate(s: SparkSession, d: str) -> DataFrame:
    trees = tagged(s, d).filter("record_kind = 'taxonomies'")
    return invariants.tree_violations(nested.typed(trees, "node"))


def flatten_tree(s: SparkSession, d: str) -> DataFrame:
    trees = tagged(s, d).filter("record_kind = 'index_trees'")
    n = nested.typed(trees, "node")
    return n.select("record_id", "node_path", "parent_path", "node_id", "title", "level", F.size(F.split("node_path", r"\.")).alias("depth"))


def content_hash(s: SparkSession, d: str) -> DataFrame:
    """The hash of each section's text, of the names of its images and of its place."""
    b = bodies(s, d).withColumn("body", F.coalesce("body", F.lit("")))
    images = F.transform(F.regexp_extract_all("body", F.lit(r"!\[[^\]]*\]\(([^)\s]+)\)"), F.lit(1)), X.sha)
    index = F.concat(F.lit('{"anchor": '), X.json_string(F.col("anchor")), F.lit(', "title": '), X.json_string(F.col("title")), F.lit("}"))
    return b.select("doc_id", "anchor", F.size(images).alias("n_images"), store.content_hash(F.col("body"), images, index).alias("content_sha256"))


QUERIES = {f.__name__: f for f in (evidence_leaves, content_sections, section_body, next_anchor, chunk_body, nest_by_level, section_end_page, running_lines, heading_inference, toc_parse, toc_rollup, toc_pairs, toc_tree, toc_section_map, page_bodies, outline_padding, page_headings, h18_missing_origins, all_violations, jaccard_pairs, topic_components, discover_topics, discover_topics_filtered, slug_dedup, evidence_origins, h3_duplicate_anchors, h4_missing_anchors, h5_asset_closure, h9_page_gaps, h9_page_bounds, h10_untitled, wiki_verify, dead_wikilinks, h21_validate, flatten_tree, content_hash)}

WHITE = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(133)||chr(160)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)||chr(65279)"
NODES = "(SELECT DISTINCT doc_id, node_id, parent_node_id, ord, depth, level, title, anchor, page_start, page_end, is_leaf FROM sections)"
LEAVES = f"(SELECT doc_id, node_id, anchor, title FROM {NODES} WHERE is_leaf AND trim(anchor) <> '')"
PAGES = "(SELECT source, doc_id AS page, text FROM (SELECT doc_id, any_value(source) AS source, any_value(text) AS text FROM documents GROUP BY doc_id) WHERE text IS NOT NULL AND source IS NOT NULL)"
_LINES = r"(SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS l FROM " + DOCS + "))"
_TOC = r"^\s*(\d+(?:\.\d+)*)\s+(\S.*?)\s*\.{2,}\s*(\d+)\s*$"
TOC = f"(SELECT doc_id, pos, regexp_extract(line, '{_TOC}', 1) AS number, regexp_extract(line, '{_TOC}', 2) AS title, len(regexp_extract_all(regexp_extract(line, '{_TOC}', 1), '[.]')) + 1 AS depth, regexp_extract(line, '{_TOC}', 3)::INT AS page FROM {_LINES} WHERE regexp_matches(line, '{_TOC}'))"
_ANCHORS = f"(SELECT doc_id, i - 1 AS pos, a[i] AS anchor FROM (SELECT *, unnest(generate_series(1, len(a))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{X.SECTION_ANCHOR}', 1) AS a FROM {DOCS} WHERE contains(text, '<a id=\"sec-'))))"
_NUMBER, _SPLIT = r"^\d+(\.\d+)*$", r"(?m)^[ \t]*(\d+(?:\.\d+)*)[ \t]+(\S)"
_CHAPTERS = " || ".join(f"'{k}' || chr(10) || 'CHAPTER {k} ...... {k}' || chr(10)" for k in range(1, 10))
_NOISE = r"(?i)^(!\[|page\s+\d+\s+of\b|\w+\s+confidential\b|\d+/\d+/\d+$|m\d+\s+rev\b|product\s+requirement\s+document$|contents$)"
_PAIRED = rf"""(WITH l AS (SELECT doc_id, pos, trim(line, {WHITE}) AS line FROM (SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line FROM (SELECT doc_id, regexp_split_to_array('# Contents' || chr(10) || {_CHAPTERS} || regexp_replace(text, '{_SPLIT}', '\1' || chr(10) || '\2', 'g'), '\r\n|\r|\n') AS l FROM {DOCS} WHERE contains(text, '....')))),
i AS (SELECT l.* FROM l JOIN (SELECT l.doc_id, s.pos AS a, min(l.pos) FILTER (WHERE l.pos > s.pos AND l.line LIKE '#%') AS b FROM l JOIN (SELECT doc_id, min(pos) AS pos FROM l WHERE line LIKE '#%' AND lower(trim(ltrim(line, '#'))) = 'contents' GROUP BY 1) s ON l.doc_id = s.doc_id GROUP BY 1, 2) r ON l.doc_id = r.doc_id AND l.pos > r.a AND (r.b IS NULL OR l.pos < r.b)),
t AS (SELECT doc_id, pos, line FROM i WHERE line <> '' AND NOT regexp_matches(line, '{_NUMBER}') AND NOT regexp_matches(line, '{_NOISE}')),
p AS (SELECT n.doc_id, t.pos AS t, min(n.pos) AS pos, arg_min(n.line, n.pos) AS number, any_value(t.line) AS line FROM i n JOIN t ON t.doc_id = n.doc_id AND t.pos > n.pos AND regexp_matches(n.line, '{_NUMBER}') AND NOT EXISTS (SELECT 1 FROM t u WHERE u.doc_id = n.doc_id AND u.pos > n.pos AND u.pos < t.pos) GROUP BY 1, 2),
c AS (SELECT doc_id, pos, number, trim(regexp_replace(trim(regexp_replace(line, '\s*\.{{2,}}.*$', ''), {WHITE}), '\s+\d+$', ''), {WHITE}) AS title FROM p)
SELECT doc_id, pos, number, title, len(string_split(number, '.')) AS depth FROM c WHERE title <> '')"""
_TREE = f"""WITH e AS (SELECT *, {slug_sql('title', 'unknown', False)} AS base, string_split(number, '.') AS w FROM {_PAIRED}),
one AS (SELECT *, row_number() OVER (PARTITION BY doc_id, base ORDER BY pos) AS k FROM e WHERE depth = 1),
o AS (SELECT doc_id, pos, number, title, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS path FROM one),
up AS (SELECT e.doc_id, e.pos, max(o.pos) AS top FROM e JOIN o ON o.doc_id = e.doc_id AND o.number = e.w[1] AND o.pos < e.pos AND e.depth IN (2, 3) GROUP BY 1, 2),
m AS (SELECT a.doc_id, a.pos, max(b.pos) AS mid FROM e a JOIN e b ON b.doc_id = a.doc_id AND b.depth = 2 AND a.depth = 3 AND b.number = a.w[1] || '.' || a.w[2] AND b.pos < a.pos JOIN up ON up.doc_id = b.doc_id AND up.pos = b.pos GROUP BY 1, 2),
low AS (SELECT e.*, up.top, m.mid, row_number() OVER (PARTITION BY e.doc_id, up.top, m.mid, base ORDER BY e.pos) AS k FROM e JOIN up ON up.doc_id = e.doc_id AND up.pos = e.pos LEFT JOIN m ON m.doc_id = e.doc_id AND m.pos = e.pos),
s AS (SELECT low.doc_id, low.pos, low.number, low.title, low.depth, low.mid, o.path AS above, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS slug FROM low JOIN o ON o.doc_id = low.doc_id AND o.pos = low.top),
tree AS (SELECT doc_id, pos, number, 'subsystem' AS layer, title, path FROM o UNION ALL SELECT s.doc_id, s.pos, s.number, CASE WHEN s.depth = 2 THEN 'part' ELSE 'function' END, s.title, CASE WHEN s.mid IS NULL THEN s.above ELSE p.above || '/' || p.slug END || '/' || s.slug FROM s LEFT JOIN s p ON p.doc_id = s.doc_id AND p.pos = s.mid)"""
SETS = f"(SELECT DISTINCT array_to_string({tokens_sql('title')}, ' ') AS tokens FROM {LEAVES} WHERE len({tokens_sql('title')}) > 0)"
PAIRS = f"""sets AS (SELECT tokens, string_split(tokens, ' ') AS w FROM {SETS}),
words AS (SELECT tokens, len(w) AS n, unnest(w) AS word FROM sets),
pairs AS (SELECT a, b, 1.0::DOUBLE - k::DOUBLE / (na + nb - k) AS distance FROM (SELECT x.tokens AS a, y.tokens AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS k FROM words x JOIN words y ON x.word = y.word AND x.tokens < y.tokens GROUP BY 1, 2))"""
_COMPONENTS = f"""WITH RECURSIVE {PAIRS},
links AS (SELECT a, b FROM pairs WHERE distance <= 0.5 UNION SELECT b, a FROM pairs WHERE distance <= 0.5),
reach AS (SELECT tokens AS node, tokens AS r FROM sets UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.r = links.a),
comp AS (SELECT node, min(r) AS component FROM reach GROUP BY node)
"""
_TOPICS = _COMPONENTS + f""", rows AS (SELECT doc_id, anchor, title, array_to_string({tokens_sql('title')}, ' ') AS tokens FROM {LEAVES}),
named AS (SELECT doc_id, anchor, tokens, component FROM rows JOIN comp ON tokens = node),
counted AS (SELECT component, word, count(*) AS n FROM (SELECT component, unnest(string_split(tokens, ' ')) AS word FROM named) GROUP BY 1, 2),
best AS (SELECT component, word AS title FROM counted QUALIFY row_number() OVER (PARTITION BY component ORDER BY n DESC, word) = 1),
size AS (SELECT component, count(*) AS n_evidence, count(DISTINCT doc_id) AS n_docs FROM named GROUP BY 1),
topics AS (SELECT component, title, n_evidence, n_docs FROM best JOIN size USING (component)
  UNION ALL SELECT chr(65535) || title, title, count(*), count(DISTINCT doc_id) FROM rows WHERE tokens = '' GROUP BY title),
based AS (SELECT *, {slug_sql('title', 'topic')} AS base FROM topics),
numbered AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY component) AS k FROM based)
SELECT CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS slug, title, n_evidence, n_docs FROM numbered"""
_HEADING = r"(?m)^(#{1,6})[ \t]+(.*?)[ \t]*$"
_WS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(133)||chr(160)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)||chr(65279)"
_SPACE = "||".join(f"chr({k})" for k in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))
_RUNNING = rf"WITH p AS (SELECT * FROM {PAGES}), l AS (SELECT DISTINCT source, page, trim(unnest(regexp_split_to_array(text, '\r\n|\r|\n')), {WHITE}) AS line FROM p), c AS (SELECT source, line, count(*) AS n FROM l WHERE line <> '' GROUP BY 1, 2), t AS (SELECT source, count(*) AS pages FROM p GROUP BY 1), r AS (SELECT source, line, n FROM c JOIN t USING (source) WHERE pages >= 2 AND n >= greatest(2, floor(pages * 0.05 + 0.999)))"
ORACLE = {
    "evidence_leaves": f"SELECT * FROM {LEAVES}",
    "content_sections": rf"""WITH seg AS (SELECT doc_id, i AS pos, a[i] AS anchor, p[i + 1] AS segment FROM (SELECT *, unnest(generate_series(1, len(a))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{X.SECTION_ANCHOR}', 1) AS a, regexp_split_to_array(text, '{X.SECTION_ANCHOR}') AS p FROM {DOCS} WHERE contains(text, '<a id="sec-')))),
h AS (SELECT doc_id, pos, anchor, trim(regexp_extract(segment, '{_HEADING}', 2), {_WS}) AS title, length(regexp_extract(segment, '{_HEADING}', 1)) AS level, trim(substr(segment, strpos(segment, regexp_extract(segment, '{_HEADING}', 0)) + length(regexp_extract(segment, '{_HEADING}', 0))), {_WS}) AS body FROM seg WHERE regexp_matches(segment, '{_HEADING}')),
c AS (SELECT *, coalesce(nullif(last_value(CASE WHEN level = 1 THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), ''), title) AS category FROM h)
SELECT doc_id, anchor, title, level, category, sha256(body) AS body_sha256 FROM c WHERE body <> ''""",
    "section_body": rf"""WITH seg AS (SELECT doc_id, i - 1 AS pos, a[i] AS anchor, p[i + 1] AS segment FROM (SELECT *, unnest(generate_series(1, len(a))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{X.SECTION_ANCHOR}', 1) AS a, regexp_split_to_array(text, '{X.SECTION_ANCHOR}') AS p FROM {DOCS} WHERE contains(text, '<a id="sec-')))),
b AS (SELECT doc_id, pos, anchor, rtrim(regexp_replace(segment, '^\n', ''), {_SPACE}) AS body FROM seg),
c AS (SELECT doc_id, pos, anchor, CASE WHEN length(body) > 1500 THEN rtrim(substr(body, 1, 1499), {_SPACE}) || '…' ELSE body END AS body FROM b)
SELECT doc_id, pos, anchor, length(body) AS n_chars, sha256(body) AS body_sha256 FROM c""",
    "next_anchor": f"SELECT doc_id, pos, anchor, lead(anchor) OVER (PARTITION BY doc_id ORDER BY pos) AS next_anchor FROM {_ANCHORS}",
    "nest_by_level": f"SELECT doc_id, node_id, ord, (SELECT max(b.ord) FROM {NODES} b WHERE b.doc_id = a.doc_id AND b.ord < a.ord AND b.level < a.level) AS parent_ord FROM {NODES} a",
    "section_end_page": f"""WITH n AS (SELECT * FROM {NODES} WHERE page_start IS NOT NULL AND level > 0), p AS (SELECT doc_id, max(page_end) AS n_pages FROM n GROUP BY 1),
nx AS (SELECT a.doc_id, a.node_id, arg_min(b.page_start, b.ord) AS nxt FROM n a LEFT JOIN n b ON a.doc_id = b.doc_id AND b.ord > a.ord AND b.level <= a.level GROUP BY 1, 2)
SELECT n.doc_id, n.node_id, n.page_start, greatest(coalesce(nxt - 1, n_pages), n.page_start) AS end_page FROM n JOIN p USING (doc_id) JOIN nx ON n.doc_id = nx.doc_id AND n.node_id = nx.node_id""",
    "running_lines": rf"WITH p AS (SELECT * FROM {PAGES}), l AS (SELECT DISTINCT source, page, trim(unnest(regexp_split_to_array(text, '\r\n|\r|\n')), {_WS}) AS line FROM p), c AS (SELECT source, line, count(*) AS n FROM l WHERE line <> '' GROUP BY 1, 2), t AS (SELECT source, count(*) AS pages FROM p GROUP BY 1) SELECT source, line, n FROM c JOIN t USING (source) WHERE pages >= 2 AND n >= greatest(2, floor(pages * 0.05 + 0.999))",
    "heading_inference": "WITH s AS (SELECT p_brand AS doc_id, p_partkey % 50 AS page, p_partkey AS pos, round_even(p_size / 3.0 * 2, 0) / 2 AS size, p_partkey % 7 = 0 AS bold, trim(p_name) AS title FROM part WHERE trim(p_name) <> ''), w AS (SELECT doc_id, size, sum(length(title)) AS w, min((page, pos)) AS f FROM s GROUP BY 1, 2), b AS (SELECT doc_id, size AS body FROM w QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, f) = 1), c AS (SELECT DISTINCT s.doc_id, page, size, title FROM s JOIN b USING (doc_id) WHERE size > body * 1.1 OR (bold AND size >= body + 1)), z AS (SELECT doc_id, size, row_number() OVER (PARTITION BY doc_id ORDER BY size DESC) AS level FROM (SELECT DISTINCT doc_id, size FROM c)) SELECT c.doc_id, page, level, title FROM c JOIN z ON c.doc_id = z.doc_id AND c.size = z.size WHERE level <= 4",
    "toc_parse": f"SELECT * FROM {TOC}",
    "toc_rollup": f"WITH t AS (SELECT * FROM {TOC}), q AS (SELECT DISTINCT doc_id, number || '.1' AS number FROM t), k AS (SELECT DISTINCT doc_id, number AS entry FROM t), m AS (SELECT q.doc_id, q.number, arg_max(entry, length(entry)) AS entry FROM q JOIN k ON q.doc_id = k.doc_id AND (q.number = entry OR starts_with(q.number, entry || '.')) GROUP BY 1, 2) SELECT q.doc_id, q.number, coalesce(entry, 'root') AS entry FROM q LEFT JOIN m ON q.doc_id = m.doc_id AND q.number = m.number",
    "toc_pairs": f"SELECT * FROM {_PAIRED}",
    "toc_tree": f"{_TREE} SELECT doc_id, number, layer, title, path FROM tree",
    "toc_section_map": f"{_TREE}, q AS (SELECT DISTINCT doc_id, number || '.1' AS number FROM {_PAIRED}), k AS (SELECT doc_id, number, arg_max(path, pos) AS path FROM tree GROUP BY 1, 2) SELECT q.doc_id, q.number, coalesce(arg_max(k.path, length(k.number)), '') AS path FROM q LEFT JOIN k ON q.doc_id = k.doc_id AND (q.number = k.number OR starts_with(q.number, k.number || '.')) GROUP BY 1, 2",
    "outline_padding": f"WITH e AS (SELECT doc_id, ord, level, title, page_start FROM {NODES} WHERE level > 0 AND page_start >= 1) SELECT * FROM e UNION ALL SELECT doc_id, ord - 1, 1, 'Front matter', 1 FROM e QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ord) = 1 AND page_start > 1",
    "h18_missing_origins": rf"WITH m AS (SELECT DISTINCT regexp_replace(regexp_extract(source_path, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS doc_id, source_sha256, status FROM manifest), e AS (SELECT {slug_sql('title', 'topic')} AS slug, source_sha256, status FROM {LEAVES} JOIN m USING (doc_id)) SELECT DISTINCT slug, source_sha256 FROM e WHERE source_sha256 IS NOT NULL EXCEPT SELECT slug, source_sha256 FROM e WHERE status = 'ok'",
    "jaccard_pairs": f"WITH {PAIRS} SELECT a, b, round(distance, 6) AS distance FROM pairs WHERE distance <= 0.85",
    "topic_components": _COMPONENTS + "SELECT node, component FROM comp",
    "discover_topics": _TOPICS,
    "discover_topics_filtered": f"SELECT * FROM ({_TOPICS}) WHERE n_evidence >= 2 AND NOT (trim(title) = '' OR regexp_full_match(title, '[\\d.\\-\\s]+'))",
    "slug_dedup": f"SELECT doc_id, node_id, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS slug FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, base ORDER BY ord, node_id) AS k FROM (SELECT *, {slug_sql('title', 'section')} AS base FROM {NODES} WHERE title IS NOT NULL))",
    "evidence_origins": rf"WITH m AS (SELECT DISTINCT regexp_replace(regexp_extract(source_path, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS doc_id, source_sha256 FROM manifest WHERE source_sha256 IS NOT NULL), e AS (SELECT DISTINCT {slug_sql('title', 'topic')} AS slug, source_sha256 FROM {LEAVES} JOIN m USING (doc_id)) SELECT slug, count(*) AS n_origins, min(source_sha256) AS first_origin, max(source_sha256) AS last_origin FROM e GROUP BY 1",
    "h3_duplicate_anchors": f"SELECT doc_id, anchor, count(*) AS n FROM (SELECT source AS doc_id, unnest(regexp_extract_all(text, '{X.ANCHOR}', 1)) AS anchor FROM {PAGES}) GROUP BY 1, 2 HAVING count(*) > 1",
    "h4_missing_anchors": f"SELECT DISTINCT doc_id, anchor FROM {LEAVES} l WHERE anchor <> '' AND NOT EXISTS (SELECT 1 FROM content_sections c WHERE c.doc_id = l.doc_id AND c.anchor = l.anchor)",
    "h9_page_gaps": f"WITH p AS (SELECT doc_id, max(page_end) AS n FROM {NODES} WHERE node_id = 'root' GROUP BY 1), w AS (SELECT doc_id, unnest(generate_series(1, n)) AS page FROM p WHERE n IS NOT NULL) SELECT doc_id, page FROM w WHERE NOT EXISTS (SELECT 1 FROM sections s WHERE s.doc_id = w.doc_id AND s.node_id <> 'root' AND s.page_start <= w.page AND s.page_end >= w.page)",
    "h9_page_bounds": f"WITH p AS (SELECT doc_id, max(page_end) AS n_pages FROM {NODES} WHERE node_id = 'root' GROUP BY 1) SELECT n.doc_id, node_id, page_start, page_end, n_pages FROM {NODES} n JOIN p USING (doc_id) WHERE page_start > page_end OR page_start < 1 OR page_end > n_pages",
    "h10_untitled": f"SELECT doc_id FROM {NODES} WHERE level <= 1 GROUP BY doc_id HAVING sum(CASE WHEN level >= 1 AND trim(coalesce(title, '')) <> '' THEN 1 ELSE 0 END) = 0",
    "wiki_verify": f"WITH a AS (SELECT source AS doc_id, unnest(regexp_extract_all(text, '{X.ANCHOR}', 1)) AS anchor FROM {PAGES}), n AS (SELECT doc_id, anchor, count(*) AS n FROM a GROUP BY 1, 2) SELECT doc_id, anchor, CASE WHEN n IS NULL THEN 'H14' ELSE 'H17' END AS rule FROM (SELECT DISTINCT doc_id, anchor FROM {LEAVES}) LEFT JOIN n USING (doc_id, anchor) WHERE n IS NULL OR n > 1",
    "dead_wikilinks": rf"WITH l AS (SELECT DISTINCT doc_id, anchor, trim(unnest(regexp_extract_all(body, '{X.WIKILINK}', 1)), {_WS}) AS target FROM {BODIES}), n AS (SELECT DISTINCT title AS name FROM sections WHERE title IS NOT NULL) SELECT doc_id, anchor, target FROM l WHERE target NOT IN (SELECT name FROM n) AND regexp_extract(target, '([^/]*)$', 1) NOT IN (SELECT regexp_extract(name, '([^/]*)$', 1) FROM n)",
}

_DROPPED = rf"CASE WHEN g IS NULL THEN text ELSE trim(array_to_string(list_filter(regexp_split_to_array(text, '\r\n|\r|\n'), lambda x: NOT list_contains(g, trim(x, {WHITE}))), chr(10)), chr(10)) END"
ORACLE["page_bodies"] = f"{_RUNNING}, g AS (SELECT source, list(line) AS g FROM r GROUP BY 1) SELECT source, page, length({_DROPPED}) AS n_chars, sha256({_DROPPED}) AS text_sha256 FROM p LEFT JOIN g USING (source)"
ORACLE["page_headings"] = f"SELECT doc_id, page, level, title FROM ({ORACLE['heading_inference']}) QUALIFY row_number() OVER (PARTITION BY doc_id, page ORDER BY level, title) = 1"
ORACLE["all_violations"] = "SELECT invariant, doc_id, detail, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS invariant, doc_id, {detail} AS detail FROM ({ORACLE[q]})" for k, q, detail in (("H3", "h3_duplicate_anchors", "anchor || ' ' || n"), ("H4", "h4_missing_anchors", "anchor"), ("H9", "h9_page_gaps", "page::VARCHAR"), ("H10", "h10_untitled", "''"), ("H14", "wiki_verify", "anchor || ' ' || rule"))) + ") GROUP BY ALL"
ORACLE["flatten_tree"] = f"WITH {TREES} SELECT record_id, path AS node_path, parent AS parent_path, v->>'node_id' AS node_id, v->>'title' AS title, CASE WHEN json_type(v, '$.level') IN ('UBIGINT', 'BIGINT') THEN (v->>'level')::INT END AS level, len(string_split(path, '.')) AS depth FROM tree WHERE kind = 'index_trees'"
ORACLE["h21_validate"] = f"""WITH {TREES}, n AS (SELECT record_id, path, parent, coalesce(v->>'slug', '') AS slug, coalesce(list_position(['system', 'subsystem', 'part', 'function'], v->>'layer'), 0) AS place, len(string_split(path, '.')) AS depth FROM tree WHERE kind = 'taxonomies'),
a AS (SELECT n.*, coalesce(p.place, 0) AS above, count(*) OVER (PARTITION BY n.record_id, n.parent, n.slug) AS twins FROM n LEFT JOIN n p ON p.record_id = n.record_id AND p.path = n.parent)
SELECT record_id, path AS node_path, unnest(list_filter([CASE WHEN trim(slug, {WHITE}) = '' THEN 'empty slug' END, CASE WHEN twins > 1 THEN 'duplicate slug' END, CASE WHEN place = 0 THEN 'unknown layer' WHEN place <> above + 1 THEN 'wrong layer' END, CASE WHEN depth > 4 THEN 'too deep' END], lambda x: x IS NOT NULL)) AS rule FROM a"""
ORACLE["h5_asset_closure"] = rf"""WITH {TREES}, r AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(body, '!\[[^\]]*\]\(([^)\s]+)\)', 1)) AS rel_path FROM {BODIES}),
o AS (SELECT DISTINCT record_id, doc_id FROM index_trees),
l AS (SELECT record_id, CASE json_type(w) WHEN 'ARRAY' THEN json_extract(w, '$[*]') WHEN 'OBJECT' THEN CASE WHEN regexp_full_match(json_keys(w)[1], '\d+') THEN list_transform(json_keys(w), lambda k: json_extract(w, '$."' || k || '"')) ELSE [w] END ELSE [] END AS l FROM (SELECT record_id, CASE WHEN json_type(v, '$.assets') = 'VARCHAR' AND json_valid(v->>'assets') THEN (v->>'assets')::JSON ELSE json_extract(v, '$.assets') END AS w FROM tree WHERE kind = 'index_trees')),
h AS (SELECT DISTINCT doc_id, x->>'rel_path' AS rel_path FROM (SELECT record_id, unnest(l) AS x FROM l) JOIN o USING (record_id) WHERE json_type(x) = 'OBJECT' AND x->>'rel_path' IS NOT NULL)
SELECT doc_id, rel_path, 'not recorded' AS rule FROM r EXCEPT SELECT doc_id, rel_path, 'not recorded' FROM h"""
_UNITS = "flatten(list_transform(string_split(body, chr(10) || chr(10)), lambda p: CASE WHEN length(p) <= 1500 THEN [p] ELSE flatten(list_transform(string_split(p, chr(10)), lambda l: CASE WHEN length(l) <= 1500 THEN [l] ELSE list_transform(generate_series(0, (ceil(length(l) / 1500.0) - 1)::INT), lambda k: substr(l, (k * 1500 + 1)::INT, 1500)) END)) END))"
_ADD = "CASE WHEN a[-1] = '' THEN list_append(a[:-2], u[1]) WHEN length(a[-1]) + 2 + length(u[1]) <= 1500 THEN list_append(a[:-2], a[-1] || chr(10) || chr(10) || u[1]) ELSE list_append(a, u[1]) END"
ORACLE["chunk_body"] = f"""WITH c AS (SELECT doc_id, anchor, CASE WHEN length(body) <= 1500 THEN [body] ELSE list_reduce(list_transform({_UNITS}, lambda u: [u]), lambda a, u: {_ADD}, ['']) END AS c, length(body) <= 1500 AS whole FROM {BODIES} WHERE body IS NOT NULL),
d AS (SELECT doc_id, anchor, CASE WHEN NOT whole AND c[-1] = '' THEN c[:-2] ELSE c END AS c FROM c)
SELECT doc_id, anchor, i - 1 AS chunk_no, length(c[i]) AS n_chars, sha256(c[i]) AS chunk_sha256 FROM (SELECT *, unnest(generate_series(1, len(c))) AS i FROM d)"""
ORACLE["content_hash"] = rf"""WITH b AS (SELECT doc_id, anchor, title, coalesce(body, '') AS body FROM {BODIES}), i AS (SELECT *, list_sort(list_transform(regexp_extract_all(body, '!\[[^\]]*\]\(([^)\s]+)\)', 1), lambda x: sha256(x))) AS images FROM b)
SELECT doc_id, anchor, len(images) AS n_images, sha256(regexp_replace(regexp_replace(regexp_replace(body, '^\x{{FEFF}}', ''), '\r\n|\r', chr(10), 'g'), '\n+\z', '') || chr(10) || chr(0) || 'ASSETS' || chr(0) || array_to_string(list_transform(images, lambda x: x || chr(0)), '') || chr(0) || 'INDEX' || chr(0) || '{{"anchor": ' || to_json(coalesce(anchor, ''))::VARCHAR || ', "title": ' || to_json(coalesce(title, ''))::VARCHAR || '}}') AS content_sha256 FROM i"""
