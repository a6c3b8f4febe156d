"""Queries of prompts, offline answers, pages and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.operators import pages, topics
from strataframe.plans.section_queries import _COMPONENTS, LEAVES, PAGES, leaves
from strataframe.plans.section_queries import _pages as doc_pages
from strataframe.plans.text_queries import _bodies as bodies
from strataframe.plans.text_queries import tokens_sql
from strataframe.tables import read


def _sections(s: SparkSession, d: str) -> DataFrame:
    return bodies(s, d)


def _messages():
    user = F.concat(F.lit("[1] "), F.coalesce("title", F.lit("")), F.lit("\n[2] "), F.coalesce("category", F.lit("")))
    return F.array(F.struct(F.lit("system").alias("role"), F.lit("Write a page.").alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def mock_chat(s: SparkSession, d: str) -> DataFrame:
    return _sections(s, d).select("doc_id", "anchor", pages.offline_answer(_messages()).alias("response"))


def dump_prompts(s: SparkSession, d: str) -> DataFrame:
    return _sections(s, d).select(X.prompt_hash(_messages()).alias("prompt_hash"), "title").groupBy("prompt_hash").agg(F.count("*").alias("n_sections"), F.min("title").alias("title"))


def coerce_items(s: SparkSession, d: str) -> DataFrame:
    """An item for each section that quotes its title and says nothing else."""
    none = F.lit(None).cast("string")
    raw = _sections(s, d).select("doc_id", "anchor", F.col("title").alias("section_title"), F.col("category").alias("section_category"), "body", F.col("title").alias("what"), none.alias("how"), F.lit(" ").alias("sample_size"), none.alias("source_document"), F.col("title").alias("quote"))
    return pages.coerced_items(raw)


def topic_title(s: SparkSession, d: str) -> DataFrame:
    """The most frequent word of each component of section titles."""
    e = leaves(s, d).withColumn("tokens", F.array_join(X.tokens(F.col("title")), " ")).filter("tokens != ''")
    sets = topics.token_sets(e)
    c = topics.components(sets.select(F.col("tokens").alias("node")), topics.jaccard_pairs(sets, 0.5))
    w = e.join(c, e.tokens == c.node).select("component", F.explode(F.split("tokens", " ")).alias("word")).groupBy("component", "word").agg(F.count("*").alias("n"))
    return w.groupBy("component").agg(F.min(F.struct((-F.col("n")).alias("m"), "word")).alias("x")).select("component", F.col("x.word").alias("title"), (-F.col("x.m")).alias("n"))


def _numbered(e: DataFrame) -> DataFrame:
    """slug, user: the prompt of each page, which numbers all of its evidence (slug, ev_no, section_title);
    what is gathered is one page's titles."""
    asked = e.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("ev_no", "section_title"))).alias("x"))
    line = lambda v: F.concat(F.lit("["), v["ev_no"].cast("string"), F.lit("] "), F.coalesce(v["section_title"], F.lit("")))
    return asked.select("slug", F.array_join(F.transform("x", line), "\n").alias("user"))


def wiki_pages(s: SparkSession, d: str) -> DataFrame:
    """A page for each document: offline answers to all its sections, with footnotes."""
    e = leaves(s, d).join(read(s, d, "sections").select("doc_id", "node_id", "page_start").distinct(), ["doc_id", "node_id"])
    e = e.select(F.col("doc_id").alias("slug"), F.row_number().over(Window.partitionBy("doc_id").orderBy("anchor", "node_id")).alias("ev_no"), "doc_id", "anchor", F.col("title").alias("section_title"), "page_start")
    asked = _numbered(e)
    body = pages.offline_answer(F.array(F.struct(F.lit("user").alias("role"), F.col("user").alias("content"))))
    t = asked.select("slug", F.col("slug").alias("title"))
    return pages.pages(t, e, asked.select("slug", body.alias("body"))).select("slug", "n_pins", "n_unresolved", F.length("markdown").alias("n_chars"), X.sha(F.col("markdown")).alias("markdown_sha256"))


def frontmatter_pages(s: SparkSession, d: str) -> DataFrame:
    t = _sections(s, d).filter("title is not null and category is not null")
    head = pages.frontmatter(F.col("title"), F.array(X.slug(F.col("category"), "unknown", False)), X.slug(F.col("title"), "topic"), F.array("doc_id"))
    return t.select("doc_id", "anchor", X.sha(head).alias("header_sha256"))


def scanned_pages(s: SparkSession, d: str) -> DataFrame:
    return doc_pages(s, d).filter(pages.is_scanned(F.col("text"))).select("source", "page")


QUERIES = {f.__name__: f for f in (mock_chat, dump_prompts, coerce_items, topic_title, wiki_pages, frontmatter_pages, scanned_pages)}

_POOL = "[" + ", ".join(f"'{x}'" for x in pages.SENTENCES) + "]"
_SECTIONS = "(SELECT doc_id, anchor, any_value(title) AS title, any_value(category) AS category, any_value(body) AS body FROM content_sections GROUP BY 1, 2)"
_USER = "'[1] ' || coalesce(title, '') || chr(10) || '[2] ' || coalesce(category, '')"
_JSON = f"'[{{\"content\": \"Write a page.\", \"role\": \"system\"}}, {{\"content\": ' || to_json({_USER})::VARCHAR || ', \"role\": \"user\"}}]'"


def _answer(json: str, n: str) -> str:
    """The offline answer to a JSON prompt with ``n`` numbered entries."""
    digest = rf"sha256('\x00\x00\x00\x00\x00\x00\x00\x00'::BLOB || encode({json}))"
    pick = lambda i: f"({_POOL})[strpos('0123456789abcdef', substr({digest}, {8 * i + 8}, 1))]"

    def pins(p: int) -> str:
        return f"CASE WHEN {n} = 1 THEN '[^ev-1]' ELSE '[^ev-' || ((2 * {p}) % {n} + 1) || '][^ev-' || (((2 * {p}) % {n} + 1) % {n} + 1) || ']' END"

    return " || ".join([*map(pick, range(4)), pins(0), "chr(10) || chr(10)", *map(pick, range(4, 8)), pins(1)])


_WS = "chr(9)||chr(10)||chr(13)||' '||chr(160)||chr(12288)"
_SCALAR = lambda c: f"CASE WHEN {c} = '' OR regexp_matches({c}, '{pages.QUOTED}') OR {c} <> trim({c}, {_WS}) THEN '\"' || replace(replace({c}, '\\', '\\\\'), '\"', '\\\"') || '\"' ELSE {c} END"
_CATEGORY = r"coalesce(nullif(trim(regexp_replace(lower(trim(category, " + _WS + r")), '[^a-z0-9\x{4e00}-\x{9fff}]+', '-', 'g'), '-'), ''), 'unknown')"
_SLUG = r"coalesce(nullif(trim(regexp_replace(regexp_replace(lower(trim(title, " + _WS + r")), '[^a-z0-9\x{4e00}-\x{9fff}-]+', '-', 'g'), '-+', '-', 'g'), '-'), ''), 'topic')"
_PATTERN = r"array_to_string(list_transform(list_filter(regexp_split_to_array(trim(coalesce(title, ''), {w}), '[\s\x{{00A0}}\x{{3000}}]+'), lambda w: w <> ''), lambda w: '\Q' || w || '\E'), '[\s\x{{00A0}}\x{{3000}}]+')".format(w=_WS)
ORACLE = {
    "mock_chat": f"SELECT doc_id, anchor, {_answer('j', '2')} AS response FROM (SELECT doc_id, anchor, {_JSON} AS j FROM {_SECTIONS})",
    "dump_prompts": f"SELECT sha256({_JSON}) AS prompt_hash, count(*) AS n_sections, min(title) AS title FROM {_SECTIONS} GROUP BY 1",
    "topic_title": _COMPONENTS + f", e AS (SELECT array_to_string({tokens_sql('title')}, ' ') AS tokens FROM {LEAVES}), w AS (SELECT component, word, count(*) AS n FROM (SELECT component, unnest(string_split(tokens, ' ')) AS word FROM e JOIN comp ON tokens = node) GROUP BY 1, 2) SELECT component, word AS title, n FROM w QUALIFY row_number() OVER (PARTITION BY component ORDER BY n DESC, word) = 1",
    "coerce_items": f"SELECT doc_id, coalesce(nullif(trim(category, {_WS}), ''), 'Uncategorized') AS category, trim(coalesce(title, ''), {_WS}) AS what, '{pages.DEFAULT_HOW}' AS how, '{pages.DEFAULT_SAMPLE}' AS sample_size, '{pages.DEFAULT_DOC}' AS source_document, title AS source_section, anchor AS evidence_ref, CASE WHEN trim(coalesce(title, ''), {_WS}) = '' THEN '' ELSE coalesce(regexp_extract(coalesce(body, ''), {_PATTERN}), '') END AS evidence_quote FROM {_SECTIONS}",
    "frontmatter_pages": f"SELECT doc_id, anchor, sha256('---' || chr(10) || 'title: ' || {_SCALAR('title')} || chr(10) || 'type: topic' || chr(10) || 'domain: ' || {_SCALAR('c')} || chr(10) || 'category_path: ' || {_SCALAR('c')} || chr(10) || 'slug: ' || {_SCALAR('s')} || chr(10) || 'evidence_sources:' || chr(10) || '  - ' || {_SCALAR('doc_id')} || chr(10) || 'tags:' || chr(10) || '  - ' || {_SCALAR(chr(40) + chr(39) + 'domain/' + chr(39) + ' || c)')} || chr(10) || '  - ' || {_SCALAR(chr(40) + chr(39) + 'path/' + chr(39) + ' || c)')} || chr(10) || '---') AS header_sha256 FROM (SELECT *, {_CATEGORY} AS c, {_SLUG} AS s FROM {_SECTIONS} WHERE title IS NOT NULL AND category IS NOT NULL)",
    "scanned_pages": rf"SELECT source, page FROM {PAGES} WHERE length(regexp_replace(text, '[\s\x{{00A0}}\x{{3000}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{2028}}\x{{2029}}\x{{0085}}\x{{205F}}\x0b\x1c-\x1f]', '', 'g')) < 50",
}

_PAGE_JSON = "'[{\"content\": ' || to_json(u)::VARCHAR || ', \"role\": \"user\"}]'"
ORACLE["wiki_pages"] = f"""WITH e AS (SELECT l.doc_id AS slug, l.anchor, l.title, p.page_start, row_number() OVER (PARTITION BY l.doc_id ORDER BY l.anchor, l.node_id) AS k FROM {LEAVES} l JOIN (SELECT DISTINCT doc_id, node_id, page_start FROM sections) p ON p.doc_id = l.doc_id AND p.node_id = l.node_id),
u AS (SELECT slug, count(*) AS n, string_agg('[' || k || '] ' || coalesce(title, ''), chr(10) ORDER BY k) AS u FROM e GROUP BY 1),
a AS (SELECT slug, n, {_answer(_PAGE_JSON, 'n')} AS body FROM u),
q AS (SELECT DISTINCT slug, unnest(regexp_extract_all(body, '\\[\\^ev-(\\d+)\\]', 1))::INT AS pin FROM a),
f AS (SELECT q.slug, count(*) AS n_pins, string_agg('[^ev-' || pin || ']: [' || coalesce(title, '') || CASE WHEN page_start IS NULL THEN '' ELSE ' (p.' || page_start || ')' END || '](../kb/' || q.slug || '/main.md#' || anchor || ')', chr(10) ORDER BY pin) AS notes FROM q JOIN e ON e.slug = q.slug AND e.k = q.pin GROUP BY 1),
m AS (SELECT slug, n_pins, '# ' || slug || chr(10) || chr(10) || '> Slug: `' || slug || '` · Evidence sources: ' || n || chr(10) || chr(10) || trim(body, {_WS}) || chr(10) || chr(10) || notes || chr(10) AS m FROM a JOIN f USING (slug))
SELECT slug, n_pins, 0 AS n_unresolved, length(m) AS n_chars, sha256(m) AS markdown_sha256 FROM m"""
