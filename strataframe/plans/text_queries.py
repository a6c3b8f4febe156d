"""Queries of the scalar text functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.tables import deliveries, read

REDACTION = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]", "@"), (r"[MH][0-9]{7}", "[doc]"), (r"CONFIDENTIAL", "[mark]", "CONFIDENTIAL")]


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "sections").select("doc_id", "node_id", "title").distinct()


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, each counted once."""
    return deliveries(spark, sf_dir, "documents", ["doc_id"], ["text"])


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content sections, each counted once."""
    return deliveries(spark, sf_dir, "content_sections", ["doc_id", "anchor"], ["title", "category", "body"])


def tokenize(s: SparkSession, d: str) -> DataFrame:
    return _titles(s, d).select("doc_id", "node_id", F.array_join(X.tokens(F.col("title")), " ").alias("tokens"))


def slugify(s: SparkSession, d: str) -> DataFrame:
    t = F.col("title")
    return _titles(s, d).select("doc_id", "node_id", X.slug(t, "topic").alias("topic_slug"), X.slug(t, "unknown", False).alias("taxonomy_slug"), X.is_numeric_title(t).alias("is_numeric"))


def normalize_markdown(s: SparkSession, d: str) -> DataFrame:
    t = X.normal_markdown(F.col("text"))
    return _docs(s, d).filter("text is not null").select("doc_id", F.length(t).alias("n_chars"), X.sha(t).alias("text_sha256"))


def strip_images(s: SparkSession, d: str) -> DataFrame:
    b = F.col("body")
    return _bodies(s, d).filter("body is not null").select("doc_id", "anchor", X.image_count(b).alias("n_images"), X.sha(X.without_images(b)).alias("body_sha256"))


def extract_anchors(s: SparkSession, d: str) -> DataFrame:
    a = X.anchors(F.col("text"))
    return _docs(s, d).filter("text is not null").select("doc_id", F.array_join(a, ",").alias("anchors"), F.size(a).alias("n_anchors"))


def extract_wikilinks(s: SparkSession, d: str) -> DataFrame:
    return _bodies(s, d).select("doc_id", "anchor", F.posexplode(X.wikilinks(F.col("body"))).alias("pos", "target"))


def ref_doc_numbers(s: SparkSession, d: str) -> DataFrame:
    return _bodies(s, d).select("doc_id", "anchor", F.explode(F.array_distinct(X.reference_docs(F.col("body")))).alias("doc_number"))


def inject_block_refs(s: SparkSession, d: str) -> DataFrame:
    t = X.with_block_refs(F.col("text"))
    return _docs(s, d).filter("text is not null").select("doc_id", X.sha(t).alias("text_sha256"))


def redact_text(s: SparkSession, d: str) -> DataFrame:
    t, n = X.redacted(F.col("body"), REDACTION)
    return _bodies(s, d).filter("body is not null").select("doc_id", "anchor", n.alias("n_redacted"), X.sha(t).alias("body_sha256"))


def redact_titles(s: SparkSession, d: str) -> DataFrame:
    """Titles of sections and paths of sources are redacted by the rules for bodies."""
    t = _titles(s, d).filter("title is not null").select(F.concat_ws(" ", "doc_id", "node_id").alias("key"), F.col("title").alias("text"))
    p = read(s, d, "manifest").select("key", F.col("source_path").alias("text")).filter("text is not null").distinct()
    text, n = X.redacted(F.col("text"), REDACTION)
    return t.unionByName(p).select("key", n.alias("n_redacted"), text.alias("text"))


def file_names(s: SparkSession, d: str) -> DataFrame:
    p = F.col("source_path")
    return read(s, d, "manifest").select("key", "source_path").distinct().select("key", X.file_stem(p).alias("doc_id"), X.suffix(p).alias("suffix"), X.module_file_name(p).alias("flat_name"))


def atom_id(s: SparkSession, d: str) -> DataFrame:
    c = F.col
    a = read(s, d, "atoms").select("atom_no", "entity", "parameter", "condition", "doc_id", "section").distinct()
    return a.select("atom_no", X.atom_id(c("entity"), c("parameter"), c("condition"), c("doc_id"), c("section")).alias("computed_id"))


def _prompts(s: SparkSession, d: str) -> DataFrame:
    """A prompt for each section: a fixed instruction and the section's title."""
    m = F.array(F.struct(F.lit("system").alias("role"), F.lit("Summarise.").alias("content")), F.struct(F.lit("user").alias("role"), F.coalesce("title", F.lit("")).alias("content")))
    return _bodies(s, d).select("doc_id", "anchor", "title", X.prompt_hash(m).alias("prompt_hash"))


def prompt_hash(s: SparkSession, d: str) -> DataFrame:
    return _prompts(s, d).select("doc_id", "anchor", "prompt_hash")


def natural_sort(s: SparkSession, d: str) -> DataFrame:
    n = read(s, d, "sections").select("title").filter("title is not null").distinct()
    return n.select("title", X.sha(X.natural_key(F.col("title"))).alias("order_key_sha256"), X.natural_key(F.col("title")).startswith("0").alias("is_numbered"))


def _grid(s: SparkSession, d: str) -> DataFrame:
    """The nations of each region as rows of a small table; a region has few."""
    rows = read(s, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.array(F.col("n_name"), F.col("n_nationkey").cast("string")))).alias("rows"))
    return rows.join(F.broadcast(read(s, d, "region")), rows.n_regionkey == F.col("r_regionkey")).select("r_name", "rows")


def cells_to_html(s: SparkSession, d: str) -> DataFrame:
    def cell(text, header):
        return F.struct(text.alias("text"), F.lit(1).alias("colspan"), F.lit(1).alias("rowspan"), F.lit(header).alias("is_header"))

    head = F.array(F.array(F.struct(F.col("r_name").alias("text"), F.lit(2).alias("colspan"), F.lit(1).alias("rowspan"), F.lit(True).alias("is_header"))))
    body = F.transform("rows", lambda r: F.array(cell(r[0], False), cell(r[1], False)))
    return _grid(s, d).select("r_name", X.html_table(F.concat(head, body)).alias("html"))


def pipe_table(s: SparkSession, d: str) -> DataFrame:
    head = F.array(F.array(F.lit("nation"), F.lit("key")))
    return _grid(s, d).select("r_name", X.pipe_table(F.concat(head, F.col("rows"))).alias("markdown"))


def format_value(s: SparkSession, d: str) -> DataFrame:
    o = read(s, d, "orders")
    return o.select("o_orderkey", X.formatted(F.round("o_totalprice"), "$#,##0").alias("price"), X.formatted(F.floor("o_totalprice") / 100, "0%").alias("share"), X.formatted_time(F.col("o_orderdate")).alias("ordered"))


def parse_llm_json(s: SparkSession, d: str) -> DataFrame:
    """Answers in fences or between other words, as lists; those without a list are null."""
    raw = F.concat(F.lit("Here it is:\n```json\n"), F.col("taxonomy_json"), F.lit("\n```"))
    t = deliveries(s, d, "taxonomies", ["record_id"], ["taxonomy_json"])
    found = X.json_list(raw)
    return t.select("record_id", F.length(found).alias("n_chars"), F.json_array_length(found).alias("n_items"))


QUERIES = {f.__name__: f for f in (tokenize, slugify, normalize_markdown, strip_images, extract_anchors, extract_wikilinks, ref_doc_numbers, inject_block_refs, redact_text, redact_titles, file_names, atom_id, prompt_hash, natural_sort, cells_to_html, pipe_table, format_value, parse_llm_json)}

_STOP = ", ".join(f"'{w}'" for w in X.STOPWORDS)
DOCS = "(SELECT doc_id, any_value(text) AS text FROM documents GROUP BY doc_id)"
BODIES = "(SELECT doc_id, anchor, any_value(title) AS title, any_value(body) AS body FROM content_sections GROUP BY doc_id, anchor)"
TITLES = "(SELECT DISTINCT doc_id, node_id, title FROM sections)"


def tokens_sql(column: str) -> str:
    return rf"list_sort(list_distinct(list_filter(regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}\p{{M}}_]+'), lambda x: length(x) > 1 AND x NOT IN ({_STOP}))))"


def slug_sql(column: str, fallback: str, hyphen: bool = True) -> str:
    kept = "[^a-z0-9\\x{4e00}-\\x{9fff}-]+" if hyphen else "[^a-z0-9\\x{4e00}-\\x{9fff}]+"
    return rf"coalesce(nullif(trim(regexp_replace(regexp_replace(lower(trim({column}, chr(9)||chr(10)||chr(13)||' '||chr(160))), '{kept}', '-', 'g'), '-+', '-', 'g'), '-'), ''), '{fallback}')"


def _redact(column: str) -> tuple[str, str]:
    n = []
    for pattern, to, *_ in REDACTION:
        n.append(f"len(regexp_extract_all({column}, '{pattern}'))")
        column = f"regexp_replace({column}, '{pattern}', '{to}', 'g')"
    return column, " + ".join(n)


_IMG1, _IMG2 = r"!\[[^\]]*\]\([^)]*\)", r"(?i)<img\b[^>]*>"
_NORMAL = r"regexp_replace(regexp_replace(regexp_replace(text, '^\x{FEFF}', ''), '\r\n|\r', chr(10), 'g'), '\n+\z', '') || chr(10)"
PROMPT_SQL = "sha256('[{\"content\": \"Summarise.\", \"role\": \"system\"}, {\"content\": ' || to_json(coalesce(title, ''))::VARCHAR || ', \"role\": \"user\"}]')"
ORACLE = {
    "tokenize": f"SELECT doc_id, node_id, coalesce(array_to_string({tokens_sql('title')}, ' '), CASE WHEN title IS NULL THEN NULL ELSE '' END) AS tokens FROM {TITLES}",
    "slugify": f"SELECT doc_id, node_id, {slug_sql('title', 'topic')} AS topic_slug, {slug_sql('title', 'unknown', False)} AS taxonomy_slug, trim(title) = '' OR regexp_full_match(title, '[\\d.\\-\\s]+') AS is_numeric FROM {TITLES}",
    "normalize_markdown": f"SELECT doc_id, length({_NORMAL}) AS n_chars, sha256({_NORMAL}) AS text_sha256 FROM {DOCS} WHERE text IS NOT NULL",
    "strip_images": f"SELECT doc_id, anchor, len(regexp_extract_all(body, '{_IMG1}')) + len(regexp_extract_all(regexp_replace(body, '{_IMG1}', '', 'g'), '{_IMG2}')) AS n_images, sha256(regexp_replace(regexp_replace(body, '{_IMG1}', '', 'g'), '{_IMG2}', '', 'g')) AS body_sha256 FROM {BODIES} WHERE body IS NOT NULL",
    "extract_anchors": f"SELECT doc_id, array_to_string(a, ',') AS anchors, len(a) AS n_anchors FROM (SELECT doc_id, regexp_extract_all(text, '{X.ANCHOR}', 1) AS a FROM {DOCS} WHERE text IS NOT NULL)",
    "extract_wikilinks": rf"SELECT doc_id, anchor, pos - 1 AS pos, trim(a[pos]) AS target FROM (SELECT doc_id, anchor, a, unnest(generate_series(1, len(a))) AS pos FROM (SELECT doc_id, anchor, regexp_extract_all(body, '{X.WIKILINK}', 1) AS a FROM {BODIES}))",
    "ref_doc_numbers": rf"SELECT DISTINCT doc_id, anchor, unnest(regexp_extract_all(body, '{X.REFERENCE_DOC}')) AS doc_number FROM {BODIES}",
    "inject_block_refs": r'''SELECT doc_id, sha256(regexp_replace(text, '<a id="(sec-\d+)"></a>\n(#{1,6} [^\n]*)', '<a id="\1"></a>' || chr(10) || '\2' || chr(10) || '^\1', 'g')) AS text_sha256 FROM ''' + DOCS + " WHERE text IS NOT NULL",
    "redact_text": f"SELECT doc_id, anchor, {_redact('body')[1]} AS n_redacted, sha256({_redact('body')[0]}) AS body_sha256 FROM {BODIES} WHERE body IS NOT NULL",
    "redact_titles": f"SELECT key, {_redact('t')[1]} AS n_redacted, {_redact('t')[0]} AS text FROM (SELECT concat_ws(' ', doc_id, node_id) AS key, title AS t FROM {TITLES} WHERE title IS NOT NULL UNION ALL SELECT DISTINCT key, source_path FROM manifest WHERE source_path IS NOT NULL)",
    "file_names": r"SELECT key, regexp_replace(regexp_extract(source_path, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS doc_id, lower(regexp_extract(source_path, '[^/.](\.[^./]*)$', 1)) AS suffix, replace(replace(source_path, '/', '-'), ' ', '_') || '.md' AS flat_name FROM (SELECT DISTINCT key, source_path FROM manifest)",
    "atom_id": "SELECT atom_no, substr(sha256(lower(trim(coalesce(entity, ''))) || '|' || lower(trim(coalesce(parameter, ''))) || '|' || lower(trim(coalesce(condition, ''))) || '|' || coalesce(doc_id, '') || '|' || coalesce(section, '')), 1, 16) AS computed_id FROM (SELECT DISTINCT atom_no, entity, parameter, condition, doc_id, section FROM atoms)",
    "prompt_hash": f"SELECT doc_id, anchor, {PROMPT_SQL} AS prompt_hash FROM {BODIES}",
    "natural_sort": r"SELECT title, sha256((CASE WHEN regexp_matches(title, '^\d') THEN '0' ELSE '1' END) || array_to_string(list_transform(regexp_extract_all(lower(title), '\d+|\D+'), lambda p: CASE WHEN regexp_matches(p, '^\d') THEN '0' || lpad(regexp_replace(p, '^0+(.)', '\1'), 24, '0') ELSE '1' || p END), chr(1))) AS order_key_sha256, regexp_matches(title, '^\d') AS is_numbered FROM (SELECT DISTINCT title FROM sections WHERE title IS NOT NULL)",
    "cells_to_html": "SELECT r_name, '<table><tr><th colspan=\"2\">' || r_name || '</th></tr>' || string_agg('<tr><td>' || n_name || '</td><td>' || n_nationkey || '</td></tr>', '' ORDER BY n_name) || '</table>' AS html FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "pipe_table": "SELECT r_name, '| nation | key |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_name) AS markdown FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "format_value": "SELECT o_orderkey, '$' || format('{:,}', round(o_totalprice)::BIGINT) AS price, floor(o_totalprice)::BIGINT || '%' AS share, CASE WHEN strftime(o_orderdate, '%H:%M:%S') = '00:00:00' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ordered FROM orders",
    "parse_llm_json": r"SELECT record_id, length(l) AS n_chars, CASE WHEN json_valid(l) THEN json_array_length(l) END AS n_items FROM (SELECT record_id, nullif(regexp_extract(any_value(taxonomy_json), '(?s)(\[.*\])', 1), '') AS l FROM taxonomies GROUP BY record_id)",
}
