"""Queries over keyed tables, logs, facts and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.operators import facts, pages, routing, store, topics
from strataframe.plans.section_queries import _WS, LEAVES, NODES, leaves, nodes
from strataframe.plans.text_queries import BODIES, PROMPT_SQL, _prompts, slug_sql, tokens_sql
from strataframe.plans.text_queries import _bodies as bodies
from strataframe.tables import read, squeezed

# A small category tree for routing; rules are numbered in the order in which they hold.
SPECS = [(1, "thermal", "*thermal*"), (2, "audio", "*speaker*"), (2, "audio", "*acoustic*"), (3, "power", "*battery*"), (3, "power", "*charger*"), (4, "mech", "?1*hinge*")]
KEYWORDS = [(1, "thermal", "thermal pad fan shroud"), (2, "audio", "speaker bracket microphone boot"), (3, "power", "battery tray charging coil power button"), (4, "mech", "hinge module latch spring keyset frame rear cover")]
HEADINGS = [(1, "thermal", "thermal"), (1, "thermal", "fan"), (3, "power", "battery"), (4, "mech", "hinge")]
OWN_DOC = "M0900001 Platform PES"
ADAPTERS = [".pdf", ".docx", ".xlsx"]
CUTOFF = "2025-01-01"


def _values(s: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return s.createDataFrame(rows, schema)


def manifest_upsert(s: SparkSession, d: str) -> DataFrame:
    m = store.upserted(read(s, d, "manifest"), "key", ["loaded_at"])
    return m.select("key", "source_path", "source_sha256", "status", "adapter_name", "output_sha256")


def manifest_status_merge(s: SparkSession, d: str) -> DataFrame:
    return store.status_merged(read(s, d, "manifest"), "key", "loaded_at", "status", ["source_sha256", "adapter_name", "output_sha256"])


def incremental_plan(s: SparkSession, d: str) -> DataFrame:
    """What has to be read again, of all files, against the manifest as it was on a day."""
    m = read(s, d, "manifest")
    then = store.upserted(m.filter(F.col("loaded_at") < F.lit(CUTOFF).cast("timestamp_ntz")), "key", ["loaded_at"])
    now = store.upserted(m, "key", ["loaded_at"])
    return store.incremental_plan(now, then, _values(s, [(a,) for a in ADAPTERS], "suffix string"))


def source_plan(s: SparkSession, d: str) -> DataFrame:
    """What has to be converted again, with the adapter's name as the converter's version."""
    m = read(s, d, "manifest").withColumns({"version": F.col("adapter_name"), "policy_sha256": F.lit(None).cast("string")})
    then = store.upserted(m.filter(F.col("loaded_at") < F.lit(CUTOFF).cast("timestamp_ntz")), "key", ["loaded_at"])
    now = store.upserted(m, "key", ["loaded_at"])
    return store.source_plan(now.select("key", "source_sha256"), then, "pdf_v2")


def spec_documents(s: SparkSession, d: str) -> DataFrame:
    """Specifications by their names, beside the own document."""
    n = nodes(s, d)
    own = routing.own_document(n)
    return routing.specifications(n, "*pes*", own).withColumn("own", F.lit(False)).unionByName(own.withColumn("own", F.lit(True)))


def run_report(s: SparkSession, d: str) -> DataFrame:
    m = store.upserted(read(s, d, "manifest"), "key", ["loaded_at"])
    return store.run_report(m.withColumn("domain", F.regexp_extract("source_path", "^in/([^/]*)/", 1)), "domain")


def verify_hashes(s: SparkSession, d: str) -> DataFrame:
    """Documents whose first and last recorded output differ."""
    m = read(s, d, "manifest")
    old = m.groupBy("key").agg(F.min_by("output_sha256", "loaded_at").alias("output_sha256"))
    new = m.filter("status = 'ok'").groupBy("key").agg(F.max_by("output_sha256", "loaded_at").alias("output_sha256"))
    return store.changed_outputs(old, new, "key", "output_sha256")


def history_recall(s: SparkSession, d: str) -> DataFrame:
    return store.recall(read(s, d, "events"), 20, event_type="click").select("event_id", "ts", "user_id")


def preference_latest(s: SparkSession, d: str) -> DataFrame:
    """The last event of each user as a keyed store, without users whose last event has no value."""
    e = store.upserted(read(s, d, "events").select("user_id", "ts", "event_id", "event_type", "value"), "user_id", ["ts", "event_id"])
    return e.filter("value is not null").select("user_id", "event_id", "event_type")


def source_discovery(s: SparkSession, d: str) -> DataFrame:
    m = read(s, d, "manifest").select("key", "source_path").distinct()
    return m.filter(~store.skip_rule(F.col("source_path"), ["qa"])).select("key", X.suffix(F.col("source_path")).alias("suffix"))


def manifest_listing(s: SparkSession, d: str) -> DataFrame:
    m = store.upserted(read(s, d, "manifest"), "key", ["loaded_at"])
    return m.filter("status = 'ok'").select("source_path", "status", "adapter_name", F.substring("output_sha256", 1, 12).alias("output"))


def _atoms(s: SparkSession, d: str) -> DataFrame:
    c = ["atom_no", "doc_id", "id", "entity", "parameter", "value", "unit", "type", "condition", "section", "evidence_ref", "confidence"]
    return read(s, d, "atoms").select(*c).distinct()


def coerce_atoms(s: SparkSession, d: str) -> DataFrame:
    return facts.coerced_atoms(_atoms(s, d)).select("atom_no", "id", "entity", "parameter", "value", "type", "confidence", "flag")


def _classified(s: SparkSession, d: str) -> DataFrame:
    sections = read(s, d, "content_sections").select("doc_id", "anchor", "category").distinct()
    return facts.classified(_atoms(s, d), sections)


def module_classify(s: SparkSession, d: str) -> DataFrame:
    return _classified(s, d).select("atom_no", "module", "pending")


def module_summary(s: SparkSession, d: str) -> DataFrame:
    return _classified(s, d).groupBy("module").agg(F.count("*").alias("n_atoms"), F.sum(F.col("pending").cast("int")).alias("n_pending"))


def entity_see_also(s: SparkSession, d: str) -> DataFrame:
    return facts.see_also(_classified(s, d))


def multi_doc_entities(s: SparkSession, d: str) -> DataFrame:
    return facts.multi_doc_entities(_atoms(s, d))


def edge_validate(s: SparkSession, d: str) -> DataFrame:
    e = read(s, d, "edges").select("edge_no", "doc_id", "source_id", "target_id", "relation", "evidence_ref", "confidence").distinct()
    return facts.valid_edges(e, _atoms(s, d))


def cross_domain_entities(s: SparkSession, d: str) -> DataFrame:
    """Entities that documents of several domains name."""
    m = read(s, d, "manifest").select(X.file_stem(F.col("source_path")).alias("doc_id"), F.regexp_extract("source_path", "^in/([^/]*)/", 1).alias("domain")).distinct()
    a = _atoms(s, d).select(F.lower(F.trim("entity")).alias("key"), "doc_id").filter("key != ''").distinct()
    return facts.cross_domain(a.join(m, "doc_id").select("key", "domain", F.col("doc_id").alias("link")), 3)


def cached_lookup(s: SparkSession, d: str) -> DataFrame:
    """Prompts with the recorded answer of their hash; answers are recorded for the titles of the own document."""
    p = _prompts(s, d)
    r = _responses(s, d)
    return p.join(r, "prompt_hash", "left").select("doc_id", "anchor", "prompt_hash", F.coalesce("response", F.lit("MISSING")).alias("response"))


def _responses(s: SparkSession, d: str) -> DataFrame:
    return _prompts(s, d).join(nodes(s, d).filter(F.col("doc_id") == OWN_DOC).select("title").distinct(), "title", "left_semi").groupBy("prompt_hash").agg(F.min("title").alias("response"))


def cached_missing(s: SparkSession, d: str) -> DataFrame:
    return _prompts(s, d).select("prompt_hash").distinct().join(_responses(s, d), "prompt_hash", "left_anti")


def verify_quote(s: SparkSession, d: str) -> DataFrame:
    """Whether each section's title stands in its body as a quote."""
    found = facts.quote_found(F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))
    return bodies(s, d).select("doc_id", "anchor", found.alias("found"))


def resolve_pins(s: SparkSession, d: str) -> DataFrame:
    """Numbers in square brackets as pins on the evidence of their document."""
    n = leaves(s, d).groupBy("doc_id").agg(F.count("*").alias("n_evidence"))
    pins = bodies(s, d).select("doc_id", "anchor", F.explode(F.array_distinct(F.regexp_extract_all("body", F.lit(r"\[(\d{1,6})\]"), F.lit(1)))).alias("pin"))
    return pins.join(n, "doc_id", "left").select("doc_id", "anchor", F.col("pin").cast("int").alias("pin"), F.col("pin").cast("int").between(F.lit(1), F.coalesce("n_evidence", F.lit(0))).alias("resolved"))


def wiki_catalog(s: SparkSession, d: str) -> DataFrame:
    """The links of each domain's documents with their titles, a row a line; no domain is gathered."""
    m = read(s, d, "manifest").select("source_path").distinct()
    stem = X.file_stem(F.col("source_path"))
    rows = m.select(F.regexp_extract("source_path", "^in/([^/]*)/", 1).alias("domain"), F.concat(F.lit("- "), X.wikilink(F.concat(F.regexp_extract("source_path", "^in/([^/]*)/", 1), F.lit("/"), stem), stem)).alias("line"))
    return rows.distinct()


def _specs(s: SparkSession) -> DataFrame:
    return _values(s, SPECS, "ord int, slug string, glob string")


def _words(s: SparkSession) -> DataFrame:
    return _values(s, KEYWORDS, "ord int, slug string, keyword string")


def route_linked_spec(s: SparkSession, d: str) -> DataFrame:
    return routing.by_spec(nodes(s, d), _specs(s))


def route_keyword(s: SparkSession, d: str) -> DataFrame:
    return routing.by_keywords(nodes(s, d).select("title").filter("title is not null"), _words(s))


def prd_section_map(s: SparkSession, d: str) -> DataFrame:
    return routing.by_heading(nodes(s, d), _values(s, HEADINGS, "ord int, slug string, heading string"))


def _route(s: SparkSession, d: str, doc_words: bool) -> DataFrame:
    head = _values(s, HEADINGS, "ord int, slug string, heading string")
    return routing.route(leaves(s, d), _specs(s), _words(s), head, nodes(s, d), OWN_DOC, doc_words)


def route_evidence_v1(s: SparkSession, d: str) -> DataFrame:
    return _route(s, d, False)


def route_evidence_v2(s: SparkSession, d: str) -> DataFrame:
    return _route(s, d, True)


def route_paths(s: SparkSession, d: str) -> DataFrame:
    """Evidence led to paths; sections of owned specifications to their own."""
    return _routed_paths(s, d).select("doc_id", "anchor", "title", F.col("slug").alias("path"))


def _routed_paths(s: SparkSession, d: str) -> DataFrame:
    head = _values(s, HEADINGS, "ord int, slug string, heading string")
    return routing.route(leaves(s, d), _specs(s), _words(s), head, nodes(s, d), OWN_DOC, True, spec_section_map(s, d))


def topics_by_path(s: SparkSession, d: str) -> DataFrame:
    """Topics of the evidence of each category."""
    return topics.topics_by_path(_route(s, d, True).withColumnRenamed("slug", "path"), 0.5)


def entity_pages(s: SparkSession, d: str) -> DataFrame:
    """Pages of the documents that topics of several categories cite: their links back, and the page's text."""
    cited = _route(s, d, True).select(F.col("doc_id").alias("key"), F.col("slug").alias("domain"), F.col("slug").alias("category_path"), X.slug(F.col("title"), "topic").alias("slug"))
    found = pages.candidates(cited)
    told = found.withColumn("summary", F.concat(F.lit("Shared by "), F.array_join("domains", " and ")))
    texts = pages.entity_pages(told)
    links = F.array_join(F.transform("links", lambda x: F.concat(F.lit("- [["), x, F.lit("|"), F.substring_index(x, "/", -1), F.lit("]]"))), "\n")
    end = texts.select("key", F.substring_index("markdown", "\n## Appears in\n\n", -1).alias("tail"))
    return found.join(end, "key").select("key", F.array_join("domains", ",").alias("domains"), F.size("links").alias("n_links"), X.sha(F.col("tail")).alias("links_sha256"), (F.col("tail") == F.concat(links, F.lit("\n"))).alias("whole"))


def section_prompts(s: SparkSession, d: str) -> DataFrame:
    """The prompt of every content section, by its hash."""
    m = pages.section_messages("Extract the test items.", "Evidence:\n{evidence_content}\nAnswer as a JSON list.", F.col("anchor"), F.col("title"), F.col("body"))
    return bodies(s, d).select("doc_id", "anchor", X.sha(F.get(m, F.lit(1))["content"]).alias("user_sha256"), F.length(F.get(m, F.lit(1))["content"]).alias("n_chars"))


def route_counts(s: SparkSession, d: str) -> DataFrame:
    return _route(s, d, True).groupBy("slug").agg(F.count("*").alias("n_evidence"), F.count_distinct("doc_id").alias("n_docs"))


def taxonomy_v1(s: SparkSession, d: str) -> DataFrame:
    """A category for each level-1 heading of the own document, with the words of the titles below."""
    n = nodes(s, d).filter(F.col("doc_id") == OWN_DOC)
    top = routing.ancestors(n, 1)
    heads = n.filter("depth = 1").select(F.col("node_id").alias("top"), F.col("title").alias("category"), "ord")
    words = top.join(n.select("node_id", "title"), "node_id").filter("node_id != top").select("top", F.explode(X.tokens(F.col("title"))).alias("word")).groupBy("top").agg(F.array_join(F.array_sort(F.collect_set("word")), " ").alias("keywords"))
    return heads.join(words, "top", "left").select("ord", X.slug(F.col("category"), "unknown", False).alias("slug"), "category", F.coalesce("keywords", F.lit("")).alias("keywords"))


SUBSYSTEMS = [("thermal", "pads", "Thermal pad", "*thermal*"), ("audio", "bracket", "Speaker bracket", None), ("audio", "boot", "Microphone boot", None), ("power", "tray", "Battery tray", "*battery*")]
SYSTEMS = [("audio", "*speaker*"), ("power", "*charger*")]


def spec_owners(s: SparkSession, d: str) -> DataFrame:
    return routing.spec_owners(nodes(s, d), _values(s, SUBSYSTEMS, "system string, subsystem string, title string, glob string"), _values(s, SYSTEMS, "system string, glob string"))


def spec_section_map(s: SparkSession, d: str) -> DataFrame:
    """Sections of owned documents by all parts and functions of their owners; headings without a title
    are neither."""
    n, o = nodes(s, d).filter(squeezed(F.col("title")) != ""), spec_owners(s, d)
    one = n.filter("depth = 1").select("doc_id", F.col("node_id").alias("top"), X.slug(F.col("title"), "unknown", False).alias("part"))
    two = n.filter("depth = 2").select("doc_id", F.col("parent_node_id").alias("top"), X.slug(F.col("title"), "unknown", False).alias("function"))
    parts = one.join(two, ["doc_id", "top"], "left").join(o, "doc_id").select("system", "subsystem", "part", "function").distinct()
    return routing.spec_sections(n, o, parts)


def taxonomy_v2(s: SparkSession, d: str) -> DataFrame:
    """All nodes of the category trees of all documents, in four layers."""
    return routing.taxonomy_nodes(nodes(s, d), spec_owners(s, d), _values(s, SUBSYSTEMS, "system string, subsystem string, title string, glob string"), OWN_DOC)


def fact_pages(s: SparkSession, d: str) -> DataFrame:
    """Rendered rows of a document's facts, counted and hashed by module."""
    c = _classified(s, d).select("atom_no", "module")
    a = _atoms(s, d).join(c, "atom_no")
    line = F.concat(F.lit("- "), F.coalesce("entity", F.lit("")), F.lit(" / "), F.coalesce("parameter", F.lit("")), F.lit(": "), F.coalesce("value", F.lit("—")))
    return a.groupBy("doc_id", "module").agg(F.count("*").alias("n_lines"), F.sum(F.length(line)).alias("n_chars"), F.min(line).alias("first_line"))



QUERIES = {f.__name__: f for f in (manifest_upsert, manifest_status_merge, incremental_plan, source_plan, spec_documents, run_report, verify_hashes, history_recall, preference_latest, source_discovery, manifest_listing, coerce_atoms, module_classify, module_summary, entity_see_also, multi_doc_entities, edge_validate, cross_domain_entities, cached_lookup, cached_missing, verify_quote, resolve_pins, wiki_catalog, route_linked_spec, route_keyword, prd_section_map, route_evidence_v1, route_evidence_v2, route_paths, topics_by_path, entity_pages, section_prompts, route_counts, taxonomy_v1, taxonomy_v2, spec_owners, spec_section_map, fact_pages)}

_STEM = r"regexp_replace(regexp_extract(source_path, '([^/]*)$', 1), '(.)\.[^.]*$', '\1')"
_DOMAIN = "regexp_extract(source_path, '^in/([^/]*)/', 1)"
_LATEST = "(SELECT * FROM manifest QUALIFY row_number() OVER (PARTITION BY key ORDER BY loaded_at DESC) = 1)"
_ATOMS = "(SELECT DISTINCT atom_no, doc_id, id, entity, parameter, value, unit, type, condition, section, evidence_ref, confidence FROM atoms)"
_AID = "substr(sha256(lower(trim(coalesce(entity, ''))) || '|' || lower(trim(coalesce(parameter, ''))) || '|' || lower(trim(coalesce(condition, ''))) || '|' || coalesce(doc_id, '') || '|' || coalesce(section, '')), 1, 16)"
_WSP = "chr(9)||chr(10)||chr(13)||' '||chr(160)"


def _module_sql() -> str:
    cat = " ".join(f"WHEN contains(lower(coalesce(category, '')), '{k}') THEN '{m}'" for k, m in facts.CATEGORY_TO_MODULE)
    key = " ".join("WHEN " + " OR ".join(f"contains(hay, '{w}')" for w in ws) + f" THEN '{m}'" for m, ws in facts.KEYWORD_TO_MODULE)
    return f"CASE {cat} {key} END"


_CLASSIFIED = f"(WITH c AS (SELECT doc_id, anchor AS section, min(category) AS category FROM content_sections GROUP BY 1, 2), a AS (SELECT atom_no, doc_id, section, entity, lower(coalesce(entity, '') || ' ' || coalesce(parameter, '')) AS hay FROM {_ATOMS}) SELECT atom_no, a.doc_id, entity, coalesce({_module_sql()}, 'Subsystems') AS module, {_module_sql()} IS NULL AS pending FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.section = c.section)"


def _rows(rows: list[tuple]) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


_GLOB = "lower(doc_id) GLOB lower(pattern)"
_SPEC = f"(SELECT doc_id, arg_min(slug, ord) AS slug FROM (SELECT DISTINCT doc_id FROM sections) JOIN ({_rows(SPECS)}) s(ord, slug, pattern) ON {_GLOB} GROUP BY 1)"
_TITLES = "(SELECT DISTINCT title FROM sections WHERE title IS NOT NULL)"


def _kw(source: str) -> str:
    return f"(WITH w AS (SELECT DISTINCT ord, slug, unnest({tokens_sql('keyword')}) AS word FROM ({_rows(KEYWORDS)}) k(ord, slug, keyword)), t AS (SELECT title, unnest({tokens_sql('title')}) AS word FROM {source}), n AS (SELECT title, ord, slug, count(*) AS n FROM t JOIN w USING (word) GROUP BY 1, 2, 3) SELECT title, slug, n AS overlap FROM n QUALIFY row_number() OVER (PARTITION BY title ORDER BY n DESC, ord) = 1)"


def _head(where: str) -> str:
    return f"(WITH n AS (SELECT * FROM {NODES} WHERE {where}), t AS (SELECT doc_id, node_id, depth, (SELECT arg_max(b.node_id, b.ord) FROM n b WHERE b.doc_id = a.doc_id AND b.depth = 1 AND b.ord <= a.ord) AS top FROM n a WHERE depth >= 1), m AS (SELECT doc_id, node_id AS top, arg_min(slug, r.ord) AS slug FROM n JOIN ({_rows(HEADINGS)}) r(ord, slug, heading) ON depth = 1 AND contains(lower(coalesce(title, '')), heading) GROUP BY 1, 2) SELECT t.doc_id, t.node_id, m.slug FROM t JOIN m ON t.doc_id = m.doc_id AND t.top = m.top)"


_OWN = f"lower(trim(doc_id)) = '{OWN_DOC.lower()}'"


def _route_sql(doc_words: bool, node: bool = False) -> str:
    docs = "(SELECT DISTINCT doc_id AS title FROM sections)"
    more = f" LEFT JOIN (SELECT title AS doc_id, slug AS s4 FROM {_kw(docs)}) w4 ON e.doc_id = w4.doc_id" if doc_words else ""
    return f"SELECT e.doc_id, {'e.node_id, ' if node else ''}e.anchor, e.title, coalesce(s1, s2, s3, {'s4, ' if doc_words else ''}'_uncategorized') AS slug FROM {LEAVES} e LEFT JOIN (SELECT doc_id, node_id, slug AS s1 FROM {_head(_OWN)}) h ON e.doc_id = h.doc_id AND e.node_id = h.node_id LEFT JOIN (SELECT doc_id, slug AS s2 FROM {_SPEC} WHERE NOT {_OWN}) p ON e.doc_id = p.doc_id LEFT JOIN (SELECT title, slug AS s3 FROM {_kw(_TITLES)}) k ON e.title = k.title{more}"


_PROMPTS = f"(SELECT doc_id, anchor, title, {PROMPT_SQL} AS prompt_hash FROM {BODIES})"
_RESPONSES = f"(SELECT prompt_hash, min(title) AS response FROM {_PROMPTS} WHERE title IN (SELECT title FROM sections WHERE doc_id = '{OWN_DOC}') GROUP BY 1)"
_SLUG2 = r"coalesce(nullif(trim(regexp_replace(lower(trim(title, {w})), '[^a-z0-9\x{{4e00}}-\x{{9fff}}]+', '-', 'g'), '-'), ''), 'unknown')".format(w=_WSP)
_OWNERS = f"(WITH d AS (SELECT DISTINCT doc_id FROM sections), u AS (SELECT * FROM ({_rows([tuple(chr(0) if x is None else x for x in r) for r in SUBSYSTEMS])}) t(system, subsystem, title, pattern)), a AS (SELECT DISTINCT doc_id, system, subsystem FROM d JOIN u ON lower(doc_id) GLOB lower(pattern)), r AS (SELECT doc_id, unnest({tokens_sql('doc_id')}) AS word FROM d WHERE doc_id NOT IN (SELECT doc_id FROM a)), y AS (SELECT system, pattern FROM ({_rows(SYSTEMS)}) t(system, pattern)), w AS (SELECT system, subsystem, unnest({tokens_sql('title')}) AS word FROM u) SELECT * FROM a UNION SELECT r.doc_id, w.system, w.subsystem FROM r JOIN y ON lower(r.doc_id) GLOB lower(y.pattern) JOIN w ON w.system = y.system AND w.word = r.word)".replace(chr(0), "-")
_LINE = "'- ' || coalesce(entity, '') || ' / ' || coalesce(parameter, '') || ': ' || coalesce(value, '—')"
ORACLE = {
    "manifest_upsert": f"SELECT key, source_path, source_sha256, status, adapter_name, output_sha256 FROM {_LATEST}",
    "manifest_status_merge": "SELECT key, arg_max_null(status, loaded_at) AS status, arg_max(source_sha256, loaded_at) AS source_sha256, arg_max(adapter_name, loaded_at) AS adapter_name, arg_max(output_sha256, loaded_at) AS output_sha256 FROM manifest GROUP BY key",
    "incremental_plan": rf"WITH o AS (SELECT * FROM manifest WHERE loaded_at < TIMESTAMP '{CUTOFF}' QUALIFY row_number() OVER (PARTITION BY key ORDER BY loaded_at DESC) = 1) SELECT n.key, CASE WHEN lower(regexp_extract(n.source_path, '[^/.](\.[^./]*)$', 1)) NOT IN ('.pdf', '.docx', '.xlsx') THEN 'skipped' WHEN o.source_sha256 = n.source_sha256 AND o.status = 'ok' THEN 'unchanged' ELSE 'extract' END AS action FROM {_LATEST} n LEFT JOIN o USING (key)",
    "source_plan": f"WITH o AS (SELECT * FROM manifest WHERE loaded_at < TIMESTAMP '{CUTOFF}' QUALIFY row_number() OVER (PARTITION BY key ORDER BY loaded_at DESC) = 1) SELECT n.key, CASE WHEN o.source_sha256 = n.source_sha256 AND o.status = 'ok' AND o.adapter_name = 'pdf_v2' THEN 'unchanged' ELSE 'convert' END AS action FROM {_LATEST} n LEFT JOIN o USING (key)",
    "spec_documents": "WITH o AS (SELECT min(doc_id) AS doc_id FROM sections WHERE contains(lower(doc_id), 'prd') OR contains(lower(doc_id), 'product requirements')) SELECT DISTINCT doc_id, false AS own FROM sections WHERE lower(doc_id) GLOB '*pes*' AND doc_id NOT IN (SELECT doc_id FROM o WHERE doc_id IS NOT NULL) UNION ALL SELECT doc_id, true FROM o WHERE doc_id IS NOT NULL",
    "run_report": f"SELECT *, CASE WHEN n_failed = 0 THEN 'ok' WHEN n_ok > 0 THEN 'partial' ELSE 'failed' END AS overall FROM (SELECT {_DOMAIN} AS domain, count(*) AS n, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'skipped') AS n_skipped, count(*) FILTER (status = 'failed') AS n_failed FROM {_LATEST} GROUP BY 1)",
    "verify_hashes": "WITH a AS (SELECT key, arg_min_null(output_sha256, loaded_at) AS recorded FROM manifest GROUP BY 1), b AS (SELECT key, arg_max_null(output_sha256, loaded_at) AS actual FROM manifest WHERE status = 'ok' GROUP BY 1) SELECT key, recorded, actual FROM a FULL JOIN b USING (key) WHERE recorded IS DISTINCT FROM actual",
    "history_recall": "SELECT event_id, ts, user_id FROM events WHERE event_type = 'click' ORDER BY event_id DESC LIMIT 20",
    "preference_latest": "SELECT user_id, event_id, event_type FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE value IS NOT NULL",
    "source_discovery": r"SELECT key, lower(regexp_extract(source_path, '[^/.](\.[^./]*)$', 1)) AS suffix FROM (SELECT DISTINCT key, source_path FROM manifest) WHERE NOT list_has_any(string_split(source_path, '/'), ['kb', '.git', '__pycache__', '.venv', 'venv', 'node_modules', 'qa']) AND NOT source_path LIKE '%.tmp'",
    "manifest_listing": f"SELECT source_path, status, adapter_name, substr(output_sha256, 1, 12) AS output FROM {_LATEST} WHERE status = 'ok'",
    "coerce_atoms": f"SELECT atom_no, {_AID} AS id, trim(coalesce(entity, ''), {_WSP}) AS entity, trim(coalesce(parameter, ''), {_WSP}) AS parameter, nullif(trim(value, {_WSP}), '') AS value, CASE WHEN lower(trim(type)) IN ('requirement', 'behavior', 'constraint', 'spec') THEN lower(trim(type)) ELSE 'spec' END AS type, round_even(coalesce(CASE WHEN isnan(confidence) THEN 0.0 ELSE confidence END, 0.0), 2) AS confidence, CASE WHEN nullif(trim(value, {_WSP}), '') IS NULL OR coalesce(lower(trim(type)) NOT IN ('requirement', 'behavior', 'constraint', 'spec'), true) THEN '待验证' ELSE '' END AS flag FROM {_ATOMS}",
    "module_classify": f"SELECT atom_no, module, pending FROM {_CLASSIFIED}",
    "module_summary": f"SELECT module, count(*) AS n_atoms, sum(pending::INT) AS n_pending FROM {_CLASSIFIED} GROUP BY 1",
    "entity_see_also": f"WITH m AS (SELECT DISTINCT lower(trim(entity, {_WSP})) AS entity, module FROM {_CLASSIFIED} WHERE trim(coalesce(entity, ''), {_WSP}) <> '') SELECT a.entity, a.module, string_agg(b.module, ', ' ORDER BY b.module) AS others FROM m a JOIN m b ON a.entity = b.entity AND a.module <> b.module GROUP BY 1, 2",
    "multi_doc_entities": f"SELECT lower(trim(entity, {_WSP})) AS entity, count(DISTINCT doc_id) AS n_docs, count(DISTINCT atom_no) AS n_atoms FROM {_ATOMS} WHERE trim(coalesce(entity, ''), {_WSP}) <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2",
    "edge_validate": f"WITH e AS (SELECT DISTINCT edge_no, doc_id, trim(coalesce(source_id, ''), {_WSP}) AS source_id, trim(coalesce(target_id, ''), {_WSP}) AS target_id, lower(trim(coalesce(relation, ''), {_WSP})) AS relation, trim(coalesce(evidence_ref, ''), {_WSP}) AS ref, coalesce(confidence, 0.0) AS confidence FROM edges), v AS (SELECT * FROM e WHERE relation IN ('depends_on', 'affects', 'constrained_by', 'validated_by', 'implemented_by') AND source_id <> target_id AND source_id IN (SELECT id FROM atoms) AND target_id IN (SELECT id FROM atoms)) SELECT source_id, relation, target_id, edge_no, CASE WHEN ref = '' THEN 'kb/' || doc_id || '/graph/atoms.json#' || source_id ELSE ref END AS evidence_ref, CASE WHEN ref = '' THEN least(confidence, 0.3) ELSE confidence END AS confidence, CASE WHEN ref = '' THEN '待验证' ELSE '' END AS flag FROM v QUALIFY row_number() OVER (PARTITION BY source_id, relation, target_id ORDER BY edge_no) = 1",
    "cross_domain_entities": f"WITH m AS (SELECT DISTINCT {_STEM} AS doc_id, {_DOMAIN} AS domain FROM manifest), a AS (SELECT DISTINCT lower(trim(entity)) AS key, doc_id FROM {_ATOMS} WHERE trim(entity) <> ''), x AS (SELECT key, domain, doc_id FROM a JOIN m USING (doc_id)) SELECT key, string_agg(DISTINCT domain, ',' ORDER BY domain) AS domains, count(DISTINCT doc_id) AS n_links FROM x GROUP BY 1 HAVING count(DISTINCT domain) >= 3",
    "cached_lookup": f"SELECT doc_id, anchor, p.prompt_hash, coalesce(response, 'MISSING') AS response FROM {_PROMPTS} p LEFT JOIN {_RESPONSES} r ON p.prompt_hash = r.prompt_hash",
    "cached_missing": f"SELECT DISTINCT prompt_hash FROM {_PROMPTS} p WHERE prompt_hash NOT IN (SELECT prompt_hash FROM {_RESPONSES})",
    "verify_quote": rf"SELECT doc_id, anchor, trim(regexp_replace(coalesce(title, ''), '[\s\x{{00A0}}\x{{3000}}\x{{2009}}\x{{202F}}]+', ' ', 'g')) <> '' AND contains(regexp_replace(coalesce(body, ''), '[\s\x{{00A0}}\x{{3000}}\x{{2009}}\x{{202F}}]+', ' ', 'g'), trim(regexp_replace(coalesce(title, ''), '[\s\x{{00A0}}\x{{3000}}\x{{2009}}\x{{202F}}]+', ' ', 'g'))) AS found FROM {BODIES}",
    "resolve_pins": rf"WITH n AS (SELECT doc_id, count(*) AS n FROM {LEAVES} GROUP BY 1), p AS (SELECT DISTINCT doc_id, anchor, unnest(regexp_extract_all(body, '\[(\d{{1,6}})\]', 1)) AS pin FROM {BODIES}) SELECT p.doc_id, anchor, pin::INT AS pin, pin::INT BETWEEN 1 AND coalesce(n, 0) AS resolved FROM p LEFT JOIN n USING (doc_id)",
    "wiki_catalog": f"SELECT DISTINCT {_DOMAIN} AS domain, '- [[' || {_DOMAIN} || '/' || {_STEM} || '|' || {_STEM} || ']]' AS line FROM manifest",
    "route_linked_spec": f"SELECT * FROM {_SPEC}",
    "route_keyword": f"SELECT * FROM {_kw(_TITLES)}",
    "prd_section_map": f"SELECT * FROM {_head('true')}",
    "route_evidence_v1": _route_sql(False),
    "route_evidence_v2": _route_sql(True),
    "route_paths": f"SELECT r.doc_id, r.anchor, r.title, CASE WHEN r.k = 1 AND NOT {_OWN.replace('doc_id', 'r.doc_id')} THEN r.path ELSE r.slug END AS path FROM (SELECT e.doc_id, e.anchor, e.title, e.slug, p.path, CASE WHEN p.path IS NOT NULL THEN 1 ELSE 0 END AS k FROM ({_route_sql(True, True)}) e LEFT JOIN ({{SPEC_MAP}}) p ON e.doc_id = p.doc_id AND e.node_id = p.node_id) r",
    "entity_pages": f"WITH c AS (SELECT DISTINCT doc_id AS key, slug AS domain, slug || '/' || {slug_sql('title', 'topic')} AS link FROM ({_route_sql(True)})), p AS (SELECT key, list_sort(list(DISTINCT domain)) AS d, list_sort(list(DISTINCT link)) AS l FROM c GROUP BY 1 HAVING count(DISTINCT domain) >= 2), t AS (SELECT *, array_to_string(list_transform(l, lambda x: '- [[' || x || '|' || regexp_extract(x, '([^/]*)$', 1) || ']]'), chr(10)) || chr(10) AS tail FROM p) SELECT key, array_to_string(d, ',') AS domains, len(l) AS n_links, sha256(tail) AS links_sha256, true AS whole FROM t",
    "section_prompts": f"SELECT doc_id, anchor, sha256(u) AS user_sha256, length(u) AS n_chars FROM (SELECT doc_id, anchor, 'Evidence:' || chr(10) || '[' || chr(10) || '  {{' || chr(10) || '    \"id\": ' || to_json(coalesce(anchor, ''))::VARCHAR || ',' || chr(10) || '    \"type\": \"text\",' || chr(10) || '    \"section\": ' || to_json(coalesce(title, ''))::VARCHAR || ',' || chr(10) || '    \"content\": ' || to_json(coalesce(body, ''))::VARCHAR || chr(10) || '  }}' || chr(10) || ']' || chr(10) || 'Answer as a JSON list.' AS u FROM {BODIES})",
    "route_counts": f"SELECT slug, count(*) AS n_evidence, count(DISTINCT doc_id) AS n_docs FROM ({_route_sql(True)}) GROUP BY 1",
    "taxonomy_v1": f"WITH n AS (SELECT * FROM {NODES} WHERE doc_id = '{OWN_DOC}'), t AS (SELECT node_id, title, (SELECT arg_max(b.node_id, b.ord) FROM n b WHERE b.depth = 1 AND b.ord <= a.ord) AS top FROM n a WHERE depth >= 1), w AS (SELECT top, string_agg(DISTINCT word, ' ' ORDER BY word) AS keywords FROM (SELECT top, unnest({tokens_sql('title')}) AS word FROM t WHERE node_id <> top) GROUP BY 1) SELECT ord, {_SLUG2} AS slug, title AS category, coalesce(keywords, '') AS keywords FROM n LEFT JOIN w ON n.node_id = w.top WHERE depth = 1",
    "spec_owners": f"SELECT doc_id, system, subsystem FROM {_OWNERS}",
    "spec_section_map": f"WITH n AS (SELECT *, {_SLUG2} AS slug FROM {NODES} WHERE trim(title, {_WS}) <> ''), o AS (SELECT * FROM {_OWNERS}), t AS (SELECT n.doc_id, n.node_id, o.system || '/' || o.subsystem || '/' || n.slug AS base FROM n JOIN o ON n.doc_id = o.doc_id WHERE depth = 1), f AS (SELECT DISTINCT t.base, n.slug AS function FROM t JOIN n ON t.doc_id = n.doc_id AND n.parent_node_id = t.node_id WHERE n.depth = 2), x AS (SELECT doc_id, node_id, base, base AS path FROM t UNION ALL SELECT t.doc_id, n.node_id, t.base, CASE WHEN f.function IS NULL THEN t.base ELSE t.base || '/' || f.function END FROM t JOIN n ON t.doc_id = n.doc_id AND n.parent_node_id = t.node_id AND n.depth = 2 LEFT JOIN f ON f.base = t.base AND f.function = n.slug) SELECT doc_id, node_id, arg_max(path, (base, path)) AS path FROM x GROUP BY 1, 2",
    "taxonomy_v2": f"""WITH n AS (SELECT doc_id, node_id, parent_node_id, ord, depth, trim(title, {_WS}) AS title, {_SLUG2} AS slug FROM {NODES} WHERE trim(title, {_WS}) <> ''),
a AS (SELECT doc_id, node_id AS top, ord AS top_ord, slug AS s1, title AS t1 FROM n WHERE depth = 1),
b AS (SELECT a.*, n.ord, n.node_id, n.slug AS s2, n.title AS t2 FROM a JOIN n ON n.doc_id = a.doc_id AND n.parent_node_id = a.top AND n.depth = 2),
o AS (SELECT * FROM {_OWNERS} WHERE doc_id <> '{OWN_DOC}'),
u AS (SELECT * FROM ({_rows([x[:3] for x in SUBSYSTEMS])}) t(system, subsystem, title)),
x AS (SELECT doc_id AS tree, 'system' AS layer, s1 AS path, s1 AS slug, t1 AS title, row_number() OVER (PARTITION BY doc_id, s1 ORDER BY top_ord DESC, top DESC) AS k FROM a
  UNION ALL SELECT doc_id, 'subsystem', s1 || '/' || s2, s2, t2, row_number() OVER (PARTITION BY doc_id, s1, s2 ORDER BY top_ord DESC, ord, node_id DESC) FROM b
  UNION ALL SELECT DISTINCT '{OWN_DOC}', 'system', system, system, system, 1 FROM u WHERE system NOT IN (SELECT s1 FROM a WHERE doc_id = '{OWN_DOC}')
  UNION ALL SELECT DISTINCT '{OWN_DOC}', 'subsystem', system || '/' || subsystem, subsystem, title, 1 FROM u WHERE (system, subsystem) NOT IN (SELECT (s1, s2) FROM b WHERE doc_id = '{OWN_DOC}')
  UNION ALL SELECT '{OWN_DOC}', 'part', system || '/' || subsystem || '/' || s1, s1, t1, row_number() OVER (PARTITION BY system, subsystem, s1 ORDER BY doc_id, top_ord, top) FROM a JOIN o USING (doc_id)
  UNION ALL SELECT '{OWN_DOC}', 'function', system || '/' || subsystem || '/' || s1 || '/' || s2, s2, t2, row_number() OVER (PARTITION BY system, subsystem, s1, s2 ORDER BY doc_id DESC, top_ord DESC, ord, node_id DESC) FROM b JOIN o USING (doc_id))
SELECT tree, layer, path, slug, title FROM x WHERE k = 1""",
    "fact_pages": f"SELECT a.doc_id, module, count(*) AS n_lines, sum(length({_LINE})) AS n_chars, min({_LINE}) AS first_line FROM {_ATOMS} a JOIN (SELECT atom_no, module FROM {_CLASSIFIED}) c USING (atom_no) GROUP BY 1, 2",
}
ORACLE["route_paths"] = ORACLE["route_paths"].replace("{SPEC_MAP}", ORACLE["spec_section_map"])
