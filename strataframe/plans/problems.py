"""Queries of the general data problems (1, 2 and 7) over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import nested, references, units
from strataframe.tables import read


def _orphans(spark: SparkSession, sf_dir: str, report: bool = False) -> DataFrame:
    return references.all_orphans(read(spark, sf_dir, "edges"), read(spark, sf_dir, "atoms"), read(spark, sf_dir, "sections"), report)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("ref_field", "record_no")


def p1_orphans_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_report(_orphans(spark, sf_dir, True))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.agreeing(units.in_stated_units(read(spark, sf_dir, "atoms"), read(spark, sf_dir, "quantities")))


def p2_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = units.in_common_units(read(spark, sf_dir, "atoms"), read(spark, sf_dir, "quantities"))
    return values.select("atom_no", "parameter", "is_range", "lo", "hi", "common_unit", "unit_source", "posterior", "uncertain")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tagged rows of both tables of records, out of the written table."""
    return nested.stored(spark, read(spark, sf_dir, "index_trees"), read(spark, sf_dir, "taxonomies"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tagged(spark, sf_dir).filter((F.col("tag") == "node") & F.col("parent_key").isNotNull())
    return rows.select("record_kind", "record_id", F.col("key").alias("node_path"), F.col("parent_key").alias("parent_path"))


def _p7(tag: str):
    return lambda spark, sf_dir: nested.typed(tagged(spark, sf_dir), tag)


QUERIES = {"p1_found": p1_found, "p1_orphans_by_month": p1_orphans_by_month, "p2_found": p2_found, "p2_values": p2_values, "p7_found": p7_found, "p7_nodes": _p7("node"), "p7_assets": _p7("asset"), "p7_tables": _p7("table"), "p7_table_rows": _p7("table_row"), "p7_entries": _p7("entry"), "p7_caught": _p7("caught")}

_ORPHANS_SQL = r"""
WITH norm AS (
  SELECT 'edges.source_id' AS ref_field, edge_no AS record_no, 'atoms' AS kind, NULL AS own, source_id AS ref, min(loaded_at) AS t0 FROM edges GROUP BY ALL
  UNION ALL SELECT 'edges.target_id', edge_no, 'atoms', NULL, target_id, min(loaded_at) FROM edges GROUP BY ALL
  UNION ALL SELECT 'atoms.evidence_ref', atom_no, 'sections', doc_id, evidence_ref, min(loaded_at) FROM atoms GROUP BY ALL
), clean AS (
  SELECT ref_field, record_no, kind, lower(trim(own, chr(9)||chr(10)||chr(13)||' '||chr(160))) AS own, t0,
         lower(trim(replace(url_decode(ref), '\', '/'), chr(9)||chr(10)||chr(13)||' '||chr(160))) AS r
  FROM norm WHERE ref IS NOT NULL AND trim(ref, chr(9)||chr(10)||chr(13)||' '||chr(160)) <> ''
), keyed AS (
  SELECT ref_field, record_no, kind, t0,
         CASE WHEN kind = 'atoms' THEN r
              ELSE coalesce(nullif(regexp_extract(r, '^(?:[.]?/)*kb/(.*)/[^/]*$', 1), ''), own) || '#' || (CASE WHEN contains(r, '#') THEN regexp_extract(r, '#([^#]*)$', 1) ELSE r END) END AS key
  FROM clean
), targets AS (
  SELECT 'atoms' AS kind, lower(trim(id)) AS key, loaded_at AS s, retired_at AS e FROM atoms
  UNION ALL SELECT 'sections', lower(trim(doc_id)) || '#' || lower(trim(anchor)), loaded_at, removed_at FROM sections WHERE trim(anchor) <> ''
), found AS (
  SELECT * FROM keyed k WHERE NOT EXISTS (SELECT 1 FROM targets t WHERE t.kind = k.kind AND t.key = k.key AND t.s <= k.t0 AND (t.e IS NULL OR t.e > k.t0))
)
"""


def _unquoted(v: str) -> str:
    return f"CASE WHEN json_type({v}) = 'VARCHAR' AND json_valid({v}->>'$') THEN ({v}->>'$')::JSON ELSE {v} END"


def _listed(v: str) -> str:
    """The list that a JSON value stands for."""
    keys = f"json_keys({v})"
    by_number = f"list_transform(list_sort(list_transform({keys}, lambda k: (lpad(k, 20, '0'), k))), lambda p: json_extract({v}, '$.\"' || p[2] || '\"'))"
    return f"CASE json_type({v}) WHEN 'ARRAY' THEN json_extract({v}, '$[*]') WHEN 'OBJECT' THEN CASE WHEN len({keys}) > 0 AND len(list_filter({keys}, lambda k: NOT regexp_full_match(k, '\\d+'))) = 0 THEN {by_number} ELSE [{v}] END ELSE [] END"


_VALUES = "CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') WHEN 'OBJECT' THEN list_transform(json_keys(v), lambda k: json_extract(v, '$.\"' || k || '\"')) ELSE [] END"
#: kind, record_id, path, parent, i, v: all nodes of both tables; envelopes are opened six levels deep.
TREES = rf"""RECURSIVE once AS (SELECT record_id, any_value(index_json) AS j FROM index_trees WHERE record_id IS NOT NULL GROUP BY 1),
seen AS (SELECT record_id, 0 AS step, [0] AS place, j::JSON AS v FROM once WHERE json_valid(j)
  UNION ALL SELECT record_id, step + 1, list_append(place, i), CASE WHEN json_type(x) = 'VARCHAR' AND regexp_matches(x->>'$', '^\s*[\[{{]') AND json_valid(x->>'$') THEN (x->>'$')::JSON ELSE x END
  FROM (SELECT record_id, step, place, unnest({_VALUES}) AS x, generate_subscripts({_VALUES}, 1) AS i FROM seen WHERE json_type(v) IN ('ARRAY', 'OBJECT') AND coalesce(v->>'node_id', '') <> 'root' AND step < 6)),
roots AS (SELECT 'index_trees' AS kind, record_id, '1' AS path, 1 AS i, v FROM seen WHERE json_type(v) = 'OBJECT' AND v->>'node_id' = 'root' QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY step, place) = 1),
cats AS (SELECT record_id, any_value(taxonomy_json) AS j FROM taxonomies WHERE record_id IS NOT NULL GROUP BY 1),
lists AS (SELECT record_id, {_listed('w')} AS l FROM (SELECT record_id, {_unquoted("json_extract(j, '$.categories')")} AS w FROM (SELECT record_id, j::JSON AS j FROM cats WHERE json_valid(j)) WHERE json_type(j) = 'OBJECT')),
tops AS (SELECT 'taxonomies' AS kind, record_id, i::VARCHAR AS path, i, v FROM (SELECT record_id, unnest(l) AS v, generate_subscripts(l, 1) AS i FROM (SELECT record_id, list_filter(l, lambda x: json_type(x) = 'OBJECT') AS l FROM lists))),
tree AS (SELECT kind, record_id, path, NULL::VARCHAR AS parent, i, v FROM roots UNION ALL SELECT kind, record_id, path, NULL, i, v FROM tops
  UNION ALL SELECT kind, record_id, path || '.' || i, path, i, x FROM (SELECT kind, record_id, path, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT kind, record_id, path, {_listed('w')} AS l FROM (SELECT kind, record_id, path, {_unquoted("json_extract(v, '$.children')")} AS w FROM tree))) WHERE json_type(x) = 'OBJECT')"""
_INT = lambda c: f"CASE WHEN json_type(v, '$.{c}') IN ('UBIGINT', 'BIGINT') THEN (v->>'{c}')::INT END AS {c}"
ORACLE = {
    "p7_found": f"WITH {TREES} SELECT kind AS record_kind, record_id, path AS node_path, parent AS parent_path FROM tree WHERE parent IS NOT NULL",
    "p7_nodes": f"WITH {TREES} SELECT kind AS record_kind, record_id, path AS node_path, parent AS parent_path, i AS ord, v->>'node_id' AS node_id, v->>'slug' AS slug, v->>'title' AS title, v->>'anchor' AS anchor, {_INT('level')}, v->>'layer' AS layer, {_INT('page_start')}, {_INT('page_end')}, v->>'language' AS language FROM tree",
    "p1_found": _ORPHANS_SQL + "SELECT ref_field, record_no FROM found",
    "p1_orphans_by_month": _ORPHANS_SQL + "SELECT split_part(ref_field, '.', 1) AS table_name, split_part(ref_field, '.', 2) AS field, strftime(t0, '%Y-%m') AS month, count(*) AS n_orphans FROM found GROUP BY 1, 2, 3",
}


def _items(source: str, field: str, mark: str, columns: str) -> str:
    """Items of a list inside each row of ``source`` (kind, record_id, path, v), objects only."""
    w = _unquoted(f"json_extract(v, '$.{field}')")
    return f"(SELECT kind, record_id, path || '/{mark}' || i AS item, path AS above, i, x {columns} FROM (SELECT kind, record_id, path, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT kind, record_id, path, {_listed('w')} AS l FROM (SELECT kind, record_id, path, {w} AS w FROM {source}))))"


_HEAD = "kind AS record_kind, record_id, item AS item_path, above AS parent_path, i AS ord"
_X_INT = "CASE WHEN json_type(x, '$.page') IN ('UBIGINT', 'BIGINT') THEN (x->>'page')::INT END AS page"
_TABLES = _items("tree", "tables", "t", "")
_FIELDS = ("prd_headings", "pes_headings", "linked_specs", "keywords")
ORACLE |= {
    "p7_assets": f"WITH {TREES} SELECT {_HEAD}, x->>'kind' AS kind, x->>'rel_path' AS rel_path, {_X_INT}, x->>'alt' AS alt FROM {_items('tree', 'assets', 'a', '')} WHERE json_type(x) = 'OBJECT'",
    "p7_tables": f"WITH {TREES} SELECT {_HEAD}, x->>'anchor' AS anchor, {_X_INT} FROM {_TABLES} WHERE json_type(x) = 'OBJECT'",
    "p7_table_rows": f"WITH {TREES}, t AS (SELECT kind, record_id, item AS path, x AS v FROM {_TABLES} WHERE json_type(x) = 'OBJECT'), r AS (SELECT kind, record_id, item, above, i, {_unquoted('x')} AS w FROM {_items('t', 'rows', 'r', '')}) SELECT {_HEAD}, list_transform({_listed('w')}, lambda c: CASE WHEN json_type(c) = 'NULL' THEN NULL ELSE c->>'$' END) AS cells FROM r",
    "p7_entries": f"WITH {TREES}, e AS (" + " UNION ALL ".join(f"SELECT *, '{f}' AS field FROM {_items('tree', f, f, '')}" for f in _FIELDS) + f") SELECT {_HEAD}, field, x->>'$' AS value FROM e WHERE json_type(x) <> 'NULL'",
    "p7_caught": "SELECT 'k' AS record_kind, 0::BIGINT AS record_id, '' AS item_path, '' AS parent_path, 0 AS ord, '' AS error WHERE false",
}
