"""Structural invariants as queries: each gives the rows that violate it, none if all is well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.tables import squeezed

# Layers of a category tree, from the top.
LAYERS = ("system", "subsystem", "part", "function")


def duplicate_anchors(docs: DataFrame) -> DataFrame:
    """Anchors that a text (doc_id, text) sets more than once: doc_id, anchor, n."""
    a = docs.select("doc_id", F.explode(X.anchors(F.col("text"))).alias("anchor"))
    return a.groupBy("doc_id", "anchor").agg(F.count("*").alias("n")).filter("n > 1")


def missing_anchors(leaves: DataFrame, bodies: DataFrame) -> DataFrame:
    """Leaves (doc_id, anchor) without a text of that anchor."""
    return leaves.select("doc_id", "anchor").filter("anchor != ''").distinct().join(bodies.select("doc_id", "anchor").distinct(), ["doc_id", "anchor"], "left_anti")


def asset_closure(refs: DataFrame, records: DataFrame, files: DataFrame) -> DataFrame:
    """doc_id, rel_path, rule of assets (doc_id, rel_path each) that texts refer to without a record, or without
    a file, and of files that neither texts nor records name."""
    key = ["doc_id", "rel_path"]
    refs, records, files = (df.select(*key).filter("rel_path is not null").distinct() for df in (refs, records, files))
    rules = (("not recorded", refs.join(records, key, "left_anti")), ("no file", refs.join(files, key, "left_anti")), ("orphan file", files.join(refs, key, "left_anti").join(records, key, "left_anti")))
    return rules[0][1].withColumn("rule", F.lit(rules[0][0])).unionByName(rules[1][1].withColumn("rule", F.lit(rules[1][0]))).unionByName(rules[2][1].withColumn("rule", F.lit(rules[2][0])))


def hash_truth(records: DataFrame, files: DataFrame) -> DataFrame:
    """path, recorded, actual of records (path, sha256) whose file (path, content) is missing or has
    another hash: of assets (H6) as of sources (H7)."""
    actual = files.select("path", F.sha2("content", 256).alias("actual"))
    both = records.select("path", F.col("sha256").alias("recorded")).join(actual, "path", "left")
    return both.filter(~F.col("recorded").eqNullSafe(F.col("actual")))


def missing_origins(declared: DataFrame, expected: DataFrame) -> DataFrame:
    """slug, source_sha256 of the sources behind a topic's evidence that it doesn't declare (H18)."""
    key = ["slug", "source_sha256"]
    return expected.select(*key).filter("source_sha256 is not null").distinct().join(declared.select(*key).distinct(), key, "left_anti")


def violations(**found: DataFrame) -> DataFrame:
    """invariant, doc_id, detail of the rows of several checks, by name; the detail is a row's other
    columns as text, in their order, nulls as nothing."""
    out = None
    for name, df in sorted(found.items()):
        rest = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns if c != "doc_id"]
        rows = df.select(F.lit(name).alias("invariant"), "doc_id", (F.concat_ws(" ", *rest) if rest else F.lit("")).alias("detail"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no checks")
    return out


def page_gaps(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages of a document (doc_id, n_pages) in no node's range (doc_id, page_start, page_end)."""
    ranges = nodes.filter("page_start <= page_end").select("doc_id", "page_start", "page_end").distinct().join(pages, "doc_id")  # a wrong last page can't make more rows than the document has pages
    ranges = ranges.select("doc_id", F.greatest("page_start", F.lit(1)).alias("a"), F.least("page_end", "n_pages").alias("b")).filter("a <= b")
    have = ranges.select("doc_id", F.explode(F.sequence("a", "b")).alias("page")).distinct()
    want = pages.filter("n_pages >= 1").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("n_pages"))).alias("page"))
    return want.join(have, ["doc_id", "page"], "left_anti")


def page_bounds(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Nodes whose range is turned round or leaves the document."""
    return nodes.join(pages, "doc_id").filter((F.col("page_start") > F.col("page_end")) | (F.col("page_start") < 1) | (F.col("page_end") > F.col("n_pages")))


def untitled_documents(nodes: DataFrame) -> DataFrame:
    """Documents without any titled node below the root: doc_id."""
    titled = F.when((F.col("level") >= 1) & (squeezed(F.coalesce("title", F.lit(""))) != ""), 1).otherwise(0)
    return nodes.groupBy("doc_id").agg(F.sum(titled).alias("n")).filter("n = 0").select("doc_id")


def evidence_anchors(evidence: DataFrame, docs_anchors: DataFrame) -> DataFrame:
    """Evidence whose anchor isn't there (H14) or is there more than once (H17): doc_id, anchor, rule."""
    n = docs_anchors.groupBy("doc_id", "anchor").agg(F.count("*").alias("n"))
    e = evidence.select("doc_id", "anchor").distinct().join(n, ["doc_id", "anchor"], "left")
    return e.select("doc_id", "anchor", F.when(F.col("n").isNull(), "H14").when(F.col("n") > 1, "H17").alias("rule")).filter("rule is not null")


def dead_wikilinks(bodies: DataFrame, notes: DataFrame) -> DataFrame:
    """Wiki links (doc_id, anchor, target) that name neither a note (name) nor the last part of one."""
    links = bodies.select("doc_id", "anchor", F.explode(X.wikilinks(F.col("body"))).alias("target")).distinct()
    names = notes.select(F.col("name").alias("target")).distinct()
    last = notes.select(F.substring_index("name", "/", -1).alias("base")).distinct()
    links = links.join(names, "target", "left_anti").withColumn("base", F.substring_index("target", "/", -1))
    return links.join(last, "base", "left_anti").select("doc_id", "anchor", "target")


def tree_violations(nodes: DataFrame) -> DataFrame:
    """Violations of category trees (record_id, node_path, parent_path, slug, layer): record_id,
    node_path, rule: empty slug, slug twice among siblings, unknown layer, not one layer below the
    parent, deeper than the layers go."""
    index = F.array_position(F.array(*map(F.lit, LAYERS)), F.coalesce("layer", F.lit(""))).cast("int")
    n = nodes.select("record_id", "node_path", "parent_path", F.coalesce("slug", F.lit("")).alias("slug"), index.alias("at"), F.size(F.split("node_path", r"\.")).alias("depth"))
    up = n.select("record_id", F.col("node_path").alias("parent_path"), F.col("at").alias("above"))
    twins = n.groupBy("record_id", "parent_path", "slug").agg(F.count("*").alias("n_twins"))
    all_ = n.join(up, ["record_id", "parent_path"], "left")
    all_ = all_.join(twins, all_.record_id.eqNullSafe(twins.record_id) & all_.parent_path.eqNullSafe(twins.parent_path) & all_.slug.eqNullSafe(twins.slug)).select(all_["*"], "n_twins")
    rules = F.array(
        F.when(squeezed(F.col("slug")) == "", "empty slug"),
        F.when(F.col("n_twins") > 1, "duplicate slug"),
        F.when(F.col("at") == 0, "unknown layer").when(F.col("at") != F.coalesce("above", F.lit(0)) + 1, "wrong layer"),
        F.when(F.col("depth") > len(LAYERS), "too deep"),
    )
    return all_.select("record_id", "node_path", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))
