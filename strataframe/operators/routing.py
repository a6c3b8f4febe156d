"""Routing of evidence into categories by ordered rules.

The rule tables are small and checked to be; matching by glob or substring is a broadcast join, and
the first match is the smallest rule number, kept in a partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.tables import squeezed

MAX_RULES = 20_000  # of words, which are joined by equality
MAX_PATTERNS = 1_000  # of globs and headings, each of which is tried on each document or heading
UNCATEGORIZED = "_uncategorized"


def own_document(docs: DataFrame) -> DataFrame:
    """doc_id of the document that a category tree is made from: the first by name that calls itself a
    product requirements document; none if there is none."""
    named = F.lower("doc_id").contains("prd") | F.lower("doc_id").contains("product requirements")
    return docs.filter(named).agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null")


def specifications(docs: DataFrame, glob: str, own: DataFrame) -> DataFrame:
    """doc_id of the documents whose name matches a glob, without the own one (doc_id)."""
    hit = docs.select("doc_id").distinct().filter(F.rlike(F.lower("doc_id"), X.glob_pattern(F.lit(glob))))
    return hit.join(F.broadcast(own.limit(1)), "doc_id", "left_anti")


def rule_table(rules: DataFrame, most: int = MAX_RULES) -> DataFrame:
    """Rules ready to be broadcast; raises beyond ``most`` rows."""
    if rules.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rules")
    return F.broadcast(rules)


def by_spec(docs: DataFrame, specs: DataFrame) -> DataFrame:
    """doc_id, slug: the first category whose glob matches the document (specs: ord, slug, glob).
    Documents are matched once each, not once per section."""
    rules = rule_table(specs.select("ord", "slug", X.glob_pattern(F.col("glob")).alias("pattern")), MAX_PATTERNS)
    hit = docs.select("doc_id").distinct().join(rules, F.expr("lower(doc_id) rlike pattern"))
    return hit.groupBy("doc_id").agg(F.min(F.struct("ord", "slug")).alias("x")).select("doc_id", F.col("x.slug").alias("slug"))


def by_keywords(titles: DataFrame, keywords: DataFrame) -> DataFrame:
    """title, slug, overlap: the category that shares most words with a title, the first of equals
    (keywords: ord, slug, keyword). Different titles are matched once each by an equi-join on words."""
    words = rule_table(keywords.select("ord", "slug", F.explode(X.tokens(F.col("keyword"))).alias("word")).distinct())
    asked = titles.select("title").distinct().select("title", F.explode(X.tokens(F.col("title"))).alias("word"))
    counts = asked.join(words, "word").groupBy("title", "ord", "slug").agg(F.count("*").alias("n"))
    best = counts.groupBy("title").agg(F.min(F.struct((-F.col("n")).alias("m"), "ord", "slug")).alias("x"))
    return best.select("title", F.col("x.slug").alias("slug"), (-F.col("x.m")).alias("overlap"))


def by_heading(sections: DataFrame, headings: DataFrame, levels: int = 1) -> DataFrame:
    """doc_id, node_id, slug: sections whose heading holds a category's heading (headings: ord, slug,
    heading); nodes below a matched node of depth ``levels`` inherit it.

    Inheritance is a join on the ancestor at that depth, which ``ancestors`` gives."""
    rules = rule_table(headings.select("ord", "slug", F.lower("heading").alias("heading")).filter("heading != ''"), MAX_PATTERNS)
    top = sections.filter(F.col("depth") == levels).select("doc_id", F.col("node_id").alias("top"), F.lower(F.coalesce("title", F.lit(""))).alias("t"))
    hit = top.join(rules, F.expr("contains(t, heading)")).groupBy("doc_id", "top").agg(F.min(F.struct("ord", "slug")).alias("x"))
    hit = hit.select("doc_id", "top", F.col("x.slug").alias("slug"))
    return ancestors(sections, levels).join(hit, ["doc_id", "top"]).select("doc_id", "node_id", "slug")


def ancestors(sections: DataFrame, depth: int, most: int = 24) -> DataFrame:
    """doc_id, node_id, top: the ancestor at a depth of each node at or below it, the node itself there.

    In document order (ord) it is the last node of that depth at or before the node, as trees are
    written depth first; one window does for any depth of the tree."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    top = F.last(F.when(F.col("depth") == depth, F.col("node_id")), ignorenulls=True).over(w)
    return sections.withColumn("top", top).filter((F.col("depth") >= depth) & F.col("top").isNotNull()).select("doc_id", "node_id", "top")


def spec_owners(docs: DataFrame, subsystems: DataFrame, systems: DataFrame) -> DataFrame:
    """doc_id, system, subsystem: all subsystems that own a document. Directly by a spec of their own
    (subsystems: system, subsystem, title, glob); where there is none, by a spec of their system
    (systems: system, glob) and a word that the document's name and the subsystem's title share."""
    d = docs.select("doc_id").distinct()
    own = rule_table(subsystems.filter("glob is not null").select("system", "subsystem", X.glob_pattern(F.col("glob")).alias("pattern")), MAX_PATTERNS)
    direct = d.join(own, F.expr("lower(doc_id) rlike pattern")).select("doc_id", "system", "subsystem").distinct()
    rest = d.join(direct.select("doc_id").distinct(), "doc_id", "left_anti")
    above = rule_table(systems.select("system", X.glob_pattern(F.col("glob")).alias("pattern")), MAX_PATTERNS)
    under = rest.join(above, F.expr("lower(doc_id) rlike pattern")).select("doc_id", "system").distinct().withColumn("word", F.explode(X.tokens(F.col("doc_id"))))
    titles = rule_table(subsystems.select("system", "subsystem", F.explode(X.tokens(F.col("title"))).alias("word")).distinct())
    return direct.unionByName(under.join(titles, ["system", "word"]).select("doc_id", "system", "subsystem").distinct())


def spec_sections(sections: DataFrame, owners: DataFrame, parts: DataFrame) -> DataFrame:
    """doc_id, node_id, path of the sections of owned documents that are parts or functions.

    A heading of depth 1 whose slug is a part of the owner (parts: system, subsystem, part, function or
    null) has the part's path; one of depth 2 below it the function's if it is one, else the part's.
    Where a document has several owners, the last in order gives the path.
    """
    one = sections.filter("depth = 1").select("doc_id", F.col("node_id").alias("top"), X.slug(F.col("title"), "unknown", False).alias("part"))
    known = parts.select("system", "subsystem", "part").distinct()
    tops = one.join(owners, "doc_id").join(known, ["system", "subsystem", "part"]).withColumn("base", F.concat_ws("/", "system", "subsystem", "part"))
    two = sections.filter("depth = 2").select("doc_id", "node_id", F.col("parent_node_id").alias("top"), X.slug(F.col("title"), "unknown", False).alias("function"))
    functions = parts.filter("function is not null").select("system", "subsystem", "part", "function", F.lit(True).alias("known")).distinct()
    deep = two.join(tops, ["doc_id", "top"]).join(functions, ["system", "subsystem", "part", "function"], "left")
    deep = deep.select("doc_id", "node_id", F.when(F.col("known"), F.concat_ws("/", "base", "function")).otherwise(F.col("base")).alias("path"), "base")
    rows = tops.select("doc_id", F.col("top").alias("node_id"), F.col("base").alias("path"), "base").unionByName(deep)
    return rows.groupBy("doc_id", "node_id").agg(F.max_by("path", F.struct("base", "path")).alias("path"))


def taxonomy_nodes(sections: DataFrame, owners: DataFrame, subsystems: DataFrame, own_doc: str) -> DataFrame:
    """tree, layer, path, slug, title: the nodes of all four layers of category trees.

    Headings of the first two depths are the systems and subsystems of their document's tree. The own
    document's tree also has the subsystems (system, subsystem, title) that specs are linked to; below
    them, the first two depths of the other documents that they own (owners: doc_id, system, subsystem)
    are parts and functions. Headings without a title are none. Nodes of one path are one node, with
    the children of all; the title is the last heading's, of headings under one parent the first's, and
    a part's the first of all.
    """
    n = sections.withColumn("title", squeezed(F.col("title"))).filter("title != ''").withColumn("slug", X.slug(F.col("title"), "unknown", False))
    one = n.filter("depth = 1").select("doc_id", F.col("node_id").alias("top"), F.col("ord").alias("top_ord"), F.col("slug").alias("s1"), F.col("title").alias("t1"))
    two = n.filter("depth = 2").select("doc_id", F.col("parent_node_id").alias("top"), "ord", "node_id", F.col("slug").alias("s2"), F.col("title").alias("t2"))
    both = one.join(two, ["doc_id", "top"])

    def rows(df: DataFrame, tree: Column, layer: str, path: list[str], title: str, ruled: bool = False) -> DataFrame:
        by = [F.lit(0)] if ruled else [F.lit(1), "doc_id", "top_ord", *(["top"] if title == "t1" else [-F.col("ord"), "node_id"])]
        named = df.select(tree.alias("tree"), F.lit(layer).alias("layer"), F.concat_ws("/", *path).alias("path"), F.col(path[-1]).alias("slug"), F.col(title).alias("title"), F.struct(*by).alias("by"))
        best = F.min_by("title", "by") if layer == "part" else F.max_by("title", "by")
        return named.groupBy("tree", "layer", "path", "slug").agg(best.alias("title"), F.lit(not ruled).alias("heading"))

    own, of = F.lit(own_doc), F.col("doc_id")
    linked = owners.filter(of != own_doc)
    above = rows(one, of, "system", ["s1"], "t1").unionByName(rows(both, of, "subsystem", ["s1", "s2"], "t2"))
    above = above.unionByName(rows(subsystems, own, "system", ["system"], "system", True)).unionByName(rows(subsystems, own, "subsystem", ["system", "subsystem"], "title", True))
    above = above.groupBy("tree", "layer", "path", "slug").agg(F.max_by("title", "heading").alias("title"))
    below = rows(one.join(linked, "doc_id"), own, "part", ["system", "subsystem", "s1"], "t1").unionByName(rows(both.join(linked, "doc_id"), own, "function", ["system", "subsystem", "s1", "s2"], "t2"))
    return above.unionByName(below.drop("heading"))


def route(evidence: DataFrame, specs: DataFrame, keywords: DataFrame, headings: DataFrame, sections: DataFrame, own_doc: str, doc_words: bool = False, paths: DataFrame | None = None) -> DataFrame:
    """doc_id, anchor, title, slug of evidence (doc_id, node_id, anchor, title). With paths in place of slugs
    in all rule tables, and rules of equal overlap ordered from the top of the tree down, it gives the path.
    ``paths`` (doc_id, node_id, path): of sections of other documents, before their specs.

    The own document's sections go by their headings, other documents by their specs; what is left by
    the words of the title (and then of the document, if ``doc_words``), else it stays uncategorised.
    """
    own = F.lower(F.trim("doc_id")) == own_doc.strip().lower()
    head = by_heading(sections.filter(own), headings).withColumnRenamed("slug", "by_heading")
    spec = by_spec(evidence.filter(~own), specs).withColumnRenamed("slug", "by_spec")
    words = by_keywords(evidence, keywords).select("title", F.col("slug").alias("by_words"))
    out = evidence.join(head, ["doc_id", "node_id"], "left").join(spec, "doc_id", "left").join(words, "title", "left")
    ways = ["by_heading", "by_spec", "by_words"]
    if doc_words:
        named = by_keywords(evidence.select(F.col("doc_id").alias("title")), keywords).select(F.col("title").alias("doc_id"), F.col("slug").alias("by_doc"))
        out, ways = out.join(named, "doc_id", "left"), [*ways, "by_doc"]
    if paths is not None:
        placed = paths.select("doc_id", "node_id", F.col("path").alias("by_section")).filter(~own)
        out, ways = out.join(placed, ["doc_id", "node_id"], "left"), [ways[0], "by_section", *ways[1:]]
    return out.select("doc_id", "anchor", "title", F.coalesce(*ways, F.lit(UNCATEGORIZED)).alias("slug"))
