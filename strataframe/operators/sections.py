"""Section trees and section texts: segmentation, nesting, page ranges and invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.tables import squeezed

MAX_LEVEL = 24


def evidence_leaves(sections: DataFrame) -> DataFrame:
    """Leaves with an anchor: what topics and pages may cite."""
    return sections.filter(F.col("is_leaf") & (squeezed(F.col("anchor")) != ""))


def segments(docs: DataFrame) -> DataFrame:
    """doc_id, pos, anchor and text between consecutive section anchors of each text (doc_id, text).

    Anchors of tables don't end a section; text before the first anchor belongs to none. Null texts
    and texts without anchors give no rows. The cut is a split and an explode, so a long document is
    never gathered, and its sections keep their position.
    """
    anchors = F.regexp_extract_all("text", F.lit(X.SECTION_ANCHOR), F.lit(1))
    parts = F.split("text", X.SECTION_ANCHOR)
    both = F.arrays_zip(anchors.alias("anchor"), F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))).alias("segment"))
    rows = docs.filter(F.col("text").contains('<a id="sec-')).select("doc_id", F.posexplode(both).alias("pos", "x"))
    return rows.select("doc_id", "pos", F.col("x.anchor"), F.col("x.segment"))


def content_sections(docs: DataFrame) -> DataFrame:
    """Sections with a heading and a body: doc_id, anchor, title, level, category, body.

    ``category`` is the last level-1 title at or before the section in its document, else its own
    title; level-1 sections count for it even without a body.
    """
    heading = r"(?m)^(#{1,6})[ \t]+(.*?)[ \t]*$"
    s = segments(docs)
    mark, title = F.regexp_extract("segment", heading, 1), squeezed(F.regexp_extract("segment", heading, 2))
    body = squeezed(F.element_at(F.split("segment", r"(?m)^#{1,6}[ \t]+.*?[ \t]*$", 2), 2))
    s = s.filter(F.col("segment").rlike(heading)).select("doc_id", "pos", "anchor", title.alias("title"), F.length(mark).alias("level"), body.alias("body"))
    last = F.last(F.when(F.col("level") == 1, F.col("title")), ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("pos"))
    return s.withColumn("category", F.coalesce(F.nullif(last, F.lit("")), "title")).filter("body != ''").drop("pos")


def chunks(body: Column, most: int) -> Column:
    """Chunks of at most ``most`` characters: paragraphs, else lines, else cuts, packed greedily and
    joined by an empty line. A text that fits is one chunk."""
    def hard(t: Column) -> Column:
        n = F.ceil(F.length(t) / most).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(t, i * most + 1, F.lit(most)))

    def unit(t: Column) -> Column:
        return F.when(F.length(t) <= most, F.array(t)).otherwise(hard(t))

    paragraphs = F.split(body, "\n\n", -1)
    units = F.flatten(F.transform(paragraphs, lambda p: F.when(F.length(p) <= most, F.array(p)).otherwise(F.flatten(F.transform(F.split(p, "\n", -1), unit)))))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def add(acc: Column, u: Column) -> Column:
        joined = F.when(acc["now"] == "", u).otherwise(F.concat(acc["now"], F.lit("\n\n"), u))
        fits = F.length(joined) <= most
        done = F.when(fits | (acc["now"] == ""), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["now"])))
        return F.struct(done.alias("done"), F.when(fits, joined).otherwise(u).alias("now"))

    packed = F.aggregate(units, start, add, lambda a: F.when(a["now"] == "", a["done"]).otherwise(F.concat(a["done"], F.array(a["now"]))))
    return F.when(F.length(body) <= most, F.array(body)).otherwise(packed)


def _bounded(level: Column, most: int) -> Column:
    """The level itself; one that the windows don't hold is an error, never a lost parent."""
    return F.when(level >= most, F.raise_error(F.concat(F.lit(f"level of {most} or more: "), level.cast("string"))).cast("int")).otherwise(level)


def nest_by_level(rows: DataFrame, doc: str = "doc_id", order: str = "ord", level: str = "level", most: int = MAX_LEVEL) -> DataFrame:
    """Adds parent_ord: the nearest earlier row of the document with a smaller level, null for none.
    Levels run from 0 to ``most`` - 1; a larger one raises."""
    rows = rows.withColumn(level, _bounded(F.col(level), most))
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # for each level the last row that has it; the parent is the latest among the smaller levels
    last = [F.last(F.when(F.col(level) == k, F.col(order)), ignorenulls=True).over(w) for k in range(most)]
    above = F.array_max(F.filter(F.slice(F.array(*last), F.lit(1), F.greatest(F.least(F.col(level), F.lit(most)), F.lit(0))), lambda x: x.isNotNull()))
    return rows.withColumn("parent_ord", above)


def section_end_pages(rows: DataFrame, most: int = MAX_LEVEL) -> DataFrame:
    """Adds end_page to outline entries (doc_id, ord, level, page_start, n_pages): the page before the
    next entry of the same or a smaller level, at least the own page; the last runs to the end. Levels run
    from 0 to ``most`` - 1; a larger one raises.

    The windows run from the last entry to the first, so each keeps a running value and reads a row once.
    """
    rows = rows.withColumn("level", _bounded(F.col("level"), most))
    w = Window.partitionBy("doc_id").orderBy(F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1)
    next_ = [F.last(F.when(F.col("level") <= k, F.col("page_start")), ignorenulls=True).over(w) for k in range(most)]
    after = F.element_at(F.array(*next_), (F.col("level") + 1).cast("int"))
    return rows.withColumn("end_page", F.greatest(F.coalesce(after - 1, F.col("n_pages")), F.col("page_start")))


def running_lines(pages: DataFrame, threshold: float = 0.5) -> DataFrame:
    """source, line, n: lines that stand on at least ``threshold`` of a document's pages (source, page,
    text), and on two. A line counts once a page; a document of one page has none.

    Lines are counted by partial sums, so a document with most of the pages doesn't gather.
    """
    lines = pages.select("source", "page", F.explode(F.split("text", "\r\n|\r|\n")).alias("line")).select("source", "page", squeezed(F.col("line")).alias("line"))
    per = lines.filter("line != ''").distinct().groupBy("source", "line").agg(F.count("*").alias("n"))
    total = pages.groupBy("source").agg(F.count("*").alias("pages"))
    least = F.greatest(F.lit(2), F.floor(F.col("pages") * threshold + 0.999))
    return per.join(total, "source").filter((F.col("pages") >= 2) & (F.col("n") >= least)).select("source", "line", "n")


def inferred_headings(spans: DataFrame, levels: int = 4) -> DataFrame:
    """Headings by font size: doc_id, page, level, title from spans (doc_id, page, pos, size, bold, text).

    Sizes are rounded to half points, half to even. The body's size is that of most characters (the
    first seen wins ties). Larger by a tenth, or bold and larger by a point, is a heading; the four
    largest sizes are the levels.
    """
    s = spans.filter(squeezed(F.col("text")) != "").select("doc_id", "page", "pos", (F.bround(F.col("size") * 2) / 2).alias("size"), "bold", squeezed(F.col("text")).alias("title"))
    weight = s.groupBy("doc_id", "size").agg(F.sum(F.length("title")).alias("w"), F.min(F.struct("page", "pos")).alias("first"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("w"), "first")
    body = weight.withColumn("k", F.row_number().over(order)).filter("k = 1").select("doc_id", F.col("size").alias("body"))
    found = s.join(body, "doc_id").filter((F.col("size") > F.col("body") * 1.10) | (F.col("bold") & (F.col("size") >= F.col("body") + 1))).select("doc_id", "page", "size", "title").distinct()
    sizes = found.select("doc_id", "size").distinct().withColumn("level", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("size")))).filter(F.col("level") <= levels)
    return found.join(sizes, ["doc_id", "size"]).select("doc_id", "page", "level", "title", "size")


def toc_lines(texts: DataFrame) -> DataFrame:
    """Numbered entries of contents pages: doc_id, pos, number, title, depth, page from (doc_id, text)."""
    lines = texts.select("doc_id", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("pos", "line"))
    pattern = r"^\s*(\d+(?:\.\d+)*)\s+(\S.*?)\s*\.{2,}\s*(\d+)\s*$"
    hit = lines.filter(F.col("line").rlike(pattern))
    number = F.regexp_extract("line", pattern, 1)
    return hit.select("doc_id", "pos", number.alias("number"), F.regexp_extract("line", pattern, 2).alias("title"), (F.regexp_count(number, F.lit(r"\.")) + 1).alias("depth"), F.regexp_extract("line", pattern, 3).cast("int").alias("page"))


def prefixes(number: Column) -> Column:
    """All prefixes of a dotted number, the number itself first."""
    parts = F.split(number, r"\.")
    return F.transform(F.reverse(F.sequence(F.lit(1), F.size(parts))), lambda k: F.array_join(F.slice(parts, 1, k), "."))


def toc_rollup(numbers: DataFrame, toc: DataFrame, root: str = "root") -> DataFrame:
    """Each number (doc_id, number) with the entry of its longest prefix in the contents (doc_id,
    number), or ``root``. An equi-join on all prefixes, so no pair that doesn't match is made."""
    known = toc.select("doc_id", F.col("number").alias("entry")).distinct()
    asked = numbers.select("doc_id", "number").distinct()
    wide = asked.select("doc_id", "number", F.explode(prefixes(F.col("number"))).alias("entry")).join(known, ["doc_id", "entry"])
    best = wide.groupBy("doc_id", "number").agg(F.max_by("entry", F.length("entry")).alias("entry"))
    return asked.join(best, ["doc_id", "number"], "left").select("doc_id", "number", F.coalesce("entry", F.lit(root)).alias("entry"))


def without_running_lines(pages: DataFrame, running: DataFrame) -> DataFrame:
    """source, page, text of pages (source, page, text) without their document's running lines (source,
    line). Lines are compared without white space at their ends; pages of documents without running lines stay as
    they are. What is gathered is the running lines of one document, each of which stands on many pages."""
    drop = running.groupBy("source").agg(F.collect_set("line").alias("drop"))
    kept = F.filter(F.split("text", "\r\n|\r|\n"), lambda x: ~F.array_contains("drop", squeezed(x)))
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.regexp_replace(F.array_join(kept, "\n"), r"^\n+|\n+$", ""))
    return pages.join(drop, "source", "left").select("source", "page", text.alias("text"))


def with_front_matter(entries: DataFrame, title: str = "Front matter") -> DataFrame:
    """Outline entries (doc_id, ord, level, title, page_start), and one of level 1 for the pages before the first
    where that begins later than page 1. Entries without a page or before page 1 are left out."""
    e = entries.filter("page_start >= 1").select("doc_id", "ord", "level", "title", "page_start")
    first = e.groupBy("doc_id").agg(F.min(F.struct("ord", "page_start")).alias("x")).filter("x.page_start > 1")
    return e.unionByName(first.select("doc_id", (F.col("x.ord") - 1).alias("ord"), F.lit(1).alias("level"), F.lit(title).alias("title"), F.lit(1).alias("page_start")))


def one_heading_per_page(headings: DataFrame) -> DataFrame:
    """The first heading of each page (doc_id, page, level, title) by level and title, so that ranges of pages
    don't overlap."""
    best = headings.groupBy("doc_id", "page").agg(F.min(F.struct("level", "title")).alias("x"))
    return best.select("doc_id", "page", F.col("x.level").alias("level"), F.col("x.title").alias("title"))


def next_anchors(segments: DataFrame) -> DataFrame:
    """doc_id, pos, anchor, next_anchor of sections (doc_id, pos, anchor): where a section's text ends; null for
    the last."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    return segments.select("doc_id", "pos", "anchor", F.lead("anchor").over(w).alias("next_anchor"))
