"""Contents pages whose entries are a line with a number and a line with a title, and the tree of their numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.tables import squeezed

NUMBER = r"^\d+(\.\d+)*$"
# Lines of page heads and foots between the entries.
NOISE = r"(?i)^(!\[|page\s+\d+\s+of\b|\w+\s+confidential\b|\d+/\d+/\d+$|m\d+\s+rev\b|product\s+requirement\s+document$|contents$)"
# Layers of the tree, by the number of parts of an entry's number.
LAYERS = ("subsystem", "part", "function")


def _title(line: Column) -> Column:
    """A title without its leader and page."""
    return squeezed(F.regexp_replace(squeezed(F.regexp_replace(line, r"\s*\.{2,}.*$", "")), r"\s+\d+$", ""))


def number_title_pairs(texts: DataFrame) -> DataFrame:
    """doc_id, pos, number, title, depth of the entries of contents pages (doc_id, text).

    Entries stand between the first heading ``Contents`` of a text and its next heading. An
    entry is a title line with the first bare number since the title line before it; lines of page heads
    and foots are passed over, and a title line of a leader alone ends what came before it without an entry.
    Null texts and texts without such a heading give no rows.
    """
    lines = texts.select("doc_id", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("pos", "line")).withColumn("line", squeezed(F.col("line")))
    line, heading = F.col("line"), F.col("line").startswith("#")
    opening = heading & (F.lower(squeezed(F.regexp_replace(line, "^#+", ""))) == "contents")
    above = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    opened = lines.withColumn("open", F.coalesce(F.max(opening).over(above), F.lit(False)))
    inside = opened.withColumn("closed", F.max(F.col("open") & heading).over(upto)).filter("open and not closed")
    number = line.rlike(NUMBER)
    titled = (line != "") & ~number & ~line.rlike(NOISE)
    part = F.sum(titled.cast("int")).over(above)
    parts = inside.select("doc_id", "pos", "line", number.alias("is_number"), titled.alias("is_title"), F.coalesce(part, F.lit(0)).alias("part"))
    first = F.min(F.when(F.col("is_number"), F.struct("pos", "line"))).alias("n")
    pairs = parts.groupBy("doc_id", "part").agg(first, F.max(F.when(F.col("is_title"), F.col("line"))).alias("t"))
    out = pairs.select("doc_id", F.col("n.pos").alias("pos"), F.col("n.line").alias("number"), _title(F.col("t")).alias("title"))
    return out.filter("number is not null and title != ''").withColumn("depth", F.regexp_count("number", F.lit(r"\.")) + 1)


def contents_tree(entries: DataFrame) -> DataFrame:
    """doc_id, pos, number, layer, title, slug, path of the entries (doc_id, pos, number, title, depth) of
    one to three parts.

    The parent is the last entry before with the number less its last part or, where a function has
    none, less its last two; entries below nothing are left out. Slugs that come again under one parent get -2, -3, ...
    in the order of the entries; the path is that of the slugs.
    """
    e = entries.filter(F.col("depth").between(1, 3)).withColumn("base", X.slug(F.col("title"), "unknown", False))

    def last_above(rows: DataFrame, nodes: DataFrame, parts: int, name: str) -> DataFrame:
        """The last of ``nodes`` before each row whose number is the first ``parts`` of the row's."""
        up = nodes.select("doc_id", F.col("number").alias("up"), F.col("pos").alias("up_pos"))
        asked = rows.select("doc_id", "pos", F.substring_index("number", ".", parts).alias("up"))
        hit = asked.join(up, ["doc_id", "up"]).filter("up_pos < pos").groupBy("doc_id", "pos").agg(F.max("up_pos").alias(name))
        return rows.join(hit, ["doc_id", "pos"], "left")

    def numbered(rows: DataFrame, *under: str) -> DataFrame:
        k = F.row_number().over(Window.partitionBy("doc_id", *under, "base").orderBy("pos"))
        return rows.withColumn("k", k).withColumn("slug", F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat("base", F.lit("-"), "k"))).drop("k")

    one = numbered(e.filter("depth = 1")).withColumn("path", F.col("slug"))
    top = one.select("doc_id", F.col("pos").alias("top"), F.col("path").alias("top_path"))
    two = last_above(e.filter("depth = 2"), one, 1, "top").filter("top is not null")
    three = last_above(last_above(e.filter("depth = 3"), two, 2, "mid"), one, 1, "top").filter("top is not null")
    # children of a subsystem share its slugs, whether they have two parts or three
    low = numbered(two.withColumn("mid", F.lit(None).cast("int")).unionByName(three), "top", "mid").join(top, ["doc_id", "top"])
    mid = low.filter("depth = 2").select("doc_id", F.col("pos").alias("mid"), F.concat_ws("/", "top_path", "slug").alias("mid_path"))
    low = low.join(mid, ["doc_id", "mid"], "left").withColumn("path", F.concat_ws("/", F.coalesce("mid_path", "top_path"), "slug"))
    layer = F.element_at(F.array(*map(F.lit, LAYERS)), F.col("depth").cast("int"))
    out = ["doc_id", "pos", "number", layer.alias("layer"), "title", "slug", "path"]
    return one.select(*out).unionByName(low.select(*out))


def contents_paths(tree: DataFrame) -> DataFrame:
    """doc_id, number, path: each number's last path."""
    return tree.groupBy("doc_id", "number").agg(F.max_by("path", "pos").alias("path"))
