"""Topics: section titles linked by shared words, exactly, and their connected components.

Titles are reduced to their sets of words first. Only different sets are linked, through an
inverted index on words: with a distance below 1 two sets share a word, so no pair is missed and
pairs without a shared word are never made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.tables import checkpointed

DISTANCE = 0.85


def token_sets(titles: DataFrame) -> DataFrame:
    """tokens (their words, sorted, as one text) and set_id of all different sets of words; ids are
    hashes of the set, so they don't depend on the partitioning."""
    sets = titles.select(F.array_join(X.tokens(F.col("title")), " ").alias("tokens")).filter("tokens != ''").distinct()
    return sets.select("tokens", X.sha(F.col("tokens")).alias("set_id"))


def jaccard_pairs(sets: DataFrame, most: float = DISTANCE) -> DataFrame:
    """Pairs of sets (a < b) with 1 - shared / all <= ``most``: a, b, distance.

    Sets that are that near share one of their rarest words: of n words all but ceil(n * (1 - most)) - 1,
    the most frequent of which are left out of the index. So no pair is missed, and frequent words, on which most
    pairs would meet in vain, count only in the sets that have few others. The sizes of a pair bound each other, too.
    """
    least = 1.0 - most
    words = sets.select("tokens", F.explode(F.split("tokens", " ")).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("f"))
    ranked = words.join(counts, "word").groupBy("tokens").agg(F.array_sort(F.collect_list(F.struct("f", "word"))).alias("w"))  # the words of one title
    n = F.size("w")
    kept = F.greatest(F.lit(1), F.least(n, n - F.ceil(n * least - 1e-9).cast("int") + 1))
    rare = ranked.select("tokens", n.alias("n"), F.explode(F.slice("w", 1, kept)).alias("x")).select("tokens", "n", "x.word")
    a = rare.select(F.col("tokens").alias("a"), F.col("n").alias("n_a"), "word")
    b = rare.select(F.col("tokens").alias("b"), F.col("n").alias("n_b"), "word")
    sized = (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least - 1e-9) & (F.col("a") < F.col("b"))
    near = a.join(b, "word").filter(sized).select("a", "b", "n_a", "n_b").distinct()
    k = F.size(F.array_intersect(F.split("a", " "), F.split("b", " ")))
    distance = 1.0 - k / (F.col("n_a") + F.col("n_b") - k)
    return near.select("a", "b", distance.alias("distance")).filter((F.col("distance") <= most) & (k > 0))


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component: the smallest node of each connected component.

    Every round sends the smallest label over the edges and then jumps to the label's own label,
    so long chains take logarithmically many rounds. Labels are written to the shared checkpoint
    folder each round, which cuts the lineage and survives lost executors.
    """
    both = checkpointed(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = checkpointed(nodes.select("node", F.col("node").alias("component")).distinct())
    for _ in range(most_rounds):
        near = both.join(labels, both.a == labels.node).groupBy("b").agg(F.min("component").alias("m"))
        new = labels.join(near, labels.node == near.b, "left").select("node", F.least("component", F.coalesce("m", "component")).alias("component"), F.col("component").alias("before"))
        up = new.select(F.col("node").alias("up"), F.col("component").alias("top"))
        new = checkpointed(new.join(up, new.component == up.up, "left").select("node", F.least("component", F.coalesce("top", "component")).alias("component"), "before"))
        moved = new.filter("component != before").limit(1).count()
        labels = new.select("node", "component")
        if not moved:
            return labels
    raise RuntimeError("components did not settle")


def discover_topics(evidence: DataFrame, most: float = DISTANCE, min_evidence: int = 1, skip_numeric: bool = False) -> DataFrame:
    """slug, title, n_evidence, n_docs of the topics of evidence (doc_id, anchor, title).

    The title is the most frequent word over the members of a component, the smallest of equals;
    slugs that come again get -2, -3, ... in the order of components, before small topics are left
    out. Titles without words are topics of their own text.
    """
    rows = evidence.select("doc_id", "anchor", "title", F.array_join(X.tokens(F.col("title")), " ").alias("tokens"))
    sets = token_sets(evidence)
    labels = components(sets.select(F.col("tokens").alias("node")), jaccard_pairs(sets, most))
    named = rows.filter("tokens != ''").join(labels, F.col("tokens") == F.col("node")).select("doc_id", "anchor", "tokens", "component")
    words = named.select("component", F.explode(F.split("tokens", " ")).alias("word")).groupBy("component", "word").agg(F.count("*").alias("n"))
    best = words.groupBy("component").agg(F.min(F.struct((-F.col("n")).alias("n"), "word")).alias("x")).select("component", F.col("x.word").alias("title"))
    size = named.groupBy("component").agg(F.count("*").alias("n_evidence"), F.count_distinct("doc_id").alias("n_docs"))
    bare = rows.filter("tokens = ''").groupBy(F.concat(F.lit("￿"), "title").alias("component"), "title").agg(F.count("*").alias("n_evidence"), F.count_distinct("doc_id").alias("n_docs"))
    topics = best.join(size, "component").select("component", "title", "n_evidence", "n_docs").unionByName(bare.select("component", "title", "n_evidence", "n_docs"))
    topics = topics.withColumn("base", X.slug(F.col("title"), "topic"))
    k = F.row_number().over(Window.partitionBy("base").orderBy("component"))
    topics = topics.withColumn("k", k).select(F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat("base", F.lit("-"), "k")).alias("slug"), "title", "n_evidence", "n_docs")
    topics = topics.filter(F.col("n_evidence") >= min_evidence)
    return topics.filter(~X.is_numeric_title(F.col("title"))) if skip_numeric else topics


def topics_by_path(evidence: DataFrame, most: float = DISTANCE, min_evidence: int = 1) -> DataFrame:
    """path, title, n_evidence, n_docs of the topics inside each path of evidence (doc_id, anchor, title,
    path). Words count for their path only, so titles are linked within it and all paths are done at once.
    Titles without words belong to no topic."""
    words = F.transform(X.tokens(F.col("title")), lambda w: F.concat("path", F.lit("\x01"), F.replace(w, F.lit(" "), F.lit(""))))
    joined = F.array_join(F.transform(words, lambda w: F.replace(w, F.lit(" "), F.lit("\x02"))), " ")
    rows = evidence.filter("path is not null").select("doc_id", "anchor", "path", joined.alias("tokens")).filter("tokens != ''")
    sets = rows.select("tokens").distinct()
    named = rows.join(components(sets.select(F.col("tokens").alias("node")), jaccard_pairs(sets, most)), F.col("tokens") == F.col("node"))
    counts = named.select("path", "component", F.explode(F.split("tokens", " ")).alias("word")).groupBy("path", "component", "word").agg(F.count("*").alias("n"))
    best = counts.groupBy("path", "component").agg(F.min(F.struct((-F.col("n")).alias("n"), "word")).alias("x"))
    size = named.groupBy("path", "component").agg(F.count("*").alias("n_evidence"), F.count_distinct("doc_id").alias("n_docs")).filter(F.col("n_evidence") >= min_evidence)
    return best.join(size, ["path", "component"]).select("path", F.substring_index("x.word", "\x01", -1).alias("title"), "n_evidence", "n_docs")
