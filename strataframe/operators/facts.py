"""Atoms, modules, edges and entities: coercion of untrusted fields, classification and validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.tables import squeezed

PENDING = "待验证"
TYPES = ("requirement", "behavior", "constraint", "spec")
RELATIONS = ("depends_on", "affects", "constrained_by", "validated_by", "implemented_by")
PENDING_CAP = 0.3

# Modules by the words that a chapter's category holds, in this order.
CATEGORY_TO_MODULE = [
    ("product requirements summary", "Product Definition"), ("product overview", "Product Definition"), ("interface with the host", "Electrical"), ("mechanical", "Mechanical"),
    ("industrial design", "Mechanical"), ("electrical", "Electrical"), ("touchpad", "Subsystems"), ("keyset", "Subsystems"), ("keyboard system operation", "Subsystems"),
    ("backlight", "Subsystems"), ("pen", "Subsystems"), ("repairs", "Manufacturing-DFX"), ("packaging", "Manufacturing-DFX"), ("safety", "Compliance"),
    ("certifications", "Compliance"), ("reliability", "Validation"),
]
# Modules by the words that an entity or parameter holds, in this order.
KEYWORD_TO_MODULE = [
    ("Product Definition", ("overview", "definition", "summary", "scope")),
    ("Mechanical", ("thickness", "dimension", "force", "hinge", "cover", "weight", "torque", "drop")),
    ("Electrical", ("power", "voltage", "current", "battery", "efficiency", "interface", "host", "connector")),
    ("State Machine", ("state", "mode", "transition", "wake", "sleep", "idle")),
    ("Validation", ("test", "verify", "validation", "sample size", "reliability")),
    ("Manufacturing-DFX", ("assembly", "bom", "yield", "repair", "packaging", "logistics", "manufactur")),
    ("Compliance", ("compliance", "safety", "regulation", "certification", "rohs", "fcc", "environmental")),
]
FALLBACK = "Subsystems"


def coerced_atoms(raw: DataFrame) -> DataFrame:
    """Atoms as they may be stored: ids, section and reference are set from the context, a blank
    value becomes null and, like an unknown type, marks the atom as pending. A confidence may be a text;
    it is rounded to two places, half to even, and 0 where it is no number."""
    c = F.col
    text = lambda n: squeezed(F.coalesce(c(n), F.lit("")))
    value = F.nullif(text("value"), F.lit(""))
    kind = F.lower(text("type"))
    known = kind.isin(*TYPES)
    return raw.select(
        "atom_no", "doc_id", X.atom_id(c("entity"), c("parameter"), c("condition"), c("doc_id"), c("section")).alias("id"), text("entity").alias("entity"), text("parameter").alias("parameter"), value.alias("value"), text("unit").alias("unit"),
        F.when(known, kind).otherwise("spec").alias("type"), F.concat(F.lit("kb/"), c("doc_id"), F.lit("/main.md#"), F.coalesce("section", F.lit(""))).alias("evidence_ref"),
        confidence(c("confidence")).alias("confidence"), F.when(value.isNull() | ~known, PENDING).otherwise("").alias("flag"),
    )


def confidence(c: Column) -> Column:
    """A confidence, number or text, as a number of two places."""
    return F.bround(F.coalesce(F.nanvl(c.cast("string").try_cast("double"), F.lit(0.0)), F.lit(0.0)), 2)


def module_of(entity: Column, parameter: Column, category: Column, by_category: list = CATEGORY_TO_MODULE, by_keyword: list = KEYWORD_TO_MODULE, fallback: str = FALLBACK) -> tuple[Column, Column]:
    """Module of an atom and whether it is pending: the first category rule (words, module), else the first
    keyword rule (module, words), else the fallback. The rules are ordered expressions, so there is no join
    at all; they are data, and others may be given."""
    cat = F.lower(squeezed(F.coalesce(category, F.lit(""))))
    hay = F.lower(F.concat_ws(" ", F.coalesce(entity, F.lit("")), F.coalesce(parameter, F.lit(""))))
    rules = [(cat.contains(key), module) for key, module in by_category]
    rules += [(hay.rlike("|".join(words)), module) for module, words in by_keyword]
    found = F.when(*rules[0]) if rules else F.lit(None).cast("string")
    for hit, module in rules[1:]:
        found = found.when(hit, module)
    return F.coalesce(found, F.lit(fallback)), found.isNull()


def classified(atoms: DataFrame, sections: DataFrame, **rules) -> DataFrame:
    """atom_no, module, pending of atoms (atom_no, doc_id, section, entity, parameter) by the category
    of their section (doc_id, anchor, category)."""
    s = sections.select("doc_id", F.col("anchor").alias("section"), "category").groupBy("doc_id", "section").agg(F.min("category").alias("category"))
    module, pending = module_of(F.col("entity"), F.col("parameter"), F.col("category"), **rules)
    return atoms.join(s, ["doc_id", "section"], "left").select("atom_no", "doc_id", "entity", module.alias("module"), pending.alias("pending"))


def valid_edges(edges: DataFrame, atoms: DataFrame) -> DataFrame:
    """Edges with a known relation between two different atoms that exist; without evidence they get
    a reference to their source, are marked as pending and their confidence is capped. The first of
    equal (source, relation, target) stays."""
    c = F.col
    text = lambda n: squeezed(F.coalesce(c(n), F.lit("")))
    ids = atoms.select("id").filter("id is not null").distinct()
    e = edges.select("edge_no", "doc_id", text("source_id").alias("source_id"), text("target_id").alias("target_id"), F.lower(text("relation")).alias("relation"), text("evidence_ref").alias("ref"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    e = e.filter(c("relation").isin(*RELATIONS) & (c("source_id") != c("target_id")))
    e = e.join(ids.withColumnRenamed("id", "source_id"), "source_id", "left_semi").join(ids.withColumnRenamed("id", "target_id"), "target_id", "left_semi")
    bare = c("ref") == ""
    e = e.select("edge_no", "source_id", "target_id", "relation", F.when(bare, F.concat(F.lit("kb/"), "doc_id", F.lit("/graph/atoms.json#"), "source_id")).otherwise(c("ref")).alias("evidence_ref"), F.when(bare, F.least("confidence", F.lit(PENDING_CAP))).otherwise(c("confidence")).alias("confidence"), F.when(bare, PENDING).otherwise("").alias("flag"))
    rest = [x for x in e.columns if x not in ("source_id", "relation", "target_id")]
    best = e.groupBy("source_id", "relation", "target_id").agg(F.min(F.struct(*rest)).alias("r"))
    return best.select("source_id", "relation", "target_id", *(f"r.{x}" for x in rest))


def multi_doc_entities(atoms: DataFrame, least: int = 2) -> DataFrame:
    """Entities that several documents name: entity, n_docs, n_atoms."""
    e = F.lower(squeezed(F.coalesce("entity", F.lit(""))))
    return atoms.select(e.alias("entity"), "doc_id", "atom_no").filter("entity != ''").groupBy("entity").agg(F.count_distinct("doc_id").alias("n_docs"), F.count_distinct("atom_no").alias("n_atoms")).filter(F.col("n_docs") >= least)


def see_also(modules: DataFrame) -> DataFrame:
    """entity, module, others: the other modules in which an entity has atoms. There are few modules,
    so the list is short whatever the number of atoms."""
    m = modules.select(F.lower(squeezed(F.coalesce("entity", F.lit("")))).alias("entity"), "module").filter("entity != ''").distinct()
    other = m.select("entity", F.col("module").alias("other"))
    both = m.join(other, "entity").filter(F.col("module") != F.col("other"))
    return both.groupBy("entity", "module").agg(F.array_join(F.array_sort(F.collect_set("other")), ", ").alias("others"))


def cross_domain(cited: DataFrame, least: int = 2) -> DataFrame:
    """Documents or entities (key) that pages of several domains cite: key, domains, n_links."""
    d = cited.select("key", "domain").distinct().groupBy("key").agg(F.array_join(F.array_sort(F.collect_list("domain")), ",").alias("domains"), F.count("*").alias("n_domains"))
    n = cited.groupBy("key").agg(F.count_distinct("link").alias("n_links"))
    return d.filter(F.col("n_domains") >= least).join(n, "key").select("key", "domains", "n_links")


def quote_found(quote: Column, body: Column) -> Column:
    """Whether a quote stands in a body, runs of white space taken as one space; blank quotes never."""
    fold = lambda c: F.regexp_replace(c, r"(?U)\s+", " ")
    q = squeezed(fold(quote))
    return (q != "") & fold(body).contains(q)
