"""References to records that do not exist.

The anti-join is split by weight. References are first counted per key and period, which is
a partial aggregation with a narrow shuffle. Keys whose counts sum up to ``heavy_rows`` or more
are heavy: there can be at most rows / heavy_rows of them, and the intervals of their targets
are broadcast once their number is checked; beyond ``broadcast_rows`` the heavy references are
salted instead and the targets copied to each salt. All other keys go through one shuffled
anti-join. The orphans of both sides are united.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.tables import is_blank, squeezed

HEAVY_ROWS = 50_000
BROADCAST_ROWS = 100_000
SALTS = 64


def normal_ref(c: Column) -> Column:
    """A reference as it is compared: percent escapes decoded, backslashes as slashes, no white
    space at the ends, lower case. A ``%`` that begins no escape stays as it is."""
    safe = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    c = F.when(c.contains("%"), F.coalesce(F.try_url_decode(safe), c)).otherwise(c)
    return F.lower(squeezed(F.replace(c, F.lit("\\"), F.lit("/"))))


def evidence_key(ref: Column, own_doc: Column) -> Column:
    """``doc#anchor`` named by an evidence reference; without a document it is the record's own."""
    ref = normal_ref(ref)
    at = F.when(ref.contains("#"), F.substring_index(ref, "#", 1)).when(ref.contains("/"), ref).otherwise("")
    anchor = F.when(ref.contains("#"), F.substring_index(ref, "#", -1)).when(ref.contains("/"), "").otherwise(ref)
    doc = F.coalesce(F.nullif(F.regexp_extract(at, r"^(?:\.?/)*kb/(.*)/[^/]*$", 1), F.lit("")), F.when(~at.contains("/"), F.lower(squeezed(own_doc))), at)
    return F.concat(F.coalesce(squeezed(doc), F.lit("")), F.lit("#"), squeezed(anchor))


def visible(targets: DataFrame) -> DataFrame:
    """Intervals [start, end) in which a key names something, at most one that is open.

    Takes kind, key, start, end (null: never taken away). Equal ends are merged by the earliest
    start before the shuffle; intervals inside the open one are dropped.
    """
    merged = targets.groupBy("kind", "key", "end").agg(F.min("start").alias("start"))
    return merged.filter(F.col("end").isNull() | (F.col("end") > F.col("start")))


def orphans(refs: DataFrame, targets: DataFrame, heavy_rows: int = HEAVY_ROWS, broadcast_rows: int = BROADCAST_ROWS, salts: int = SALTS) -> DataFrame:
    """The rows of ``refs`` (ref_field, record_no, kind, key, at) that name no target at ``at``.

    ``refs`` may be counted references as of ``counted``, with a column n and without record_no.
    ``targets`` has kind, key, start, end. A reference is found if start <= at and end is null or
    later. Null keys find nothing and are rows of the result; empty tables on either side are
    fine; repeated references stay repeated. Extra columns of ``targets`` are ignored.
    """
    targets = visible(targets)
    weight = F.sum("n") if "n" in refs.columns else F.count("*")
    per_period = refs.groupBy("kind", "key", F.trunc("at", "month").alias("period")).agg(weight.alias("n"))
    heavy = per_period.filter(F.col("key").isNotNull()).groupBy("kind", "key").agg(F.sum("n").alias("n")).filter(F.col("n") >= heavy_rows).select("kind", "key")
    some = [tuple(r) for r in heavy.limit(broadcast_rows + 1).collect()]

    def anti(left: DataFrame, right: DataFrame, on: list[str], small: bool) -> DataFrame:
        r = (F.broadcast(right) if small else right).alias("r")
        cond = (F.col("r.start") <= F.col("l.at")) & (F.col("r.end").isNull() | (F.col("r.end") > F.col("l.at")))
        for c in on:
            cond = cond & (F.col(f"l.{c}") == F.col(f"r.{c}"))
        return left.alias("l").join(r, cond, "left_anti")

    if not some:
        return anti(refs, targets, ["kind", "key"], False)
    spark = refs.sparkSession
    if len(some) <= broadcast_rows:
        heavy = F.broadcast(spark.createDataFrame(some, heavy.schema))
    light = anti(refs.join(heavy, ["kind", "key"], "left_anti").select(refs.columns), targets, ["kind", "key"], False)
    hot = refs.join(heavy, ["kind", "key"], "left_semi").select(refs.columns)
    wanted = targets.join(heavy, ["kind", "key"], "left_semi").select("kind", "key", "start", "end")
    if len(wanted.limit(broadcast_rows + 1).select(F.lit(1)).collect()) <= broadcast_rows:
        hot = anti(hot, wanted, ["kind", "key"], True)
    else:
        salted = hot.withColumn("salt", F.pmod(F.xxhash64(*refs.columns), F.lit(salts)).cast("int"))
        copies = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        hot = anti(salted, copies, ["kind", "key", "salt"], False).drop("salt")
    return light.unionByName(hot.select(refs.columns))


def edge_references(edges: DataFrame) -> DataFrame:
    """References of edges to atoms, one row per field that isn't blank."""
    once = edges.groupBy("edge_no", "source_id", "target_id").agg(F.min("loaded_at").alias("at"))
    both = once.select(F.col("edge_no").alias("record_no"), "at", F.explode(F.create_map(F.lit("edges.source_id"), F.col("source_id"), F.lit("edges.target_id"), F.col("target_id"))).alias("ref_field", "ref"))
    return both.filter(~is_blank(F.col("ref"))).select("ref_field", "record_no", F.lit("atoms").alias("kind"), normal_ref(F.col("ref")).alias("key"), "at")


def atom_references(atoms: DataFrame) -> DataFrame:
    """References of atoms to sections."""
    once = atoms.filter(~is_blank(F.col("evidence_ref"))).groupBy("atom_no", "doc_id", "evidence_ref").agg(F.min("loaded_at").alias("at"))
    return once.select(F.lit("atoms.evidence_ref").alias("ref_field"), F.col("atom_no").alias("record_no"), F.lit("sections").alias("kind"), evidence_key(F.col("evidence_ref"), F.col("doc_id")).alias("key"), "at")


def atom_targets(atoms: DataFrame) -> DataFrame:
    return atoms.filter(~is_blank(F.col("id"))).select(F.lit("atoms").alias("kind"), F.lower(squeezed(F.col("id"))).alias("key"), F.col("loaded_at").alias("start"), F.col("retired_at").alias("end"))


def section_targets(sections: DataFrame) -> DataFrame:
    named = sections.filter(~is_blank(F.col("anchor")))
    return named.select(F.lit("sections").alias("kind"), F.concat(F.lower(squeezed(F.col("doc_id"))), F.lit("#"), F.lower(squeezed(F.col("anchor")))).alias("key"), F.col("loaded_at").alias("start"), F.col("removed_at").alias("end"))


def all_orphans(edges: DataFrame, atoms: DataFrame, sections: DataFrame, report: bool = False, **kw) -> DataFrame:
    """Every reference of edges and atoms that names nothing at the time it is loaded; for a ``report``
    equal references are counted first, and only their counts go through the anti-join."""
    refs = edge_references(edges).unionByName(atom_references(atoms))
    refs = counted(refs) if report else refs
    targets = atom_targets(atoms).unionByName(section_targets(sections))
    return orphans(refs, targets, **kw)


def counted(refs: DataFrame) -> DataFrame:
    """References of one field to one key at one time as one row with their number n."""
    return refs.groupBy("ref_field", "kind", "key", "at").agg(F.count("*").alias("n"))


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans (rows of ``orphans``, counted or not) by table, field and month of loading."""
    table, field = F.substring_index("ref_field", ".", 1), F.substring_index("ref_field", ".", -1)
    return found.groupBy(table.alias("table_name"), field.alias("field"), F.date_format("at", "yyyy-MM").alias("month")).agg((F.sum("n") if "n" in found.columns else F.count("*")).alias("n_orphans"))


__all__ = ["all_orphans", "atom_references", "atom_targets", "counted", "edge_references", "evidence_key", "normal_ref", "orphan_report", "orphans", "section_targets", "visible"]
