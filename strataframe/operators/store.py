"""Keyed tables and logs: upserts as the latest row per key, plans of what has to be done again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions import text as X


MAX_ADAPTERS = 10_000  # suffixes that are broadcast; more are an error


def upserted(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The latest row of each key; ties are settled by all columns, so any order gives the same."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max(F.struct(*order, *(c for c in rest if c not in order))).alias("_r"))
    return best.select(key, *(F.col(f"_r.{c}") for c in rest))


def status_merged(rows: DataFrame, key: str, order: str, status: str, kept: Sequence[str]) -> DataFrame:
    """The latest status of each key, with the last value that isn't null of every other column:
    marking a row as skipped or failed leaves what was known of it."""
    w = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in kept]
    return rows.groupBy(key).agg(F.max_by(status, F.struct(order, status)).alias(status), *w)


def deleted(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows without those of the given keys (tombstones)."""
    return rows.join(keys.select(key).distinct(), key, "left_anti")


def incremental_plan(files: DataFrame, manifest: DataFrame, adapters: DataFrame, force: bool = False, dry_run: bool = False) -> DataFrame:
    """key, action of each file (key, source_path, source_sha256) against the manifest (key,
    source_sha256, status): ``skipped`` without an adapter (suffix) for its kind, ``unchanged`` where
    the hash is the same and the last run ended well, else ``extract`` (``dry_run`` if only asked)."""
    m = manifest.select("key", F.col("source_sha256").alias("old_sha"), F.col("status").alias("old_status"))
    a = adapters.select("suffix").distinct().withColumn("known", F.lit(True))
    if a.limit(MAX_ADAPTERS + 1).count() > MAX_ADAPTERS:
        raise ValueError(f"more than {MAX_ADAPTERS} adapters")
    f = files.withColumn("suffix", X.suffix(F.col("source_path"))).join(F.broadcast(a), "suffix", "left").join(m, "key", "left")
    same = F.col("old_sha").eqNullSafe(F.col("source_sha256")) & F.col("source_sha256").isNotNull() & (F.col("old_status") == "ok")
    action = F.when(F.col("known").isNull(), "skipped")
    if not force:
        action = action.when(same, "unchanged")
    return f.select("key", action.otherwise("dry_run" if dry_run else "extract").alias("action"))


def source_plan(files: DataFrame, manifest: DataFrame, version: str, policy_sha: str | None = None) -> DataFrame:
    """key, action of each source (key, source_sha256) that is turned into text: ``unchanged`` only where the
    manifest (key, source_sha256, version, policy_sha256, status) has the same source, converter and redaction policy
    and the last run ended well, else ``convert``."""
    m = manifest.select("key", F.col("source_sha256").alias("old_sha"), F.col("version").alias("old_version"), F.col("policy_sha256").alias("old_policy"), F.col("status").alias("old_status"))
    same = F.col("old_sha").eqNullSafe(F.col("source_sha256")) & F.col("source_sha256").isNotNull() & (F.col("old_status") == "ok")
    same = same & F.col("old_version").eqNullSafe(F.lit(version)) & F.col("old_policy").eqNullSafe(F.lit(policy_sha).cast("string"))
    return files.join(m, "key", "left").select("key", F.when(same, "unchanged").otherwise("convert").alias("action"))


def run_report(outcomes: DataFrame, by: str | None = None) -> DataFrame:
    """Counts of outcomes and the overall status: failed if none went well, partial if some failed."""
    n = lambda s: F.sum(F.when(F.col("status") == s, 1).otherwise(0))
    counts = [F.count("*").alias("n"), n("ok").alias("n_ok"), n("skipped").alias("n_skipped"), n("failed").alias("n_failed")]
    out = outcomes.groupBy(by).agg(*counts) if by else outcomes.agg(*counts)
    status = F.when(F.col("n_failed") == 0, "ok").when(F.col("n_ok") > 0, "partial").otherwise("failed")
    return out.withColumn("overall", status)


def changed_outputs(old: DataFrame, new: DataFrame, key: str, sha: str) -> DataFrame:
    """Keys whose output hash differs from the recorded one, or is missing on either side."""
    a, b = old.select(key, F.col(sha).alias("recorded")), new.select(key, F.col(sha).alias("actual"))
    both = a.join(b, key, "full_outer")
    return both.filter(~F.col("recorded").eqNullSafe(F.col("actual")))


def recall(log: DataFrame, n: int = 20, **where: str) -> DataFrame:
    """The latest ``n`` entries of a log by event_id, filtered by equality."""
    for c, v in where.items():
        log = log.filter(F.col(c) == v)
    return log.orderBy(F.desc("event_id")).limit(n)


def skip_rule(path: Column, ignored: Sequence[str] = ()) -> Column:
    """Whether a path is never read: generated or vendored folders, temporary files, ignored names."""
    # Folders that are passed over.
    names = ["kb", ".git", "__pycache__", ".venv", "venv", "node_modules", *(x.rstrip("/") for x in ignored)]
    parts = F.split(path, "/")
    return F.arrays_overlap(parts, F.array(*map(F.lit, names))) | path.endswith(".tmp")


def content_hash(markdown: Column, asset_shas: Column, index: Column) -> Column:
    """The hash of an output: its normal text, the sorted hashes of its assets (array), and its index as JSON, parted
    by marks between NUL characters."""
    assets = F.array_join(F.transform(F.array_sort(asset_shas), lambda a: F.concat(a, F.lit("\x00"))), "")
    return X.sha(F.concat(X.normal_markdown(markdown), F.lit("\x00ASSETS\x00"), assets, F.lit("\x00INDEX\x00"), index))


def first_of(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")
