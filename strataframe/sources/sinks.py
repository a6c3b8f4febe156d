"""Sinks of derived layers: files for people beside the tables, written whole or not at all."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.sources.config import replace


def export_files(files: DataFrame, root: str, skip_existing: bool = False) -> None:
    """Writes each row (path, text) as a file below a folder that all executors share. Files are
    replaced as a whole, so a task that runs twice does no harm; paths out of the folder raise."""
    def write(rows) -> None:
        import os

        for r in rows:
            path = posixpath.normpath(posixpath.join(root, r.path))
            if not path.startswith(root.rstrip("/") + "/"):
                raise ValueError(f"{r.path} leaves {root}")
            if not (skip_existing and os.path.exists(path)):
                replace(path, r.text)

    files.select("path", "text").foreachPartition(write)


def page_files(pages: DataFrame) -> DataFrame:
    """path, text of pages (slug, markdown, and category or nothing): one folder for each category."""
    folder = F.concat(F.col("category"), F.lit("/")) if "category" in pages.columns else F.lit("")
    return pages.select(F.concat(folder, "slug", F.lit(".md")).alias("path"), F.col("markdown").alias("text"))


def vault_files(docs: DataFrame) -> DataFrame:
    """path, text of documents (doc_id, text) for a note vault: block references after headings, links
    to ``main.md#anchor`` as links to the note's block."""
    linked = F.regexp_replace(X.with_block_refs(F.col("text")), r"\]\((?:[^()\s]*/)?main\.md#(sec-\d+)\)", "](#^$1)")
    return docs.select(F.concat("doc_id", F.lit(".md")).alias("path"), linked.alias("text"))


def index_json(topics: DataFrame, evidence: DataFrame) -> DataFrame:
    """slug, json: metadata of each topic (slug, title) with its evidence (slug, ev_no, doc_id, anchor),
    in the order of the numbers."""
    e = evidence.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("ev_no", "doc_id", "anchor"))).alias("evidence"))
    return topics.join(e, "slug").select("slug", F.to_json(F.struct("slug", "title", "evidence")).alias("json"))


def catalog_lines(pages: DataFrame) -> DataFrame:
    """domain, title, path, line: the links of pages (domain, title, path, sources). Sorted by domain and
    title, under a heading for each domain, they are the catalog."""
    source = F.array_join(F.array_sort(F.array_distinct("sources")), ", ")
    line = F.concat(F.lit("- "), X.wikilink(F.col("path"), F.col("title")), F.when(source == "", "").otherwise(F.concat(F.lit(" - sources: "), source)))
    return pages.select("domain", "title", "path", line.alias("line"))


def catalog(pages: DataFrame) -> DataFrame:
    """domain, text: the lines of each domain under a heading, for domains whose catalog is one file.
    What is gathered is that file; ``catalog_lines`` gathers nothing."""
    lines = catalog_lines(pages).groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("title", "path", "line"))).alias("x"))
    return lines.select("domain", F.concat(F.lit("## "), "domain", F.lit("\n\n"), F.array_join(F.transform("x", lambda v: v["line"]), "\n"), F.lit("\n")).alias("text"))


def append_log(entries: DataFrame, path: str) -> None:
    """Appends rows to a log; a log is never rewritten."""
    entries.write.mode("append").parquet(path)


def sidecar(n_redacted: Column, source_sha: Column, policy_sha: Column) -> Column:
    """What is recorded beside a redacted text: counts and hashes only."""
    return F.to_json(F.struct(n_redacted.alias("redacted"), source_sha.alias("source_sha256"), policy_sha.alias("policy_sha256")))
