"""Files as DataFrames: discovery, reading through the registry, and the sinks of what was read."""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.operators import store
from strataframe.sources.registry import Registry, default

DEPTH = 5  # archives inside archives

EXTRACTED = "path string, adapter string, status string, reason string, source_sha256 string, sections array<struct<anchor:string,level:int,title:string,body:string>>, tables array<struct<anchor:string,html:string>>, assets array<struct<name:string,kind:string,n_bytes:long,sha256:string,width:int,height:int>>, warnings array<string>"


def discover(spark: SparkSession, path: str, only: list[str] | None = None, ignored: list[str] = ()) -> DataFrame:
    """Files below a folder (path, length, content), without those that are never read; ``only``
    keeps the given suffixes. The content is read where it is used. Empty files hold nothing to read
    and give no row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    rest = F.regexp_replace("path", r"^\w+:/*", "/")
    files = files.withColumn("rel", F.expr(f"substring({rest._jc.toString()}, {len(path.rstrip('/')) + 2})"))
    files = files.filter(~store.skip_rule(F.col("rel"), ignored))
    if only:
        files = files.filter(X.suffix(F.col("path")).isin([s.lower() for s in only]))
    return files.select(F.col("rel").alias("path"), "length", "content")


def _one(registry: Registry, path: str, data: bytes, depth: int) -> Iterator[tuple]:
    sha = hashlib.sha256(data).hexdigest()
    name = posixpath.basename(path)
    reader = registry.pick(posixpath.splitext(name)[1])
    if reader is None:
        yield path, None, "skipped", "no_adapter", sha, [], [], [], []
        return
    try:
        doc = reader.read(data, name)
    except Exception as e:  # one bad file never stops the others
        yield path, reader.name, "failed", repr(e)[:500], sha, [], [], [], []
        return
    assets = [(n, k, len(c), hashlib.sha256(c).hexdigest(), w, h) for n, k, c, w, h in doc.assets]
    warnings = list(doc.warnings)
    if doc.members and depth >= DEPTH:
        warnings.append("archive too deep")
    yield path, reader.name, "ok", None, sha, doc.sections, doc.tables, assets, warnings
    if depth < DEPTH:
        for member, content in doc.members:
            yield from _one(registry, f"{path}/{member}", content, depth + 1)


def extract(files: DataFrame, registry: Registry | None = None) -> DataFrame:
    """One row, as in ``EXTRACTED``, for each file (path, content) and each member of an archive.
    Unknown kinds are skipped, broken files fail alone; null contents count as empty files."""
    names = [c.split(" ")[0] for c in "path adapter status reason source_sha256 sections tables assets warnings".split()]

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = registry or default()
        for b in batches:
            for path, content in zip(b.path, b.content):
                rows = list(_one(r, path, bytes(content) if content is not None else b"", 0))
                yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(of, EXTRACTED)


def markdown(extracted: DataFrame) -> DataFrame:
    """path, text: the sections of each file as Markdown with an anchor before each heading."""
    line = F.transform("sections", lambda s: F.concat(F.lit('<a id="'), s["anchor"], F.lit('"></a>\n'), F.repeat(F.lit("#"), s["level"]), F.lit(" "), s["title"], F.when(s["body"] == "", "").otherwise(F.concat(F.lit("\n\n"), s["body"]))))
    return extracted.filter("status = 'ok'").select("path", X.normal_markdown(F.array_join(line, "\n\n")).alias("text"))


def write_documents(extracted: DataFrame, path: str) -> None:
    """Writes the extracted documents; a failed run leaves what was there before it was complete."""
    extracted.write.mode("overwrite").parquet(path)


def manifest_rows(extracted: DataFrame) -> DataFrame:
    """Rows for the manifest: key, source_sha256, status, adapter_name, n_sections, n_warnings."""
    return extracted.select(F.col("path").alias("key"), "source_sha256", "status", F.col("adapter").alias("adapter_name"), F.size("sections").alias("n_sections"), F.size("warnings").alias("n_warnings"))
