"""Tables with nulls in every column, rows of nulls, repeated rows, empty and very long texts, large
keys and extra columns, and the same tables without any row."""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LARGE = 9_007_199_254_740_993  # no double has this value
KEYS = {"documents": "doc_id", "atoms": "atom_no", "edges": "edge_no", "index_trees": "record_id", "taxonomies": "record_id"}
TREES = {"index_trees": "index_json", "taxonomies": "taxonomy_json"}
HOSTILE = ['{"node_id":"root","children":[{"title":"\\ud800"}]}', '{"categories":[{"slug":"\\udfff a","children":[{"x":' + "[" * 20_000 + "]" * 20_000 + "}]}]}"]
TEXTS = {"documents": "text", "content_sections": "body"}
DOMAIN = {*KEYS, *TEXTS, "manifest", "sections"}


def odd(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    one = df.limit(1)
    df = df.unionByName(spark.createDataFrame([tuple(None for _ in df.columns)] * 2, df.schema)).unionByName(one)
    for c in one.columns:
        df = df.unionByName(one.withColumn(c, F.lit(None).cast(one.schema[c].dataType)))
    if name in KEYS:
        df = df.unionByName(one.withColumn(KEYS[name], F.lit(LARGE)))
    if name in TEXTS:
        for text in ("", " \n\t", "x" * 200_000, "a b. " * 40_000, "\\" * 5000, "<" * 5000, "\x00﻿\U0001f642"):
            df = df.unionByName(one.withColumn(TEXTS[name], F.lit(text)))
    if name in TREES:
        for text in HOSTILE:
            df = df.unionByName(one.withColumns({TREES[name]: F.lit(text), "record_id": F.lit(LARGE - 100 + len(text) % 50)}))
    return df.withColumns({"n": F.lit(1), "start": F.lit("clash"), "kind": F.lit("clash"), "word": F.lit("clash")})


def write(spark: SparkSession, source: str, to: str, empty: bool) -> str:
    for path in glob.glob(f"{source}/*.parquet"):
        name = os.path.basename(path)[:-8]
        df = spark.read.parquet(path)
        df = df.limit(0) if empty else odd(spark, name, df) if name in DOMAIN else df
        df.coalesce(1).write.parquet(f"{to}/{name}.parquet")
    return to
