"""Queries of the problems of texts over whole tables, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm import bpe, language, markup, packing, quality, scans, split
from strataframe.tables import first_deliveries, one_delivery, read


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content sections, each counted once."""
    return first_deliveries(read(spark, sf_dir, "content_sections").select("doc_id", "anchor", "body", "loaded_at"), ["doc_id", "anchor"]).select("doc_id", "anchor", "body")


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.clean_markup(_bodies(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_clean(spark, sf_dir).select("doc_id", "anchor", F.explode("markup").alias("markup"))


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repair_scans(_bodies(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_repaired(spark, sf_dir).select("doc_id", "anchor", F.explode("noise").alias("noise"))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_oversized(_bodies(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_pieces(spark, sf_dir).filter("piece_no = 1").select("doc_id", "anchor")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = read(spark, sf_dir, "sections").filter(F.trim("anchor") != "").select("doc_id", "anchor", "language", "loaded_at")
    return one_delivery(named, ["doc_id", "anchor"]).select("doc_id", "anchor", F.col("language").alias("label"))


def _segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    bodies, labels = _bodies(spark, sf_dir), _labels(spark, sf_dir)
    model = language.train(labels, read(spark, sf_dir, "content_sections").select("doc_id", "anchor", "body"))
    return language.segments(bodies, model), labels


def p6_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir)[0]


def p6_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.documents(_segments(spark, sf_dir)[0])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.mislabelled(*_segments(spark, sf_dir))


def vocabulary(spark: SparkSession) -> str:
    """The vocabulary file: the session's setting, else where the public tokenizers are installed.
    The folder must be the same on all machines."""
    return spark.conf.get("strataframe.vocabulary", None) or f"{os.environ.get('TOKENIZERS_DIR', '/opt/tokenizers')}/{bpe.VOCABULARY}"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, each counted once."""
    return first_deliveries(read(spark, sf_dir, "documents").select("doc_id", "text", "loaded_at"), ["doc_id"]).select("doc_id", "text")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_texts(spark, sf_dir), vocabulary(spark))


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(bpe.counts(_texts(spark, sf_dir), vocabulary(spark)))


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = p9_pack(spark, sf_dir).groupBy("container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("n_items"))
    return boxes.agg(F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), F.max("used").alias("fullest"), (F.sum("used") / (F.count("*") * packing.CAPACITY)).alias("fill"))


def p10_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.text_quality(_texts(spark, sf_dir), read(spark, sf_dir, "common_words"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_stats(spark, sf_dir).filter("shape != 'prose'").select("doc_id", "shape")


QUERIES = {"p8_ids": p8_ids, "p9_pack": p9_pack, "p9_fill": p9_fill, "p10_found": p10_found, "p10_stats": p10_stats, "p3_found": p3_found, "p3_pieces": p3_pieces, "p6_found": p6_found, "p6_segments": p6_segments, "p6_documents": p6_documents, "p4_found": p4_found, "p4_clean": p4_clean, "p5_found": p5_found, "p5_repaired": p5_repaired}
ORACLE: dict[str, str] = {
    "p3_found": "SELECT DISTINCT doc_id, anchor FROM content_sections WHERE length(body) > 6000",
}
