"""Reading of the project's tables, and what every operator needs of them."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of a data directory; columns are pruned by the caller's select."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_delivery(df: DataFrame, keys: Sequence[str], time: str = "loaded_at") -> DataFrame:
    """One row per key, the earliest delivery; repeated deliveries differ in ``time`` only.

    All columns are grouped, so that the aggregation is partial before its shuffle and a key
    with many deliveries never gathers in one task. Rows that differ in other columns under one
    key are resolved by the smallest (time, row), so the result doesn't depend on the order.
    Null keys are kept as one group. An empty table gives an empty table.
    """
    rest = [c for c in df.columns if c not in (*keys, time)]
    return df.groupBy(*keys).agg(F.min(F.struct(time, *rest)).alias("_r")).select(*keys, *(F.col(f"_r.{c}") for c in df.columns if c not in keys))


SLOTS = 1 << 26  # bits for repeated keys; a million rows of 64 at most are broadcast


def first_deliveries(df: DataFrame, keys: Sequence[str], time: str = "loaded_at", slots: int = SLOTS) -> DataFrame:
    """``one_delivery`` for wide rows, of which most keys are delivered once: the same rows, but only keys
    that come again are shuffled.

    Keys are counted by a narrow shuffle, and those that come again set a bit at their hash, ``slots`` bits in all.
    Rows whose bit is not set are alone and stay where they are read; all others, with the few that share a
    bit by chance, go through ``one_delivery``. The choice is one of the key, so each key
    goes one way as a whole, and the result doesn't depend on ``slots``.
    """
    again = df.select(*keys).groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(slot_of(keys, slots).alias("slot"))
    marked = with_bit(spread(df), keys, again, "_again", slots)
    rest = [c for c in df.columns if c not in (*keys, time)]
    alone = marked.filter("not _again").select(*keys, time, *rest)
    return alone.unionByName(one_delivery(marked.filter("_again").select(*df.columns), keys, time).select(*keys, time, *rest))


def deliveries(spark: SparkSession, sf_dir: str, name: str, keys: Sequence[str], columns: Sequence[str], time: str = "loaded_at") -> DataFrame:
    """Keys and columns of a table, each record counted once. A column that the table lacks is null."""
    df = read(spark, sf_dir, name)
    have = df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("timestamp" if c == time else "string").alias(c) for c in (*keys, *columns, time)))
    return first_deliveries(have, keys, time).select(*keys, *columns)


def slot_of(keys: Sequence[str], slots: int = SLOTS) -> Column:
    """The bit of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(slots))


def with_bit(df: DataFrame, keys: Sequence[str], set_: DataFrame, name: str, slots: int = SLOTS) -> DataFrame:
    """``df`` with a column ``name``: whether the bit of its key is among those of ``set_`` (slot).

    The bits are broadcast, 64 in a row, so the size is bounded by ``slots``. A key whose bit is not set is surely
    none of those that set one; a few others share theirs by chance.
    """
    slot = slot_of(keys, slots)
    bits = set_.groupBy(F.shiftright("slot", 6).alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("slot", F.lit(64)).cast("int"))).alias("_bits"))
    both = df.join(F.broadcast(bits), F.shiftright(slot, 6) == F.col("_word"), "left")
    return both.select(*df.columns, (F.coalesce(F.getbit("_bits", F.pmod(slot, F.lit(64)).cast("int")), F.lit(0)) == 1).alias(name))


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many parts as there are cores, if its files give less than half of that."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() < cores else df


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the folder that all executors share, with its lineage cut.

    The folder is the session's ``spark.checkpoint.dir``; only where that is unset and all runs on
    one machine, as in tests, a temporary folder is set. A cluster without the setting is an error.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, set as the session's checkpoint folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def squeezed(c: Column) -> Column:
    """``c`` without white space at its ends, Unicode spaces included."""
    return F.regexp_replace(c, r"(?U)^[\s\x{FEFF}]+|[\s\x{FEFF}]+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (squeezed(c) == "")


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
