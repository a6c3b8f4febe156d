import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataframe.operators import references as R


def t(day):
    return dt.datetime(2024, 1, day)


REFS = "ref_field string, record_no long, kind string, key string, at timestamp"
TARGETS = "kind string, key string, start timestamp, end timestamp"


@pytest.fixture
def tables(spark):
    refs = [("e.a", 1, "atoms", "x", t(5)), ("e.a", 2, "atoms", "x", t(1)), ("e.a", 3, "atoms", "gone", t(9)), ("e.a", 4, "atoms", "gone", t(3)), ("e.a", 5, "atoms", None, t(3)), ("e.a", 6, "sections", "x", t(5)), ("e.a", 1, "atoms", "x", t(5))]
    targets = [("atoms", "x", t(2), None), ("atoms", "x", t(4), None), ("atoms", "gone", t(2), t(7)), ("atoms", "gone", t(3), t(7)), ("atoms", None, t(1), None)]
    return spark.createDataFrame(refs, REFS), spark.createDataFrame(targets, TARGETS)


def brute(refs, targets):
    have = targets.collect()
    return sorted(r.record_no for r in refs.collect() if not any(h.key is not None and h.key == r.key and h.kind == r.kind and h.start <= r.at and (h.end is None or h.end > r.at) for h in have))


@pytest.mark.parametrize("kw", [{}, {"heavy_rows": 1}, {"heavy_rows": 2}, {"heavy_rows": 2, "broadcast_rows": 1, "salts": 3}, {"heavy_rows": 1, "broadcast_rows": 0}])
def test_all_ways_give_the_same(tables, kw):
    refs, targets = tables
    assert sorted(r.record_no for r in R.orphans(refs, targets, **kw).collect()) == brute(refs, targets) == [2, 3, 5, 6]


def test_empty_tables(spark, tables):
    refs, targets = tables
    assert R.orphans(refs.limit(0), targets, heavy_rows=1).count() == 0
    assert R.orphans(refs, targets.limit(0), heavy_rows=1).count() == refs.count()


def test_normal_references(spark):
    rows = [("kb/M1 A B/main.md#sec-1", "m1 a b#sec-1"), (" KB\\M1 A B\\main.md#SEC-1\n", "m1 a b#sec-1"), ("./kb/M1%20A%20B/main.md#sec-1", "m1 a b#sec-1"), ("#sec-2", "own#sec-2"), ("sec-2", "own#sec-2"), ("main.md#sec-2", "own#sec-2"), ("kb/50%+1/main.md#s", "50%+1#s"), (None, None)]
    df = spark.createDataFrame([(a, "Own") for a, _ in rows], "ref string, doc string")
    got = [r[0] for r in df.select(R.evidence_key(F.col("ref"), F.col("doc"))).collect()]
    assert got[:-1] == [b for _, b in rows[:-1]]


def test_report_counts_by_month(spark, tables):
    found = R.orphans(*tables)
    assert {(r.table_name, r.field, r.month, r.n_orphans) for r in R.orphan_report(found).collect()} == {("e", "a", "2024-01", 4)}


def test_a_heavy_key_beyond_the_production_bound(spark):
    """More references to one key than ``HEAVY_ROWS``, with the production parameters."""
    n = R.HEAVY_ROWS + 5_000
    refs = spark.range(n).select(F.lit("edges.source_id").alias("ref_field"), F.col("id").alias("record_no"), F.lit("atoms").alias("kind"), F.when(F.col("id") % 20 == 0, F.concat(F.lit("k"), F.col("id") % 200)).otherwise("hot").alias("key"), F.timestamp_seconds(F.col("id") * 60).alias("at"))
    refs = refs.unionByName(refs.withColumn("record_no", F.col("record_no") + n))
    targets = spark.createDataFrame([("atoms", "hot", 0, 60 * 30_000), ("atoms", "k20", 0, None)], "kind string, key string, s long, e long").select("kind", "key", F.timestamp_seconds("s").alias("start"), F.timestamp_seconds("e").alias("end"))
    want = {i + k * n for k in (0, 1) for i in range(n) if (i % 20 and i >= 30_000) or (i % 20 == 0 and i % 200 != 20)}
    got = R.orphans(refs, targets)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert {r.record_no for r in got.select("record_no").collect()} == want
    month = {(r.month, r.n_orphans) for r in R.orphan_report(got).collect()}
    counted = R.orphans(R.counted(refs), targets)
    assert {(r.month, r.n_orphans) for r in R.orphan_report(counted).collect()} == month
