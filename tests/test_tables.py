"""Deliveries merged with and without a shuffle of their rows, and the shared folder."""

import random

import pytest

from strataframe import tables


@pytest.mark.parametrize("slots", [1, 64, 200, tables.SLOTS])
def test_first_deliveries_are_one_delivery(spark, slots):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None, f"k{i}"]), r.choice([1, None, i]), r.choice([None, 1.0, 2.0, 3.0]), r.choice(["x", None, "y" * 50])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id string, no int, loaded_at double, text string").repartition(3)
    want = sorted(map(tuple, tables.one_delivery(df, ["doc_id", "no"]).select("doc_id", "no", "loaded_at", "text").collect()), key=str)
    got = tables.first_deliveries(df, ["doc_id", "no"], slots=slots).select("doc_id", "no", "loaded_at", "text").collect()
    assert sorted(map(tuple, got), key=str) == want
    assert tables.first_deliveries(df.limit(0), ["doc_id", "no"], slots=slots).count() == 0


def test_rows_that_come_once_are_not_shuffled(spark, sf):
    df = tables.first_deliveries(tables.read(spark, sf, "documents").select("doc_id", "text", "loaded_at"), ["doc_id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_the_shared_folder_is_the_session_s(spark):
    assert spark.conf.get("spark.checkpoint.dir") in tables.shared_folder(spark)
