"""The bitmap of keys: loses no wanted row, keeps few others, and thins out what an append shuffles."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import keyfilter
from ledgerlake.sinks import tables


@pytest.mark.parametrize("count", [1, 3000, 10**9])
def test_no_wanted_row_is_lost(spark, count, monkeypatch):
    monkeypatch.setattr(keyfilter, "MOST_ROWS", 4)
    stored = spark.range(60000).selectExpr("if(id % 1000 = 0, null, id) as k", "cast(id % 7 as string) as part", "id as v")
    wanted = stored.where("v % 20 = 0").select(F.col("k").alias("a"), F.col("part").alias("b"))
    got = {r.v for r in keyfilter.likely_in(stored, ["k", "part"], wanted, ["a", "b"], count).collect()}
    assert {v for v in range(0, 60000, 20)} <= got
    if count == 3000:  # 3,000 keys in 98,304 bits
        assert len(got) < 60000 * (0.05 + 0.06)


def test_nothing_wanted_and_nothing_stored(spark):
    stored, none = spark.range(10).selectExpr("id as k"), spark.range(0).selectExpr("id as k")
    assert keyfilter.likely_in(stored, ["k"], none, ["k"], 0).count() == 0
    assert keyfilter.likely_in(none, ["k"], stored, ["k"], 10).count() == 0


def test_types_that_differ_are_left_to_the_join(spark):
    stored, batch = spark.range(10).selectExpr("cast(id as int) as k"), spark.range(5, 15).selectExpr("id as k")
    assert keyfilter.likely_in(stored, ["k"], batch, ["k"], 10).count() == 10
    assert sorted(r.k for r in tables.new_rows(stored, batch, ["k"]).collect()) == [10, 11, 12, 13, 14]


def test_size_of_the_bitmap_is_bounded():
    assert [keyfilter.rows_for(n) for n in (0, 1, 1024, 1025, 10**12)] == [1, 1, 1, 2, keyfilter.MOST_ROWS]


def test_an_append_shuffles_the_batch_s_share_of_the_stored_keys(spark, tmp_path):
    spark.range(0, 400000).selectExpr("id as k", "id as v").write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    batch = spark.range(399000, 401000).selectExpr("id as k", "id as v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = tables.new_rows(stored, batch, ["k"])
        assert fresh.count() == 1000 and fresh.agg(F.min("k")).head()[0] == 400000
        seen = keyfilter.likely_in(stored.select("k"), ["k"], batch, ["k"], 2000)
        assert seen.count() < 400000 * 0.05
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The bitmap meets the scan below the shuffle of the anti join.
    assert re.search(r"LeftAnti(?s:.)*Exchange hashpartitioning(?s:.)*BroadcastHashJoin(?s:.)*FileScan", plan)
