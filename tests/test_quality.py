from __future__ import annotations

import pytest

from ledgerlake import fixed_values as fixed
from ledgerlake.operators import quality
from ledgerlake.operators.periods import effective_dated, effective_for_facts, share_of_total


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, "email"), (1, "fax"), (None, "call"), (2, None)], "id int, channel string")


def test_unique(rows):
    assert [tuple(r) for r in quality.not_unique(rows, ["id"]).collect()] == [(1, 2)]


def test_not_null(rows):
    assert quality.null_rows(rows, "id").count() == 1


def test_relationships(spark, rows):
    parents = spark.createDataFrame([(1,)], "pid int")
    assert [r.id for r in quality.orphans(rows, "id", parents, "pid").collect()] == [2]


def test_accepted_values(rows):
    assert [tuple(r) for r in quality.unaccepted(rows, "channel", fixed.TOUCH_CHANNELS).collect()] == [("fax", 1)]


def test_report_in_one_pass(rows):
    report = quality.column_report(rows, ["id", "channel"], {"channel": fixed.TOUCH_CHANNELS})
    assert {r.check: r.failing_rows for r in report.collect()} == {
        "not_null_id": 1, "not_null_channel": 1, "accepted_values_channel": 1,
    }


def test_landed_tables_pass_their_checks(lake):
    leads, touches = lake.ref("stg_leads"), lake.ref("stg_touches")
    assert quality.not_unique(leads, ["lead_id"]).isEmpty()
    assert quality.not_unique(touches, ["touch_id"]).isEmpty()
    assert quality.orphans(touches, "lead_id", leads, "lead_id").isEmpty()
    assert quality.unaccepted(touches, "channel", fixed.TOUCH_CHANNELS).isEmpty()
    assert quality.null_rows(lake.ref("stg_holdings"), "ticker").isEmpty()
    assert quality.not_unique(lake.ref("mart_all_weather"), ["box"]).isEmpty()


def test_dated_rows(spark):
    targets = spark.sql(
        "select * from values ('a', 1, date'2026-01-01', date'2026-03-31'), ('a', 2, date'2026-04-01', null),"
        " ('b', 3, date'2026-02-01', null) as t(k, target, effective_from, effective_to)"
    )
    days = spark.sql("select * from values (date'2026-01-01'), (date'2026-03-31'), (date'2026-04-01') as d(day)")
    got = sorted((str(r.day), r.k, r.target) for r in effective_dated(targets, days, "day").collect())
    assert got == [("2026-01-01", "a", 1), ("2026-03-31", "a", 1), ("2026-03-31", "b", 3), ("2026-04-01", "a", 2), ("2026-04-01", "b", 3)]
    facts = spark.sql("select * from values ('a', date'2026-04-02'), ('c', date'2026-04-02') as f(k, day)")
    assert sorted((r.k, r.target) for r in effective_for_facts(facts, targets, ["k"], "day").collect()) == [("a", 2), ("c", None)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, v double")
    assert {r.k: r.s for r in share_of_total(df, "v", "s").collect()} == {"a": 25.0, "b": 75.0}
