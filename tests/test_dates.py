"""Rolling sums, the date table, months without gaps and recurring items, on small cases."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerlake.operators.dates import date_table, occurrences, rolling_sums, without_gaps


def d(text):
    return date.fromisoformat(text)


def test_rolling_sums_by_calendar_with_a_hot_key(spark):
    rows = [("a", d("2026-01-01"), 1), ("a", d("2026-01-07"), 2), ("a", d("2026-01-08"), 4), ("a", d("2026-02-06"), 8)]
    rows += [(None, d("2026-01-01"), 1), ("a", None, 100), ("b", d("2026-01-01"), None)]
    df = spark.createDataFrame(rows, "k string, day date, v int")
    hot = spark.range(30000).selectExpr("'hot' as k", "date'2026-01-01' + cast(id % 3 as int) * 10 as day", "1 as v")
    got = rolling_sums(df.unionByName(hot), ["k"], "day", "v", {"w7": 7, "w30": 30})
    seen = {(r.k, str(r.day)): (r.total, r.w7, r.w30) for r in got.collect()}
    assert seen == {
        ("a", "2026-01-01"): (1, 1, 1),
        ("a", "2026-01-07"): (2, 3, 3),
        ("a", "2026-01-08"): (4, 6, 7),
        ("a", "2026-02-06"): (8, 8, 12),
        (None, "2026-01-01"): (1, 1, 1),
        ("b", "2026-01-01"): (None, None, None),
        ("hot", "2026-01-01"): (10000, 10000, 10000),
        ("hot", "2026-01-11"): (10000, 10000, 20000),
        ("hot", "2026-01-21"): (10000, 10000, 30000),
    }
    assert rolling_sums(df.limit(0), ["k"], "day", "v", {"w7": 7}).count() == 0


def test_date_table_over_a_leap_february(spark):
    rows = {r.day: r for r in date_table(spark, d("2024-02-28"), d("2024-03-03")).collect()}
    assert len(rows) == 5
    leap = rows[d("2024-02-29")]
    assert (leap.quarter, leap.iso_week, leap.iso_weekday, leap.is_weekend) == (1, 9, 4, False)
    assert leap.month_end == d("2024-02-29") and rows[d("2024-03-03")].is_weekend


def test_months_without_gaps(spark):
    rows = [
        ("a", d("2025-11-01"), 5, "x"), ("a", d("2026-02-01"), 7, None), ("b", d("2026-05-01"), 1, "y"),
        (None, d("2026-03-01"), 2, None), ("c", None, 9, "z"),
    ]
    df = spark.createDataFrame(rows, "k string, month date, spent int, state string")
    got = without_gaps(df, ["k"], "month", F.lit(d("2026-03-01")), ["spent"], ["state"])
    assert got.columns == ["k", "month", "spent", "state", "is_filled"]
    assert sorted(((r.k or "-", str(r.month)[:7], r.spent, r.state, r.is_filled) for r in got.collect())) == [
        ("-", "2026-03", 2, None, False),
        ("a", "2025-11", 5, "x", False),
        ("a", "2025-12", 0, "x", True),
        ("a", "2026-01", 0, "x", True),
        ("a", "2026-02", 7, "x", False),
        ("a", "2026-03", 0, "x", True),
        ("b", "2026-05", 1, "y", False),
    ]
    assert without_gaps(df.limit(0), ["k"], "month", F.lit(d("2026-03-01")), ["spent"]).count() == 0


ITEMS = [
    ("rent", d("2024-01-31"), "monthly"), ("gym", d("2026-01-05"), " Weekly "), ("tax", d("2020-02-29"), "yearly"),
    ("once", d("2026-02-11"), None), ("odd", d("2026-01-02"), "sometimes"), ("later", d("2026-03-15"), "monthly"),
    ("none", None, "monthly"), ("past", d("2025-12-31"), "quarterly"),
]


def due(spark, first, last):
    items = spark.createDataFrame(ITEMS, "name string, due date, every string")
    found = occurrences(items, "due", "every", d(first), d(last)).collect()
    return sorted((r.name, str(r.occurs_on)) for r in found)


def test_occurrences_at_month_ends_and_leap_days(spark):
    assert due(spark, "2026-01-20", "2026-03-31") == [
        ("gym", "2026-01-26"), ("gym", "2026-02-02"), ("gym", "2026-02-09"), ("gym", "2026-02-16"), ("gym", "2026-02-23"),
        ("gym", "2026-03-02"), ("gym", "2026-03-09"), ("gym", "2026-03-16"), ("gym", "2026-03-23"), ("gym", "2026-03-30"),
        ("later", "2026-03-15"), ("once", "2026-02-11"), ("past", "2026-03-31"),
        ("rent", "2026-01-31"), ("rent", "2026-02-28"), ("rent", "2026-03-31"), ("tax", "2026-02-28"),
    ]
    assert ("tax", "2028-02-29") in due(spark, "2028-02-01", "2028-03-01")


def test_a_span_in_pieces_gives_the_same_dates(spark):
    whole = due(spark, "2025-12-01", "2026-06-30")
    day, pieces = d("2025-12-01"), []
    while day <= d("2026-06-30"):
        end = min(day + timedelta(days=40), d("2026-06-30"))
        pieces += due(spark, str(day), str(end))
        day = end + timedelta(days=1)
    assert sorted(pieces) == whole
