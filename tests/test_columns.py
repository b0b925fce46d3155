"""The semantic traps: one check each."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import columns as fn
from ledgerlake.operators.periods import Month


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).head()[0]


@pytest.mark.parametrize(("x", "digits", "expected"), [(1.005, 2, 1.0), (0.285, 2, 0.28), (2.5, 0, 3.0), (-2.5, 0, -3.0), (1.25, 1, 1.3)])
def test_binary_rounding(spark, x, digits, expected):
    assert value(spark, fn.round_to(F.lit(x), digits)) == expected


def test_whole_numbers_round_instead_of_truncating(spark):
    df = spark.createDataFrame([("12.7",), ("12.2",), ("x",), (None,)], "a string")
    got = [r[0] for r in df.select(fn.Typed(df).integer("a")).collect()]
    assert got == [13, 12, None, None]
    assert value(spark, fn.whole_text(F.lit(2.5))) == "3"


def test_text_dates_must_be_whole(spark):
    df = spark.createDataFrame([("2026-01-05",), ("2026",), ("2026-02",), ("soon",), ("2026-02-30",), ("",)], "d string")
    got = [r[0] for r in df.select(fn.Typed(df).date("d")).collect()]
    assert got == [date(2026, 1, 5), None, None, None, None, None]


def test_bad_numbers_and_nan_are_missing(spark):
    df = spark.createDataFrame([("1.2345",), ("nan",), ("-",)], "n string")
    t = fn.Typed(df)
    assert [r[0] for r in df.select(t.ratio("n")).collect()] == [1.2345, None, None]
    assert [float(r[0]) if r[0] is not None else None for r in df.select(t.number("n")).collect()] == [1.235, None, None]


def test_typed_input_passes_through(spark):
    df = spark.sql("select date'2026-01-05' as d, true as f, 5 as i")
    t = fn.Typed(df)
    assert df.select(t.date("d"), t.flag("f"), t.integer("i")).head() == (date(2026, 1, 5), True, 5)


def test_ratios_guard_zero(spark):
    assert value(spark, fn.percent(F.lit(1), F.lit(0), 1)) is None
    assert value(spark, fn.percent(F.lit(1), F.lit(3), 1)) == 33.3
    assert value(spark, fn.change_percent(F.lit(-1.0), F.lit(-2.0), absolute_base=True)) == 50.0


def test_direction_of_missing_is_flat(spark):
    assert value(spark, fn.direction(F.lit(1.0), F.lit(None).cast("double"))) == "flat"


def test_epoch_days_are_utc(spark):
    df = spark.createDataFrame([("1767571200",), ("1767571199",), ("0",), (None,)], "s string")
    got = [r[0] for r in df.select(fn.Typed(df).epoch_date("s")).collect()]
    assert got == [date(2026, 1, 5), date(2026, 1, 4), date(1970, 1, 1), None]


def test_levels_and_bins(spark):
    cuts = [value(spark, fn.history_level(F.lit(p), "calm")) for p in (0.95, 0.9, 0.7, 0.3, 0.29)]
    assert cuts == ["extreme", "extreme", "elevated", "normal", "calm"]
    bins = [(7.0, "a"), (9.0, "b")]
    got = [value(spark, fn.bin_label(F.lit(x).cast("double"), bins, "c", "none")) for x in (6.9, 7.0, 9.0, None)]
    assert got == ["a", "b", "c", "none"]


def test_month_arithmetic():
    month = Month(date(2026, 3, 31))
    assert (month.start, month.back(3), month.back(-10)) == (date(2026, 3, 1), date(2025, 12, 1), date(2027, 1, 1))
    assert (month.elapsed, month.days, Month(date(2024, 2, 10)).days) == (31, 31, 29)
    assert month.complete_months(2) == [date(2026, 2, 1), date(2026, 1, 1)]
