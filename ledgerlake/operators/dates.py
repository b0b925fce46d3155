"""Calendar work that is an addition to the specification: rolling sums, a date table, months without
gaps, dated occurrences of recurring items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What the named frequencies of recurring items mean: a number of days or of months.
FREQUENCIES = {
    "weekly": (7, "days"),
    "biweekly": (14, "days"),
    "every_two_weeks": (14, "days"),
    "monthly": (1, "months"),
    "every_two_months": (2, "months"),
    "quarterly": (3, "months"),
    "semiyearly": (6, "months"),
    "yearly": (12, "months"),
}


def rolling_sums(df: DataFrame, keys: Sequence[str], day: str, value: str, spans: Mapping[str, int]) -> DataFrame:
    """Per key and day with rows: the day's sum as `total`, and the sums of the last n calendar days.

    Rows are summed to days map-side, so a key has at most as many rows as the calendar has days when
    its frames are made, however hot it is. Days without rows count as nothing. A null key is a key;
    rows without a day take no part; a day of null values alone has a null total.
    """
    daily = df.where(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.sum(value).alias("total"))
    by_day = Window.partitionBy(*keys).orderBy(F.unix_date(day))
    return daily.withColumns({out: F.sum("total").over(by_day.rangeBetween(1 - n, 0)) for out, n in spans.items()})


def date_table(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row a day from first to last, both included, with the parts reports group by."""
    bounds = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    day = F.col("day")
    return bounds.select(
        "day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("iso_week"),
        (F.weekday(day) + 1).alias("iso_weekday"),
        F.trunc(day, "month").alias("month_start"),
        F.last_day(day).alias("month_end"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def without_gaps(
    df: DataFrame,
    keys: Sequence[str],
    month: str,
    until: Column,
    flows: Sequence[str] = (),
    states: Sequence[str] = (),
) -> DataFrame:
    """A row for every month of a key, from its first to `until` or its last, whichever is later.

    `df` has one row per key and first of a month. A month that was missing has zero in `flows` and the
    last known value in `states`, and `is_filled` is true. Each row is spread up to the month before
    the next one of its key: nothing is joined, and a key has as many rows as the calendar has months.
    Rows without a month take no part; a null key is a key.
    """
    by_month = Window.partitionBy(*keys).orderBy(month)
    known = {s: F.last(s, ignorenulls=True).over(by_month) for s in states}
    ends = F.coalesce(F.add_months(F.lead(month).over(by_month), -1), until)
    ended = df.where(F.col(month).isNotNull()).withColumns({"__ends": ends, **known})
    spread = F.sequence(F.col(month), F.greatest(month, "__ends"), F.expr("interval 1 month"))
    rows = ended.select(*keys, *flows, *states, F.posexplode(spread).alias("__filled", month))
    filled = F.col("__filled") > 0
    zero = {f: F.lit(0).cast(dict(df.dtypes)[f]) for f in flows}
    return rows.select(
        *keys, month, *[F.when(filled, zero[f]).otherwise(F.col(f)).alias(f) for f in flows], *states, filled.alias("is_filled")
    )


def occurrences(
    items: DataFrame,
    due: str,
    frequency: str,
    first: date,
    last: date,
    frequencies: Mapping[str, tuple[int, str]] = FREQUENCIES,
) -> DataFrame:
    """Items once for each date from first to last on which they fall due, as `occurs_on`.

    Dates count from the item's own due date, never before it; those by months keep its day, or take
    the last day of a month that lacks it (31 January, 28 February, 31 March). An item of another or no
    frequency falls due once. The steps within the span are computed, not walked to.
    """
    start, day0, day1 = F.col(due), F.lit(first), F.lit(last)

    def step(unit: str) -> Column:
        pairs = [F.lit(x) for name, (n, u) in frequencies.items() if u == unit for x in (name, n)]
        return F.create_map(*pairs)[F.lower(F.trim(frequency))] if pairs else F.lit(None).cast("int")

    def months(of: Column) -> Column:
        return F.year(of) * 12 + F.month(of)

    by_day, by_month = step("days"), step("months")

    def steps(units_to_first: Column, units_to_last: Column, n: Column) -> Column:
        low = F.greatest(F.lit(0), F.ceil(units_to_first / n).cast("int"))
        high = F.floor(units_to_last / n).cast("int")
        return F.when(high >= low, F.sequence(low, high))

    dated = F.when(
        by_day.isNotNull(),
        F.transform(steps(F.datediff(day0, start), F.datediff(day1, start), by_day), lambda k: F.date_add(start, k * by_day)),
    ).when(
        by_month.isNotNull(),
        F.transform(steps(months(day0) - months(start), months(day1) - months(start), by_month), lambda k: F.add_months(start, k * by_month)),
    ).otherwise(F.array(start))
    return items.withColumn("occurs_on", F.explode(dated)).where(F.col("occurs_on").between(day0, day1))
