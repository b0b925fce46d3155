"""Calendar bounds, dated targets, pacing and shares."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import percent
from ledgerlake.operators.ordered import partitions

# Fixed value: the end date of a target that is still in force.
OPEN_END = "2999-12-31"


@dataclass(frozen=True)
class Month:
    """The month an as-of date falls in, with the bounds the comparisons need."""

    as_of: date

    @property
    def start(self) -> date:
        return self.as_of.replace(day=1)

    def back(self, months: int) -> date:
        index = self.start.year * 12 + self.start.month - 1 - months
        return date(index // 12, index % 12 + 1, 1)

    @property
    def days(self) -> int:
        return (self.back(-1) - self.start).days

    @property
    def elapsed(self) -> int:
        return (self.as_of - self.start).days + 1

    def complete_months(self, n: int) -> list[date]:
        """First days of the n whole months before this one, newest first."""
        return [self.back(i) for i in range(1, n + 1)]


def in_force(on: Column) -> Column:
    """Condition for a dated row (effective_from / effective_to, blank end = open)."""
    end = F.coalesce(F.col("effective_to"), F.lit(OPEN_END).cast("date"))
    return (on >= F.col("effective_from")) & (on <= end)


def effective_dated(targets: DataFrame, dates: DataFrame, date_column: str) -> DataFrame:
    """Target rows in force on each date.

    `dates` is a short list (the months of a comparison): a range join has no key to shuffle
    by, so Spark broadcasts the side it knows to be small. For fact tables use
    effective_for_facts, which has an equality key.
    """
    return targets.join(dates, in_force(F.col(date_column)))


def effective_for_facts(
    facts: DataFrame, targets: DataFrame, keys: Sequence[str], date_column: str
) -> DataFrame:
    """Fact rows with the dimension row in force that day: equality on keys, dates residual."""
    condition = in_force(F.col(date_column))
    for k in keys:
        condition = (facts[k] == targets[k]) & condition
    joined = facts.join(targets, condition, "left")
    for k in keys:
        joined = joined.drop(targets[k])
    return joined


#: Buckets that an interval may meet before it goes to a level of wider ones, the levels, and the
#: parts over which the facts of a wider bucket are dealt.
MOST_BUCKETS, LEVELS, PARTS = 64, 4, 8
#: Facts, and spans, that lie together when they meet.
FACTS, SPANS = 256, 64


def interval_join(
    facts: DataFrame, spans: DataFrame, at: str, start: str, end: str, width: int = 3600
) -> DataFrame:
    """Pairs of a fact and a span with start <= at <= end, both sides large and without a common key.

    Time is cut into buckets of `width` seconds; a span goes into every bucket it meets, a fact
    into its own, and the buckets are the key of an equality join with the exact test behind it.
    A span that would meet more than MOST_BUCKETS of them goes to a level of buckets that are
    MOST_BUCKETS times as wide, and so on; a fact has one bucket on each of the LEVELS that has spans.
    A wider bucket holds a larger share of the facts, so these are dealt over PARTS and its spans
    go to each part. So every pair meets in one part of one bucket of one level. Spans are cut to
    the time that the facts cover: an open end (null) costs no more than that. A null time or start
    meets nothing. Work and result grow with the number of pairs.
    """
    seconds = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in (at, start, end)}
    covered = facts.agg(F.min(seconds[at]).alias("__from"), F.max(seconds[at]).alias("__to"))
    wide = [width * 1_000_000 * MOST_BUCKETS**level for level in range(LEVELS)]

    def bucket(micros: Column, level: Column) -> Column:
        return F.floor(micros / F.get(F.array(*[F.lit(w) for w in wide]), level)).cast("long")

    cut = spans.crossJoin(F.broadcast(covered)).withColumns(
        {"__from": F.greatest(seconds[start], "__from"), "__to": F.least(F.coalesce(seconds[end], "__to"), "__to")}
    )
    cut = cut.where(F.col(start).isNotNull() & (F.col("__from") <= F.col("__to")))
    length = F.col("__to") - F.col("__from")
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(length < wide[k] * (MOST_BUCKETS - 1), F.lit(k)).otherwise(level)
    met = cut.withColumn("__level", level)
    first, last = bucket(F.col("__from"), F.col("__level")), bucket(F.col("__to"), F.col("__level"))
    met = met.withColumn("__bucket", F.explode(F.sequence(first, last))).drop("__from", "__to")
    met = met.withColumn("__part", F.explode(F.sequence(F.lit(0), F.when(F.col("__level") > 0, PARTS - 1).otherwise(0))))

    # At most LEVELS rows.
    levels = cut.select(level.alias("__level")).distinct()
    dealt = facts.where(F.col(at).isNotNull()).crossJoin(F.broadcast(levels))
    hashed = [n for n, kind in facts.dtypes if "map<" not in kind and "variant" not in kind]
    part = F.when(F.col("__level") > 0, F.pmod(F.xxhash64(*hashed), F.lit(PARTS)).cast("int")).otherwise(0)
    dealt = dealt.withColumns({"__bucket": bucket(seconds[at], F.col("__level")), "__part": part})
    key = ["__level", "__bucket", "__part"]

    def together(rows: DataFrame, by: str, most: int, columns: Sequence[str], out: str, *bounds: Column) -> DataFrame:
        # By key also where spans are few: few small files of facts may have very many pairs.
        rows = rows.repartition(partitions(facts), *key).sortWithinPartitions(*key, by)
        rows = rows.withColumn("__run", F.floor(F.monotonically_increasing_id() / most))
        return rows.groupBy(*key, "__run").agg(F.collect_list(F.struct(*columns)).alias(out), *bounds).drop("__run")

    def inside(span: Column, first: Column, last: Column) -> Column:
        return (last >= span[start]) & (span[end].isNull() | (first <= span[end]))

    first, last = F.min(at).alias("__first"), F.max(at).alias("__last")
    begins, ends, open_end = F.min(start).alias("__begins"), F.max(end).alias("__ends"), F.max(F.isnull(end)).alias("__open")
    dealt = together(dealt, at, FACTS, facts.columns, "__facts", first, last)
    met = together(met, start, SPANS, spans.columns, "__spans", begins, ends, open_end)
    first, last = F.col("__first"), F.col("__last")
    near = (last >= F.col("__begins")) & (F.col("__open") | (first <= F.col("__ends")))
    # Functions over arrays are not compiled into the loop of the join, so its rows come out one by one
    # and don't pile up for all spans of a bucket.
    pairs = dealt.join(met, key).where(near & F.exists("__spans", lambda span: inside(span, first, last)))
    touched = F.filter("__spans", lambda span: inside(span, first, last))
    pairs = pairs.select("__facts", F.explode(touched).alias("__span")).select("__span", F.explode("__facts").alias("__fact"))
    time = F.col("__fact")[at]
    return pairs.where(inside(F.col("__span"), time, time)).select("__fact.*", "__span.*")


def pace_projection(spent: Column, month: Month, skip: Column) -> Column:
    """Month-end spend at the current daily pace; null where pacing makes no sense."""
    whole = spent * F.lit(month.days)
    return F.when(~skip, F.round(whole.cast("double") / float(month.elapsed)))


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 1) -> DataFrame:
    """Adds 100·value / sum(value) over the whole frame (the total is one row)."""
    total = df.agg(F.sum(value).alias("__total"))
    return (
        df.crossJoin(F.broadcast(total))
        .withColumn(out, percent(F.col(value), F.col("__total"), digits))
        .drop("__total")
    )
