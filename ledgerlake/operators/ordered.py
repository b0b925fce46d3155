"""Ordered operators that never confine one key to one task.

A plain window sends a whole key to a single task, and a window without keys sends
the whole table there. The operators here cut the rows, sorted by keys and order, into
slices at cut points taken from a bounded sample. A row's slice is an expression of its own
columns, so nothing has to be stored for two reads to agree, also when an executor is
lost in between; the sample only decides how even the slices are, never a result. Slices
of a key are combined through their totals: one row per key and slice.

Callers whose groups are bounded by construction (one row per calendar day of a named
series) pass small_groups=True and get the ordinary window plan. Both plans give the same
rows: null keys form a key of their own, and sums have the type Spark gives them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RowFrame = tuple[Column, int, int]
#: Sampled rows for each slice: the only rows of the data that the driver sees.
SAMPLED = 32


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the keys come out once, from the left."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__right_{k}"))
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])


def with_slice(
    df: DataFrame,
    columns: Sequence[str],
    out: str = "__slice",
    sampled_from: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Adds the number of the slice a row falls into, rising with `columns` (nulls first).

    `sampled_from` has the same columns and is cheaper to read, such as the rows behind a count;
    `rows` is the number of its rows, if known.
    The cut points are every SAMPLED-th of the places whose hash lies below a bound, which a
    count of the rows sets: no more than the sample leaves its partition.
    """
    slices = partitions(df)
    place = F.struct(*[F.col(c) for c in columns])
    source = df if sampled_from is None else sampled_from
    wanted = SAMPLED * slices
    rows = source.count() if rows is None else rows
    drawn = source.select(place.alias("place"))
    if rows > 2 * wanted:
        bound = -(1 << 63) + (wanted << 64) // rows
        drawn = drawn.where(F.xxhash64("place") < bound)
    sampled = drawn.distinct().agg(F.sort_array(F.collect_list("place"))).head()[0]
    step = max(1, len(sampled) // slices)
    cuts = sampled[step::step]
    if not cuts:
        return df.withColumn(out, F.lit(0))
    kind = df.select(place.alias("place")).schema["place"].dataType
    points = F.array(
        *[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut, kind.fields)]) for cut in cuts]
    )
    # How many cut points lie at or before the row: a binary search by halving steps.
    steps = [1 << bit for bit in range(len(cuts).bit_length() - 1, -1, -1)]
    found = F.aggregate(
        F.array(*[F.lit(step) for step in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(cuts)) & (F.get(points, at + step - 1) <= place), at + step
        ).otherwise(at),
    )
    return df.withColumn(out, found)


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: Column,
    out: str,
    small_groups: bool = False,
) -> DataFrame:
    """Adds `out`: the sum of `amount` over the rows of the key that sort earlier, else 0.

    `order` must be unique within a key. Rows that have a slice by (keys, order) keep it.
    """
    if small_groups:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(amount).over(w), F.lit(0)))

    has_slice = "__slice" in df.columns
    sliced = (df if has_slice else with_slice(df, [*keys, *order])).withColumn("__amount", amount)
    inside = (
        Window.partitionBy(*keys, "__slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    slices = sliced.groupBy(*keys, "__slice").agg(F.sum("__amount").alias("__slice_sum"))
    # At most one row per key and slice, so this window stays tiny.
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select(
        *keys, "__slice", F.coalesce(F.sum("__slice_sum").over(earlier), F.lit(0)).alias("__start")
    )
    ran = sliced.withColumn("__inside", F.sum("__amount").over(inside))
    kind = ran.schema["__inside"].dataType
    total = F.col("__start") + F.coalesce("__inside", F.lit(0))
    return (
        join_on(ran, starts, [*keys, "__slice"])
        .withColumn(out, F.coalesce(total.cast(kind), F.lit(0).cast(kind)))
        .drop("__amount", "__inside", "__start", *([] if has_slice else ["__slice"]))
    )


def previous_row(df: DataFrame, keys: Sequence[str], order: str, columns: Mapping[str, str]) -> DataFrame:
    """Adds each column's value in the row of the key before this one: columns = {new: old}.

    `df` has slices by (keys, order) and keeps them. The first row of a slice takes the last one
    of the slice before, which is one row per key and slice.
    """
    values = F.struct(*[F.col(old).alias(new) for new, old in columns.items()])
    inside = Window.partitionBy(*keys, "__slice").orderBy(order)
    ends = df.groupBy(*keys, "__slice").agg(F.max_by(values, order).alias("__slice_end"))
    slices = Window.partitionBy(*keys).orderBy("__slice")
    carried = ends.select(*keys, "__slice", F.lag("__slice_end").over(slices).alias("__slice_start"))
    lagged = df.withColumn("__lagged", F.lag(values).over(inside))
    before = F.coalesce("__lagged", "__slice_start")
    return (
        join_on(lagged, carried, [*keys, "__slice"])
        .withColumns({new: before[new] for new in columns})
        .drop("__lagged", "__slice_start")
    )


def centred_minima(
    df: DataFrame, keys: Sequence[str], order: str, value: str, half: int, chunk_rows: int = 1 << 18
) -> DataFrame:
    """Rows with `half` rows of their key on either side, and `__low`, the least value of these.

    `df` has slices by (keys, order) and keeps them. Rows are cut into blocks as long as the
    window: a window meets two of them, and its minimum is the lesser of the minimum from its
    first row to the end of that block and of that from the start of the next block to its last
    row. Both are running minima, so a row costs the same however wide the window is. Chunks of
    whole blocks are spread over tasks, with `half` rows more at their ends.
    """
    width = 2 * half + 1
    size = width * max(4, chunk_rows // width)
    numbered = running_before(df, keys, [order], F.lit(1).cast("bigint"), "__row")
    copies = F.sequence(
        F.floor(F.greatest(F.col("__row") - half, F.lit(0)) / size), F.floor((F.col("__row") + half) / size)
    )
    spread = numbered.withColumn("__block", F.floor(F.col("__row") / width)).withColumn("__chunk", F.explode(copies))
    block = Window.partitionBy(*keys, "__chunk", "__block")
    chunk = Window.partitionBy(*keys, "__chunk").orderBy("__block", "__row")
    return (
        spread.withColumn("__to_end", F.min(value).over(block.orderBy(F.desc("__row")).rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("__from_start", F.min(value).over(block.orderBy("__row").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumns(
            {
                "__low": F.least(F.lag("__to_end", half).over(chunk), F.lead("__from_start", half).over(chunk)),
                "__first": F.lag("__row", half).over(chunk),
                "__last": F.lead("__row", half).over(chunk),
            }
        )
        .where(F.col("__chunk") == F.floor(F.col("__row") / size))
        .where(F.col("__first").isNotNull() & F.col("__last").isNotNull())
        .drop("__row", "__block", "__chunk", "__to_end", "__from_start", "__first", "__last")
    )


def rows_frame(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    frames: dict[str, RowFrame],
    small_groups: bool = False,
    chunk_rows: int = 1 << 18,
) -> DataFrame:
    """Aggregates over ROWS frames: frames = {name: (aggregate, first_row, last_row)}.

    first_row / last_row are offsets from the current row; both -k gives lag(k). Beyond
    small groups, each key is cut into chunks of consecutive rows that also receive the
    neighbouring rows their frames reach, so every frame is whole inside its chunk.
    """
    if small_groups:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns(
            {name: agg.over(w.rowsBetween(lo, hi)) for name, (agg, lo, hi) in frames.items()}
        )
    reach = max(max(abs(lo), abs(hi)) for _, lo, hi in frames.values())
    size = max(chunk_rows, 4 * reach)
    numbered = running_before(df, keys, order, F.lit(1).cast("bigint"), "__row")
    own = F.floor(F.col("__row") / size)
    copies = F.sequence(
        F.floor(F.greatest(F.col("__row") - reach, F.lit(0)) / size),
        F.floor((F.col("__row") + reach) / size),
    )
    spread = numbered.withColumn("__own", own).withColumn("__chunk", F.explode(copies))
    w = Window.partitionBy(*keys, "__chunk").orderBy("__row")
    return (
        spread.withColumns(
            {name: agg.over(w.rowsBetween(lo, hi)) for name, (agg, lo, hi) in frames.items()}
        )
        .where(F.col("__chunk") == F.col("__own"))
        .drop("__row", "__own", "__chunk")
    )
