"""Operators on long (series, date, value) data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import change_percent, direction, round_to
from ledgerlake.operators.ordered import (
    centred_minima,
    join_on,
    partitions,
    previous_row,
    rows_frame,
    running_before,
    with_slice,
)
from ledgerlake.session import cut_lineage


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = 1) -> DataFrame:
    """Newest `rows` rows per key, whole rows kept; `order` columns all sort descending.

    The rank filter becomes a per-partition limit before the shuffle, so at most `rows`
    rows of a key leave each partition however hot the key is.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= rows).drop("__rank")


def shift_back(date: Column, step: tuple[str, int]) -> Column:
    unit, n = step
    return F.date_sub(date, n) if unit == "days" else F.add_months(date, -n)


def asof_lookback(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    value: str,
    offsets: Mapping[str, tuple[str, int]],
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per key: latest value and date, and the last value at or before latest − offset.

    offsets = {"prior": ("days", 90), "year_ago": ("months", 12)}; all offsets are taken
    in one scan. A key with nothing that old gets null; of several values on one day the
    largest counts. totals are additive aggregates over all rows of the key.

    Rows are reduced to one per key and calendar day on the map side first, so what is
    gathered per key afterwards is bounded by the calendar, however hot the key.
    """
    kind = df.schema[date].dataType.typeName()
    if kind != "date":
        raise TypeError(f"{date} is a {kind}; only dates bound what is gathered for a key")
    added = totals or {}
    daily = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, date)
        .agg(F.max(value).alias(value), *[agg.alias(name) for name, agg in added.items()])
    )
    last = F.max(date).over(Window.partitionBy(*keys))
    picks = [F.max_by(value, date).alias("latest_value"), F.max(date).alias("latest_date")]
    for name, step in offsets.items():
        eligible = F.when(F.col(date) <= shift_back(F.col("__last"), step), F.col(date))
        picks.append(F.max_by(value, eligible).alias(name))
    picks += [F.sum(name).alias(name) for name in added]
    return daily.withColumn("__last", last).groupBy(*keys).agg(*picks)


def change_metrics(df: DataFrame, now: str, before: str, digits: int = 2) -> DataFrame:
    """Adds change, change_pct and direction."""
    n, b = F.col(now), F.col(before)
    return df.withColumns(
        {
            "change": round_to(n - b, digits),
            "change_pct": change_percent(n, b),
            "direction": direction(n, b),
        }
    )


def percentile_of(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    at: DataFrame,
    at_value: str,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Where one value per key sits in that key's history.

    `at` holds one row per key; whether it is broadcast is left to its size, without keys it
    is a single row. For every value of a key use value_percentiles. Adds pctile =
    (rows below) / (rows − 1), n_obs and any extra aggregates of the same pass. One
    partially aggregated count; no ranking of the history.
    """
    below = F.count_if(F.col(value) < F.col("__at"))
    carried = [name for name in at.columns if name not in keys]
    probe = at.select(
        *keys, F.col(at_value).alias("__at"), F.struct(*carried).alias("__carried")
    )
    joined = join_on(df, probe, keys) if keys else df.crossJoin(probe)
    counts = joined.groupBy(*keys).agg(
        below.alias("__below"),
        F.count(value).alias("n_obs"),
        F.any_value("__carried").alias("__carried"),
        *[agg.alias(name) for name, agg in (extra or {}).items()],
    )
    return counts.select(
        *keys,
        "__carried.*",
        "n_obs",
        rank_share(F.col("__below"), F.col("n_obs")).alias("pctile"),
        *(extra or {}),
    )


def rank_share(below: Column, total: Column) -> Column:
    """percent_rank from a count of smaller rows; a lone row ranks 0."""
    return F.when(total > 1, below.cast("double") / (total - 1).cast("double")).otherwise(F.lit(0.0))


def value_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, small_groups: bool = False
) -> DataFrame:
    """percent_rank per key at distinct-value grain: keys, value, n, n_obs, pctile.

    Equal values are counted map-side first, so a value held by a third of the rows
    leaves each partition as one row.
    """
    rows = df.where(F.col(value).isNotNull())
    return _ranked(rows, _counted(rows, keys, value), keys, value, small_groups)


def _counted(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def _ranked(
    rows: DataFrame, hist: DataFrame, keys: Sequence[str], value: str, small_groups: bool, total: int | None = None
) -> DataFrame:
    sliced = hist if small_groups else with_slice(hist, [*keys, value], sampled_from=rows, rows=total)
    ranked = running_before(sliced, keys, [value], F.col("n"), "__below", small_groups).drop("__slice")
    totals = hist.groupBy(*keys).agg(F.sum("n").alias("n_obs"))
    joined = join_on(ranked, totals, keys) if keys else ranked.crossJoin(F.broadcast(totals))
    return joined.withColumn("pctile", rank_share(F.col("__below"), F.col("n_obs"))).drop("__below")


#: A value is hot if more rows hold it than this part of what a partition gets on average.
HOT_PART = 4


def with_percentile(
    df: DataFrame, keys: Sequence[str], value: str, small_groups: bool = False
) -> DataFrame:
    """Every row with a value, with its percent_rank in its key's history.

    The counts of the values tell the hot ones: held by more than 1 / (HOT_PART * partitions) of
    all rows, so there are fewer than HOT_PART * partitions of them. Their ranks go to the rows
    where these are, by a broadcast of that proven size; only rows of other values are shuffled to
    their ranks, and no task gets more of one value than a part of its fair share. Without
    a hot value there is one join. The rows are the same either way.
    """
    rows = df.where(F.col(value).isNotNull())
    place = [*keys, value]
    hist = _counted(rows, keys, value)
    if small_groups:
        ranks = _ranked(rows, hist, keys, value, True).select(*place, "pctile", "n_obs")
        return join_on(rows, ranks, place)
    most, total = hist.agg(F.max("n"), F.sum("n")).head()
    least = (total or 0) // (HOT_PART * partitions(df))
    ranks = _ranked(rows, hist, keys, value, False, total or 0)
    if not total or most <= least:
        return join_on(rows, ranks.select(*place, "pctile", "n_obs"), place)
    is_hot = F.col("n") > least
    hot = F.broadcast(ranks.where(is_hot).select(*place, "pctile", "n_obs"))
    known = F.broadcast(hist.where(is_hot).select(*place))
    cold = join_on(rows, known, place, "left_anti")
    others = ranks.where(~is_hot).select(*place, "pctile", "n_obs")
    return join_on(rows, hot, place).unionByName(join_on(cold, others, place))


#: Buckets of a pass of the selection, values left that are counted one by one, passes at most.
BUCKETS, FEW, PASSES = 4096, 10_000, 6


def rank_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    small_groups: bool = False,
) -> DataFrame:
    """Smallest value whose percent_rank reaches each share (discrete, upper).

    Numbers are selected, not sorted: the value of the rank a share asks for is narrowed down by
    counting the values between two bounds in equal buckets, each with its own least and greatest
    value, which are the next bounds. A pass is one aggregate that shuffles at most a row per
    bucket and partition. When few values are left they are counted one by one; so are those
    that PASSES passes could not part, in slices. The bounds of hot keys go to the rows by a
    broadcast, as in with_percentile, so no key with a large part of the rows meets in one task.
    """
    numeric = isinstance(df.schema[value].dataType, (T.NumericType,))
    if small_groups or not numeric:
        ranks = value_percentiles(df, keys, value, small_groups)
        picks = [F.min(F.when(F.col("pctile") >= p, F.col(value))).alias(name) for name, p in shares.items()]
        return ranks.groupBy(*keys).agg(*picks)

    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__v"))
    whole = rows.groupBy(*keys).agg(F.count("__v").alias("__inside"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    kind = whole.schema["__lo"].dataType
    # So many rows have to lie below: the least number whose share of the others reaches p.
    others = F.col("__inside") - 1

    def least_below(p: float) -> Column:
        near = F.ceil(F.lit(p) * others).cast("long")
        reaches = [F.when(n.cast("double") / others.cast("double") >= p, n) for n in (near - 1, near, near + 1)]
        return F.greatest(F.when(others > 0, F.coalesce(*reaches)).otherwise(F.lit(int(p > 0)).cast("long")), F.lit(0))

    targets = [F.struct(F.lit(k).alias("__target"), (least_below(p) - 1).alias("__rank")) for k, p in enumerate(shares.values())]
    state = cut_lineage(whole.select("*", F.inline(F.array(*targets))).withColumn("__above", F.lit(None).cast(kind)))
    total = state.where(F.col("__target") == 0).agg(F.sum("__inside")).head()[0] or 0
    state = state.withColumn("__hot", F.col("__inside") > total // (HOT_PART * partitions(df)))
    is_open = (F.col("__lo") < F.col("__hi")) & (F.col("__rank") >= 0)
    left = FEW + 1
    for made in range(PASSES + 1):
        left, all_hot = state.where(is_open).agg(F.max("__inside"), F.min("__hot")).head()
        if (left or 0) <= FEW or made == PASSES:
            break
        narrowed = _narrowed(rows, state.where(is_open), keys, all_hot)
        state = cut_lineage(state.where(~F.coalesce(is_open, F.lit(False))).unionByName(narrowed))

    marked = [*keys, "__target"]
    counted = _inside(rows, state.where(is_open), keys, all_hot).groupBy(*marked, "__rank", "__v").agg(F.count(F.lit(1)).alias("__n"))
    ran = running_before(counted, marked, ["__v"], F.col("__n"), "__below", small_groups=(left or 0) <= FEW)
    found = ran.groupBy(*marked).agg(F.min(F.when(F.col("__below") > F.col("__rank"), F.col("__v"))).alias("__next"))
    answer = F.when(F.col("__rank") < 0, F.col("__lo")).otherwise(F.coalesce("__next", "__above"))
    answered = join_on(state, found, marked, "left").withColumn("__answer", answer)
    picks = [F.max(F.when(F.col("__target") == k, F.col("__answer"))).alias(name) for k, name in enumerate(shares)]
    return answered.groupBy(*keys).agg(*picks)


def _inside(rows: DataFrame, state: DataFrame, keys: Sequence[str], all_hot: bool | None) -> DataFrame:
    """The values between the bounds of each key and target, with the row of the state.

    Hot keys are fewer than HOT_PART * partitions; only rows of other keys are shuffled to their bounds.
    """
    between = F.col("__v").between(F.col("__lo"), F.col("__hi"))
    if not keys:  # one row per share
        return rows.join(F.broadcast(state), between)
    hot = state.where("__hot")
    found = join_on(rows, F.broadcast(hot), keys).where(between)
    if all_hot is not False:  # null: nothing is open
        return found
    cold = join_on(rows, F.broadcast(hot.select(*keys).distinct()), keys, "left_anti")
    return found.unionByName(join_on(cold, state.where(~F.col("__hot")), keys).where(between))


def _narrowed(rows: DataFrame, state: DataFrame, keys: Sequence[str], all_hot: bool | None) -> DataFrame:
    """The state with the bounds of the bucket that holds the rank, and the rank within it."""
    v, lo, hi = (F.col(c).cast("double") for c in ("__v", "__lo", "__hi"))
    span = hi - lo
    parts = (span > 0) & (span < float("inf"))
    bucket = F.when(parts, F.least(F.floor((v - lo) / span * BUCKETS), F.lit(BUCKETS - 1).cast("long"))).otherwise(F.lit(0))
    marked = [*keys, "__target"]
    counted = (
        _inside(rows, state, keys, all_hot)
        .groupBy(*marked, "__rank", "__above", "__hot", bucket.alias("__bucket"))
        .agg(F.count(F.lit(1)).alias("__inside"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    )
    # At most BUCKETS rows per key and target.
    rising = Window.partitionBy(*marked).orderBy("__bucket")
    return (
        counted.withColumn("__before", F.coalesce(F.sum("__inside").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("__above", F.coalesce(F.lead("__lo").over(rising), F.col("__above")))
        .where((F.col("__before") <= F.col("__rank")) & (F.col("__rank") < F.col("__before") + F.col("__inside")))
        .withColumn("__rank", F.col("__rank") - F.col("__before"))
        .select(*keys, "__inside", "__lo", "__hi", "__target", "__rank", "__above", "__hot")
    )


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, columns: Sequence[str]
) -> DataFrame:
    """Every row of `left` with `columns` of the newest row of `right` at or before it, else nulls.

    Of right rows with the same key and time the one with the greatest `columns`, in their order,
    counts. A null key or time meets nothing. Both sides are put in one order and cut into
    slices; a right row's values are carried on within a slice, and from slice to slice through
    one row per key and slice: no key, and no time of a key, is confined to one task.
    """
    values = F.struct(*[F.col(c) for c in columns])
    known = reduce(and_, [F.col(k).isNotNull() for k in [*keys, right_time]])
    newest = (
        right.where(known)
        .groupBy(*keys, F.col(right_time).alias("__time"))
        .agg(F.max(values).alias("__values"))
        .withColumns({"__side": F.lit(0), "__tie": F.lit(0).cast("long")})
    )
    rows = left.select(
        *keys,
        F.col(left_time).alias("__time"),
        F.lit(1).alias("__side"),
        F.xxhash64(*left.columns).alias("__tie"),
        F.struct(*left.columns).alias("__row"),
    )
    both = rows.unionByName(newest, allowMissingColumns=True)
    order = ["__time", "__side", "__tie"]
    sliced = with_slice(both, [*keys, *order])
    inside = Window.partitionBy(*keys, "__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = sliced.groupBy(*keys, "__slice").agg(
        F.max_by("__values", F.when(F.col("__side") == 0, F.col("__time"))).alias("__slice_end")
    )
    slices = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "__slice", F.last("__slice_end", True).over(slices).alias("__slice_start"))
    met = join_on(sliced.withColumn("__met", F.last("__values", True).over(inside)), carried, [*keys, "__slice"])
    picked = F.coalesce("__met", "__slice_start")
    return met.where("__side = 1").select("__row.*", *[picked[c].alias(c) for c in columns])


def local_minima(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    half: int,
    min_gap: int | None = None,
    small_groups: bool = False,
    keep_slice: bool = False,
) -> DataFrame:
    """Rows that are the minimum of the `half` rows either side, with a full window.

    With min_gap, a hit no further than min_gap after the previous hit is dropped; the
    comparison is to the previous hit, kept or not, so a flat bottom counts once.

    Beyond small groups one slicing serves the minima, the gaps and, with keep_slice, the
    intervals after them; the hits of which gaps are taken are few and settled first.
    """
    if not small_groups:
        sliced = with_slice(df, [*keys, order])
        hits = centred_minima(sliced, keys, order, value, half).where(F.col(value) == F.col("__low")).drop("__low")
        if min_gap is not None:
            chained = previous_row(cut_lineage(hits), keys, order, {"__previous": order})
            gap = F.col(order) - F.col("__previous")
            hits = chained.where(F.col("__previous").isNull() | (gap > min_gap)).drop("__previous")
        return hits if keep_slice else hits.drop("__slice")
    windowed = rows_frame(
        df,
        keys,
        [order],
        {
            "__low": (F.min(value), -half, half),
            "__rows": (F.count(F.lit(1)), -half, half),
        },
        small_groups,
    )
    hits = windowed.where(
        (F.col(value) == F.col("__low")) & (F.col("__rows") == 2 * half + 1)
    ).drop("__low", "__rows")
    if min_gap is None:
        return hits
    chained = with_lag(hits, keys, order, {"__previous": order}, 1, small_groups)
    gap = F.col(order) - F.col("__previous")
    return chained.where(F.col("__previous").isNull() | (gap > min_gap)).drop("__previous")


def with_lag(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Mapping[str, str],
    rows: int = 1,
    small_groups: bool = False,
) -> DataFrame:
    """Adds each column's value `rows` rows earlier within the key."""
    frames = {out: (F.max(src), -rows, -rows) for out, src in columns.items()}
    return rows_frame(df, keys, [order], frames, small_groups)


def intervals(
    troughs: DataFrame, keys: Sequence[str], order: str, previous: str, gap: str, small_groups: bool = False
) -> DataFrame:
    """Adds the previous trough of the key and the distance to it; slices of troughs are used up."""
    if "__slice" in troughs.columns:
        lagged = previous_row(troughs, keys, order, {previous: order}).drop("__slice")
    else:
        lagged = with_lag(troughs, keys, order, {previous: order}, 1, small_groups)
    return lagged.withColumn(gap, F.col(order) - F.col(previous))


def deflate(
    nominal: DataFrame, index: DataFrame, on: Sequence[str], value: str, by: str, out: str
) -> DataFrame:
    """nominal[value] / index[by] where the two meet and the index is positive."""
    positive = index.where(F.col(by) > 0).select(*on, by)
    return nominal.join(positive, list(on)).withColumn(
        out, F.col(value).cast("double") / F.col(by).cast("double")
    )


def pivot_series(
    df: DataFrame, keys: Sequence[str], series: str, value: str, names: Mapping[str, str]
) -> DataFrame:
    """Named series as columns, one row per key: names = {column: series name}."""
    wanted = df.where(F.col(series).isin(*names.values()))
    picks = [F.max(F.when(F.col(series) == s, F.col(value))).alias(c) for c, s in names.items()]
    return wanted.groupBy(*keys).agg(*picks)
