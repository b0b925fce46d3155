"""Gold tables on the long-history panels: valuation, credit, property cycle.

A panel entity has one value per series and period, so an entity's rows are bounded by
the calendar; entities are what grows, and they are what the plans partition by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake import fixed_values as fixed
from ledgerlake.context import Lake, literal_rows, model
from ledgerlake.functions.columns import (
    bin_label,
    history_level,
    percent,
    ratio,
    round_to,
)
from ledgerlake.operators.timeseries import (
    intervals,
    local_minima,
    pivot_series,
    rank_quantiles,
    value_percentiles,
)
from ledgerlake.plans.macro import mean_of, observations
from ledgerlake.session import cut_lineage


def _cape(lake: Lake) -> DataFrame:
    return (
        lake.ref("stg_lh_shiller")
        .where((F.col("series") == "cape") & F.col("value").isNotNull())
        .select("series", "year", F.col("period").alias("month"), F.col("value").alias("cape"))
    )


@model("ephemeral")
def int_newest_cape(lake: Lake) -> DataFrame:
    """One row: the newest value as the valuation shows it, and year and month (as one number) of the newest row."""
    when = F.col("year") * 100 + F.col("period")
    return (
        lake.ref("stg_lh_shiller")
        .where(F.col("series") == "cape")
        .agg(
            round_to(F.max_by("value", F.when(F.col("value").isNotNull(), when)), 1).alias("cape"),
            F.max(when).alias("ym"),
        )
    )


@model("gold")
def mart_valuation(lake: Lake) -> DataFrame:
    hist = _cape(lake)
    when = F.col("year") * 100 + F.col("month")
    summary = hist.groupBy("series").agg(
        F.max_by("cape", when).alias("now"),
        F.max(when).alias("__when"),
        F.min("year").alias("since_year"),
        round_to(mean_of("cape"), 1).alias("mean_cape"),
        round_to(F.max("cape"), 1).alias("max_cape"),
    )
    ranks = value_percentiles(hist, ["series"], "cape", small_groups=True)
    here, pctile = F.col("cape") == F.col("now"), F.col("pctile")
    placed = (
        ranks.join(summary, "series")
        .groupBy(*summary.columns)
        .agg(
            F.max(F.when(here, pctile)).alias("pctile"),
            F.min(F.when(pctile >= 0.50, F.col("cape"))).alias("median"),
            F.max("n_obs").alias("n_obs"),
        )
    )
    return placed.select(
        round_to(F.col("now"), 1).alias("cape"),
        round_to(pctile * 100.0).alias("percentile"),
        F.floor(F.col("__when") / 100).cast("int").alias("as_of_year"),
        (F.col("__when") % 100).cast("int").alias("as_of_month"),
        "n_obs",
        "since_year",
        "mean_cape",
        round_to(F.col("median"), 1).alias("median_cape"),
        "max_cape",
        history_level(pctile, "cheap").alias("level"),
    )


@model("gold")
def mart_valuation_reference(lake: Lake) -> DataFrame:
    points = literal_rows(
        lake.spark, ["label", "ord", "year", "month"], lake.settings.valuation_points
    )
    return (
        _cape(lake)
        .join(F.broadcast(points), ["year", "month"])  # a handful of named months
        .select("ord", "label", "year", round_to(F.col("cape"), 1).alias("cape"))
        .orderBy("ord")
    )


@model("gold")
def mart_credit_cycle(lake: Lake) -> DataFrame:
    """Newest credit reading per entity, its 5-row change and its own percentile."""
    panel = pivot_series(
        lake.ref("stg_lh_jst"),
        ["entity", "year"],
        "series",
        "value",
        {"loans": "total_loans", "gdp": "nominal_gdp", "pub": "public_debt_to_gdp"},
    ).where(F.col("loans").isNotNull() & (F.col("gdp") > 0))
    credit = panel.select(
        "entity",
        "year",
        ratio(F.col("loans"), F.col("gdp"), 100).alias("now"),
        (F.col("pub") * 100).alias("public"),
    )
    # The pivot leaves one row per entity and year, so these windows are bounded by the
    # calendar, and one pass gives rank, lag and newest row together.
    entity = Window.partitionBy("entity")
    placed = credit.select(
        "*",
        F.percent_rank().over(entity.orderBy("now")).alias("pctile"),
        F.lag("now", 5).over(entity.orderBy("year")).alias("before"),
        F.count(F.lit(1)).over(entity).alias("n_obs"),
        F.min("year").over(entity).alias("since_year"),
        F.max("year").over(entity).alias("until_year"),
    ).where(F.col("year") == F.col("until_year"))
    change, pctile = F.col("now") - F.col("before"), F.col("pctile")
    step = fixed.CREDIT_TREND_STEP
    return placed.select(
        "entity",
        F.col("year").alias("as_of_year"),
        round_to(F.col("now"), 1).alias("credit_to_gdp"),
        round_to(change, 1).alias("credit_change_5y"),
        round_to(pctile * 100.0).alias("credit_percentile"),
        round_to(F.col("public"), 1).alias("public_debt_to_gdp"),
        "n_obs",
        "since_year",
        "until_year",
        history_level(pctile, "low").alias("level"),
        F.when(change.isNull(), "unknown")
        .when(change >= step, "boom")
        .when(change <= -step, "deleveraging")
        .otherwise("stable")
        .alias("credit_trend"),
    ).orderBy("entity")


@model("gold")
def mart_property_cycle_intervals(lake: Lake) -> DataFrame:
    """Trough-to-trough intervals in real house prices, per entity."""
    panel = pivot_series(
        lake.ref("stg_lh_jst"),
        ["entity", "year"],
        "series",
        "value",
        {"nominal": "house_prices_nominal", "cpi": "cpi"},
    ).where(F.col("nominal").isNotNull() & (F.col("cpi") > 0))
    real = panel.select("entity", "year", ratio(F.col("nominal"), F.col("cpi")).alias("real_price"))
    troughs = local_minima(
        real,
        ["entity"],
        "year",
        "real_price",
        lake.settings.intervals_half,
        lake.settings.intervals_gap,
        small_groups=True,
    ).select("entity", F.col("year").alias("trough_year"))
    return intervals(
        troughs, ["entity"], "trough_year", "prev_trough_year", "interval_years", small_groups=True
    ).orderBy("entity", "trough_year")


def _cycle_position(lake: Lake) -> DataFrame:
    """One row: newest and prior trough, peak since; no row while no trough exists."""
    real = (
        pivot_series(
            observations(lake, "house_prices", "cpi"),
            ["obs_date"],
            "series",
            "value",
            {"nominal": "house_prices", "cpi": "cpi"},
        )
        .where(F.col("nominal").isNotNull() & (F.col("cpi") > 0))
        .select(
            "obs_date",
            "nominal",
            ratio(F.col("nominal"), F.col("cpi")).alias("real_price"),
        )
    )
    # The pivot leaves one row per calendar day of one series: small enough for one task, and
    # to be kept for its second reading below.
    real = cut_lineage(real)
    troughs = local_minima(
        real, [], "obs_date", "real_price", lake.settings.trough_half, small_groups=True
    )
    two = troughs.orderBy(F.desc("obs_date")).limit(2)
    anchor = two.agg(
        F.max("obs_date").alias("trough_date"),
        F.max_by("nominal", "obs_date").alias("trough_value"),
        F.when(F.count(F.lit(1)) == 2, F.min("obs_date")).alias("prior_trough_date"),
    ).where(F.col("trough_date").isNotNull())
    since = F.when(F.col("obs_date") >= F.col("trough_date"), F.col("nominal"))
    return (
        real.crossJoin(F.broadcast(anchor))  # at most one row
        .groupBy("trough_date", "trough_value", "prior_trough_date")
        .agg(
            F.max("obs_date").alias("last_date"),
            F.min("obs_date").alias("first_date"),
            F.max(since).alias("peak"),
        )
    )


@model("gold")
def mart_property_cycle(lake: Lake) -> DataFrame:
    def years(start: str, end: str):
        return round_to(F.datediff(end, start) / fixed.DAYS_PER_YEAR, 1)

    position = _cycle_position(lake).select(
        "trough_date",
        "prior_trough_date",
        "last_date",
        "first_date",
        years("trough_date", "last_date").alias("years_since_trough"),
        percent(F.col("peak") - F.col("trough_value"), F.col("trough_value"), 1).alias("pct_off_trough"),
        years("prior_trough_date", "trough_date").alias("last_us_interval_years"),
    )
    lake.settle("mart_property_cycle_intervals")  # read twice below: entities × cycles
    measured = (
        lake.ref("mart_property_cycle_intervals")
        .where(F.col("interval_years").isNotNull())
        .select("entity", F.col("interval_years").alias("v"))
    )
    v, focus = F.col("v"), F.col("entity") == lake.settings.focus_entity
    here = F.when(focus, v)
    dist = measured.agg(
        F.count(v).alias("n_intervals"),
        round_to(F.avg(v), 1).alias("measured_mean"),
        round_to(F.stddev(v), 1).alias("measured_sd"),
        F.min(v).alias("measured_min"),
        F.max(v).alias("measured_max"),
        percent(F.count_if(v.between(16, 20)), F.count(v), 0).alias("pct_within_16_20"),
        F.countDistinct("entity").alias("n_countries"),
        F.count(here).alias("usa_n_intervals"),
        round_to(F.avg(here), 1).alias("usa_mean"),
        F.min(here).alias("usa_min"),
        F.max(here).alias("usa_max"),
    )
    shares = {"measured_median": 0.50, "measured_p25": 0.25, "measured_p75": 0.75}
    # Ranked at distinct-interval grain: as many rows as there are lengths in years.
    quantiles = rank_quantiles(measured, [], "v", shares, small_groups=True)
    elapsed = F.col("years_since_trough")

    def next_low(share: str):
        return (F.year("trough_date") + F.col(share)).cast("int")

    return (
        position.crossJoin(F.broadcast(dist))
        .crossJoin(F.broadcast(quantiles))
        .select(
            "trough_date", "prior_trough_date", "last_date", "first_date", "years_since_trough",
            "pct_off_trough", "last_us_interval_years", "n_intervals", "measured_mean",
            "measured_sd", "measured_min", "measured_max", "measured_median", "measured_p25",
            "measured_p75", "pct_within_16_20", "n_countries", "usa_n_intervals", "usa_mean",
            "usa_min", "usa_max",
            F.lit(fixed.CYCLE_YEARS).alias("model_cycle_years"),
            percent(elapsed, F.lit(fixed.CYCLE_YEARS), 1).alias("cycle_pct_complete"),
            bin_label(elapsed, fixed.PHASE_BINS, fixed.PAST_HORIZON, missing="unknown").alias("phase"),
            next_low("measured_p25").alias("next_low_earliest"),
            next_low("measured_p75").alias("next_low_latest"),
        )
    )
