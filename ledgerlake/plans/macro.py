"""Macro gold tables on the observation log (series, date, value).

A named series has at most one value per calendar day, so its history is bounded by the
calendar and not by the size of the lake; ordered work on one series may use a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed_values as fixed
from ledgerlake.context import Lake, literal_rows, model
from ledgerlake.functions.columns import (
    bin_label,
    change_percent,
    direction,
    history_level,
    round_to,
)
from ledgerlake.operators.timeseries import asof_lookback, percentile_of


def observations(lake: Lake, *names: str) -> DataFrame:
    obs = lake.ref("stg_fred").where(F.col("value").isNotNull())
    return obs.where(F.col("series").isin(*names)) if names else obs


@model("gold")
def mart_macro_indicators(lake: Lake) -> DataFrame:
    now, before = F.col("latest_value"), F.col("prior")
    return asof_lookback(
        observations(lake), ["series"], "obs_date", "value", {"prior": ("days", 90)}
    ).select(
        "series",
        round_to(now, 2).alias("latest_value"),
        "latest_date",
        round_to(now - before, 2).alias("change_90d"),
        change_percent(now, before).alias("change_90d_pct"),
        direction(now, before).alias("direction"),
    )


@model("gold")
def mart_macro_history(lake: Lake) -> DataFrame:
    return (
        observations(lake)
        .where(F.col("obs_date") >= lake.days_ago(180))
        .select("series", "obs_date", round_to(F.col("value"), 2).alias("value"))
        .orderBy("series", "obs_date")
    )


@model("gold")
def mart_house_price_history(lake: Lake) -> DataFrame:
    return (
        observations(lake, "house_prices")
        .select("obs_date", round_to(F.col("value"), 1).alias("value"))
        .orderBy("obs_date")
    )


@model("gold")
def mart_macro_regime(lake: Lake) -> DataFrame:
    """Growth × inflation, by level (quadrant) and by direction (aw_box)."""
    points = asof_lookback(
        observations(lake, "industrial_production", "cpi"),
        ["series"],
        "obs_date",
        "value",
        {"m3": ("months", 3), "m12": ("months", 12), "m15": ("months", 15)},
    )
    yoy = points.select(
        "series",
        change_percent(F.col("latest_value"), F.col("m12")).alias("now"),
        change_percent(F.col("m3"), F.col("m15")).alias("then"),
    )

    def pick(series: str, column: str):
        return F.max(F.when(F.col("series") == series, F.col(column)))

    wide = yoy.agg(
        pick("industrial_production", "now").alias("growth_yoy"),
        pick("industrial_production", "then").alias("growth_yoy_3m_ago"),
        pick("cpi", "now").alias("inflation_yoy"),
        pick("cpi", "then").alias("inflation_yoy_3m_ago"),
    )

    def heading(now: str, then: str):
        known = F.col(now).isNotNull() & F.col(then).isNotNull()
        return F.when(~known, "unknown").when(F.col(now) >= F.col(then), "rising").otherwise("falling")

    growth, inflation = F.col("growth_yoy"), F.col("inflation_yoy")
    growing, hot = growth > fixed.GROWTH_FLOOR, inflation > fixed.INFLATION_FLOOR
    g, i = F.col("growth_direction"), F.col("inflation_direction")
    return (
        wide.withColumns(
            {
                "growth_direction": heading("growth_yoy", "growth_yoy_3m_ago"),
                "inflation_direction": heading("inflation_yoy", "inflation_yoy_3m_ago"),
            }
        ).withColumns(
            {
                "quadrant": F.when(growth.isNull() | inflation.isNull(), "Unknown")
                .when(growing & hot, "Reflation / late-cycle")
                .when(growing, "Goldilocks / expansion")
                .when(hot, "Stagflation")
                .otherwise("Deflation / slowdown"),
                "aw_box": F.when((g == "unknown") | (i == "unknown"), "unknown").otherwise(
                    F.concat(g, F.lit("_growth_"), i, F.lit("_inflation"))
                ),
            }
        )
    )


def exact_sum(value: str):
    """Sum in decimal, so partition order cannot change it."""
    return F.sum(F.col(value).cast("decimal(28,9)"))


def mean_of(value: str):
    return exact_sum(value).cast("double") / F.count(value)


@model("gold")
def mart_macro_equilibrium(lake: Lake) -> DataFrame:
    series = ("debt_to_gdp", "capacity_utilization", "fed_funds", "bond_10y", "corp_baa")
    metrics = asof_lookback(
        observations(lake, *series),
        ["series"],
        "obs_date",
        "value",
        {"year_ago": ("months", 12)},
        {"total": exact_sum("value"), "n_obs": F.count("value")},
    ).withColumn("mean_all", F.col("total").cast("double") / F.col("n_obs"))

    def pick(name: str, value):
        return F.max(F.when(F.col("series") == name, value))

    latest = F.col("latest_value")
    wide = metrics.agg(
        pick("debt_to_gdp", round_to(latest, 1)).alias("debt_to_gdp"),
        pick("debt_to_gdp", round_to(latest - F.col("year_ago"), 1)).alias("debt_to_gdp_chg_1y"),
        pick("capacity_utilization", round_to(latest, 1)).alias("capacity_utilization"),
        pick("capacity_utilization", round_to(F.col("mean_all"), 1)).alias("capacity_longrun_avg"),
        pick("capacity_utilization", F.col("n_obs")).alias("capacity_n_obs"),
        pick("fed_funds", round_to(latest, 2)).alias("cash_yield"),
        pick("bond_10y", round_to(latest, 2)).alias("bond_yield"),
        pick("corp_baa", round_to(latest, 2)).alias("credit_yield"),
    )
    cash, bond, credit = F.col("cash_yield"), F.col("bond_yield"), F.col("credit_yield")
    missing = cash.isNull() | bond.isNull() | credit.isNull()
    return wide.withColumns(
        {
            "capacity_gap": round_to(F.col("capacity_utilization") - F.col("capacity_longrun_avg"), 1),
            "bond_over_cash": round_to(bond - cash, 2),
            "credit_over_bond": round_to(credit - bond, 2),
            "stack_shape": F.when(missing, "unknown")
            .when((bond > cash) & (credit > bond), "upward_sloping")
            .otherwise("inverted"),
        }
    )


@model("gold")
def mart_big_cycle(lake: Lake) -> DataFrame:
    """All six stages with the current one flagged on [debt_min, debt_max)."""
    stages = literal_rows(
        lake.spark,
        ["stage_order", "stage_name", "debt_min", "debt_max", "description", "implication"],
        fixed.DEBT_STAGES,
    )
    debt = F.col("debt_to_gdp")
    inside = (debt >= F.col("debt_min")) & (debt < F.col("debt_max"))
    detectable = F.col("stage_order") != fixed.UNDETECTABLE_STAGE
    reading = lake.ref("mart_macro_equilibrium").select("debt_to_gdp", "debt_to_gdp_chg_1y")
    return (
        stages.crossJoin(F.broadcast(reading))
        .select(
            "stage_order", "stage_name", "description", "implication", "debt_min", "debt_max",
            "debt_to_gdp", "debt_to_gdp_chg_1y",
            F.coalesce(detectable & inside, F.lit(False)).alias("is_current"),
            bin_label(debt, fixed.DEBASEMENT_BINS, "high", missing="unknown").alias("debasement_risk"),
        )
        .orderBy("stage_order")
    )


@model("gold")
def mart_debasement_signals(lake: Lake) -> DataFrame:
    criteria = literal_rows(
        lake.spark,
        ["criterion_order", "criterion", "series", "explanation", "unit"],
        fixed.DECLINE_CRITERIA,
    )
    now, before = F.col("latest_value"), F.col("year_ago")
    names = [row[2] for row in fixed.DECLINE_CRITERIA]
    metrics = asof_lookback(
        observations(lake, *names), ["series"], "obs_date", "value", {"year_ago": ("months", 12)}
    ).withColumn("chg_1y_pct", change_percent(now, before, absolute_base=True))
    series, change = F.col("series"), F.col("chg_1y_pct")
    return (
        criteria.join(metrics, "series", "left")
        .select(
            "criterion_order",
            "criterion",
            "explanation",
            round_to(now, 2).alias("latest_value"),
            "latest_date",
            "chg_1y_pct",
            F.when(series == "debt_to_gdp", now > fixed.DECLINE_DEBT)
            .when(series == "real_rate_10y", now < 0.0)
            .when(series.isin("foreign_treasury", "dollar_index"), change < 0.0)
            .alias("points_to_decline"),
            "unit",
        )
        .orderBy("criterion_order")
    )


@model("gold")
def mart_news_climate(lake: Lake) -> DataFrame:
    """Latest reading of each climate series as a percentile of its own full history."""
    labels = literal_rows(
        lake.spark, ["series", "ord", "label", "explanation"], fixed.CLIMATE_LABELS
    )
    obs = observations(lake, *[row[0] for row in fixed.CLIMATE_LABELS])
    newest = obs.groupBy("series").agg(
        F.max_by("value", "obs_date").alias("now"),
        F.max("obs_date").alias("latest_date"),
    )
    placed = percentile_of(
        obs, ["series"], "value", newest, "now", {"since_date": F.min("obs_date")}
    )
    pctile = F.col("pctile")
    return (
        placed.join(F.broadcast(labels), "series")  # five fixed rows
        .select(
            "ord",
            "label",
            "explanation",
            "series",
            round_to(F.col("now"), 2).alias("latest_value"),
            "latest_date",
            round_to(pctile * 100.0).alias("percentile"),
            "n_obs",
            "since_date",
            history_level(pctile, "calm").alias("level"),
        )
        .orderBy("ord")
    )
