"""Portfolio gold tables: allocation, positions, bands, coverage, rule checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed_values as fixed
from ledgerlake.context import Lake, literal_rows, model
from ledgerlake.functions.columns import in_band, percent, ratio, round_money, round_to
from ledgerlake.operators.periods import share_of_total
from ledgerlake.operators.rules import Rule, rule_checks


def _active(lake: Lake):
    return F.col("account").startswith(lake.settings.active_prefix)


@model("gold")
def mart_allocation(lake: Lake) -> DataFrame:
    regions = (
        lake.ref("stg_holdings")
        .where(F.col("asset_class") == "equity")
        .groupBy("region")
        .agg(F.sum("market_value").alias("__held"))
    )
    return (
        share_of_total(regions, "__held", "pct")
        .select("region", round_money(F.col("__held")).alias("value"), "pct")
        .orderBy(F.desc("value"))
    )


def _scopes(lake: Lake):
    return {
        "Active": _active(lake),
        "Roth": F.col("account").startswith(lake.settings.roth_prefix),
        "Combined": F.lit(True),
    }


@model("ephemeral")
def int_holding_sums(lake: Lake) -> DataFrame:
    """One row: the active account's total and, per scope, equity held and its US part.

    One conditional aggregate covers the scopes, which overlap, so no row is multiplied.
    """
    value = F.col("market_value")
    equity = (F.col("asset_class") == "equity") & value.isNotNull()
    us = F.col("region") == "US"
    sums = [F.sum(F.when(_active(lake), value)).alias("active_total")]
    for name, member in _scopes(lake).items():
        sums.append(F.sum(F.when(equity & member, value)).alias(f"{name}_all"))
        sums.append(F.sum(F.when(equity & member, F.when(us, value).otherwise(0))).alias(f"{name}_us"))
    return lake.ref("stg_holdings").agg(*sums)


def scope_shares(name: str):
    """Equity of a scope and its US and international shares, from int_holding_sums; null if none is held."""
    held, held_us = F.col(f"{name}_all"), F.col(f"{name}_us")
    any_held = held > 0
    return (
        F.when(any_held, round_money(held)),
        F.when(any_held, percent(held_us, held, 1)),
        F.when(any_held, percent(held - held_us, held, 1)),
    )


def _positions(lake: Lake, *carried: str) -> DataFrame:
    held = (
        lake.ref("stg_holdings")
        .where(_active(lake))
        .select("ticker", "name", "sleeve", "market_value")
    )
    total = lake.ref("int_holding_sums").select(F.col("active_total").alias("__total"), *carried)
    caps = fixed.SLEEVE_CAPS
    cap = F.when(F.col("sleeve") == "conviction", caps["conviction"]).when(
        F.col("sleeve") == "standard", caps["standard"]
    )
    share = ratio(F.col("market_value"), F.col("__total"), 100)
    return held.crossJoin(F.broadcast(total)).select(
        "ticker",
        "name",
        "sleeve",
        round_money(F.col("market_value")).alias("value"),
        round_to(share, 1).alias("pct_of_active"),
        cap.alias("cap_pct"),
        F.coalesce(share > cap, F.lit(False)).alias("over_cap"),
        *carried,
    )


@model("gold")
def mart_positions(lake: Lake) -> DataFrame:
    """Positions of the active account, unordered; the cap test is on the unrounded share."""
    return _positions(lake)


@model("gold")
def mart_portfolio_signals(lake: Lake) -> DataFrame:
    """All headline ratios from one pass over the holdings."""
    value, active = F.col("market_value"), _active(lake)
    equity = F.col("asset_class") == "equity"

    def held(condition):
        return F.sum(F.when(condition, value))

    def held_or_zero(condition):
        return F.coalesce(held(condition), F.lit(0).cast("decimal(18,3)"))

    sums = lake.ref("stg_holdings").agg(
        F.sum(value).alias("total"),
        held(equity).alias("equity"),
        held(active).alias("active"),
        held(equity & (F.col("region") == "US")).alias("us"),
        held(equity & (F.col("region") == "Intl")).alias("intl"),
        held_or_zero(F.col("asset_class") == "bond").alias("bond"),
        held_or_zero(active & (F.col("ticker") == lake.settings.defensive_ticker)).alias("defensive"),
        held_or_zero(active & (F.col("sleeve") == "dry_powder")).alias("powder"),
        F.count_if(active & (F.col("sleeve") == "standard")).alias("standard_positions"),
    )
    c = F.col
    return sums.select(
        percent(c("us"), c("equity"), 1).alias("us_equity_pct"),
        percent(c("intl"), c("equity"), 1).alias("intl_equity_pct"),
        percent(c("bond"), c("total"), 1).alias("bond_pct"),
        percent(c("defensive"), c("active"), 1).alias("vymi_pct_active"),
        percent(c("powder"), c("active"), 1).alias("dry_powder_pct"),
        "standard_positions",
    )


@model("gold")
def mart_evidence_bands(lake: Lake) -> DataFrame:
    """US / international equity split per scope; the scopes overlap."""
    rows = []
    for i, name in enumerate(_scopes(lake), start=1):
        value, us_share, intl_share = scope_shares(name)
        rows.append(
            F.struct(
                F.lit(name).alias("scope"),
                F.lit(i).alias("scope_order"),
                value.alias("equity_value"),
                us_share.alias("us_pct"),
                intl_share.alias("intl_pct"),
                F.col(f"{name}_all").alias("held"),
            )
        )
    (low, high), (zone_low, zone_high) = fixed.US_BAND, fixed.EVIDENCE_ZONE
    us_pct = F.col("us_pct")
    return (
        lake.ref("int_holding_sums")
        .select(F.inline(F.array(*rows)))
        .where(F.col("held") > 0)
        .drop("held")
        .withColumns(
            {
                "band_min": F.lit(low),
                "band_max": F.lit(high),
                "evidence_min": F.lit(zone_low),
                "evidence_max": F.lit(zone_high),
                "in_alto_band": in_band(us_pct, low, high),
                "in_evidence_zone": in_band(us_pct, zone_low, zone_high),
                "pct_over_ceiling": round_to(us_pct - high, 1),
            }
        )
        .orderBy("scope_order")
    )


@model("gold")
def mart_all_weather(lake: Lake) -> DataFrame:
    """Four boxes, always: a box nothing covers stays as `none`.

    Holdings are summed per (asset class, ticker) before meeting the boxes, so what is
    listed per box is the distinct tickers, not the positions.
    """
    spark = lake.spark
    boxes = literal_rows(
        spark,
        ["box", "box_order", "box_label", "growth", "inflation", "wins"],
        fixed.WEATHER_BOXES,
    )
    members = literal_rows(spark, ["box", "asset_class"], fixed.BOX_MEMBERS)
    tickers = (
        lake.ref("stg_holdings")
        .groupBy("asset_class", "ticker")
        .agg(F.sum("market_value").alias("held"))
    )
    total = tickers.agg(F.sum("held").alias("total"))
    cover = (
        tickers.join(F.broadcast(members), "asset_class")  # five fixed rows
        .groupBy("box")
        .agg(
            F.sum("held").alias("covered"),
            F.array_join(F.sort_array(F.collect_set("ticker")), ", ").alias("listed"),
            F.countDistinct("ticker").alias("n"),
        )
    )
    covered = F.coalesce("covered", F.lit(0).cast("decimal(18,3)"))
    by_design = F.col("box") == fixed.UNCOVERED_BY_DESIGN
    share = ratio(covered, F.col("total"), 100)
    return (
        boxes.join(cover, "box", "left")
        .crossJoin(F.broadcast(total))
        .select(
            "box",
            "box_order",
            "box_label",
            "growth",
            "inflation",
            "wins",
            F.nullif("listed", F.lit("")).alias("covering_tickers"),
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n_assets"),
            round_money(covered).alias("covering_value"),
            round_to(share, 1).alias("covering_pct"),
            F.when(F.col("total").isNull(), "unknown")
            .when(covered == 0, "none")
            .when(share < fixed.THIN_COVERAGE_PCT, "thin")
            .otherwise("covered")
            .alias("coverage"),
            by_design.alias("by_design"),
            F.when(by_design, fixed.BY_DESIGN_REASON).alias("by_design_reason"),
        )
        .orderBy("box_order")
    )


@model("gold")
def mart_portfolio_actions(lake: Lake) -> DataFrame:
    c = F.col

    def sleeve(name: str):
        # One-decimal shares summed in decimal: the order of adding cannot show.
        tenths = c("pct_of_active").cast("decimal(9,1)")
        return F.sum(F.when(c("sleeve") == name, tenths).otherwise(0)).cast("double")

    # The sums come along with each position: holdings are read for them and for the positions.
    # Without a position of the active account they are null, as nothing is held there.
    _, us_share, intl_share = scope_shares("Active")
    positions = _positions(lake, "Active_all", "Active_us").agg(
        F.max("Active_all").alias("Active_all"),
        F.max("Active_us").alias("Active_us"),
        F.sum(F.when(c("sleeve") == "standard", 1).otherwise(0)).alias("n_standard"),
        F.sum(F.when(c("over_cap"), 1).otherwise(0)).alias("n_over_cap"),
        sleeve("defensive").alias("defensive_pct"),
        sleeve("inflation_hedge").alias("hedge_pct"),
        sleeve("dry_powder").alias("powder_pct"),
        F.sum("value").alias("active_total"),
    ).withColumns({"us_pct": us_share, "intl_pct": intl_share})
    burn = lake.ref("mart_safe_to_spend").select(c("avg_monthly_spend").alias("burn"))
    metrics = lake.ref("int_account_sums")
    for one_row in (positions, burn):
        metrics = metrics.crossJoin(F.broadcast(one_row))

    buffer = c("burn") * fixed.BUFFER_MONTHS
    low, high = fixed.DEFENSIVE_BAND
    tests = {
        "hsa": (c("hsa_cash"), F.lit(fixed.HSA_CASH_FLOOR),
                (c("hsa_cash") >= fixed.HSA_CASH_FLOOR) & (c("hsa_invested") == 0)),
        "buffer": (c("liquid"), round_to(buffer), c("liquid") < buffer),
        "us_ceiling": (c("us_pct"), F.lit(fixed.US_BAND[1]), c("us_pct") > fixed.US_BAND[1]),
        "intl_floor": (c("intl_pct"), F.lit(fixed.INTL_FLOOR_PCT), c("intl_pct") < fixed.INTL_FLOOR_PCT),
        "standard_count": (c("n_standard"), F.lit(float(fixed.MAX_STANDARD_POSITIONS)),
                           (c("active_total") < fixed.SMALL_ACCOUNT)
                           & (c("n_standard") > fixed.MAX_STANDARD_POSITIONS)),
        "over_cap": (c("n_over_cap"), F.lit(0.0), c("n_over_cap") > 0),
        "defensive": (c("defensive_pct"), F.lit((low + high) / 2),
                      ~F.coalesce(c("defensive_pct").between(low, high), F.lit(False))),
        "hedge": (c("hedge_pct"), F.lit(float(fixed.HEDGE_CEILING_PCT)),
                  ~F.coalesce(c("hedge_pct") <= fixed.HEDGE_CEILING_PCT, F.lit(False))),
        "powder": (c("powder_pct"), F.lit(float(fixed.POWDER_CEILING_PCT)),
                   ~F.coalesce(c("powder_pct") <= fixed.POWDER_CEILING_PCT, F.lit(False))),
    }
    texts = literal_rows(
        lake.spark,
        ["key", "severity", "area", "title", "detail", "unit"],
        [(key, *row) for key, row in fixed.PORTFOLIO_RULES.items()],
    )
    checks = rule_checks(metrics, [Rule(key, *test) for key, test in tests.items()], texts)
    # Without an active account there is no geography to judge.
    return checks.where((c("area") != "Geography") | c("current_value").isNotNull())

