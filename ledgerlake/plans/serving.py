"""Read queries of the dashboards: small, named reads on the silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed_values as fixed
from ledgerlake.context import Lake
from ledgerlake.functions.columns import percent, ratio, round_money, round_to
from ledgerlake.operators.history import status_counts

c = F.col


def outreach_kpis(lake: Lake) -> DataFrame:
    leads = lake.ref("stg_leads").agg(F.count(F.lit(1)).alias("leads"))
    touches = lake.ref("fact_touch").agg(
        F.count(F.lit(1)).alias("touches"),
        percent(F.sum("is_open"), F.count(F.lit(1)), 1).alias("open_rate"),
        percent(F.sum("is_reply"), F.count(F.lit(1)), 1).alias("reply_rate"),
    )
    return leads.crossJoin(F.broadcast(touches))


def lead_status_counts(history: DataFrame) -> DataFrame:
    return status_counts(history, "status", 10)


def last_refresh(lake: Lake) -> DataFrame:
    return lake.load_log().agg(F.max("inserted_at").alias("refreshed_at"))


def newest_month_spend(lake: Lake, top: int = 8) -> DataFrame:
    lake.settle("mart_spend_by_category")  # read twice below: months × groups
    spend = lake.ref("mart_spend_by_category")
    newest = spend.agg(F.max("month").alias("month"))
    return (
        spend.join(F.broadcast(newest), "month")  # one row
        .select("category_group", "spend")
        .orderBy(F.desc("spend"), "category_group")
        .limit(top)
    )


def shown_spend_total(lake: Lake, top: int = 8) -> DataFrame:
    return newest_month_spend(lake, top).agg(F.sum("spend").alias("total_spend"))


def top_category_trend(lake: Lake, top: int = 8) -> DataFrame:
    return lake.ref("mart_category_trend").orderBy(F.desc("this_month"), "category_group").limit(top)


def upcoming_bills(lake: Lake, top: int = 6) -> DataFrame:
    return (
        lake.ref("stg_recurring")
        .where(c("due_date") >= lake.today)
        .select("due_date", "merchant", round_money(F.abs("amount")).alias("amount"))
        .orderBy("due_date", "merchant", "amount")
        .limit(top)
    )


def recent_transactions(lake: Lake, top: int = 10) -> DataFrame:
    return (
        lake.ref("stg_transactions")
        .where(~c("hide_from_reports"))
        .select("txn_date", "merchant", "category", round_money(c("amount")).alias("amount"))
        .orderBy(F.desc_nulls_last("txn_date"), "merchant", "category", "amount")
        .limit(top)
    )


def recent_cashflow(lake: Lake, months: int = 8) -> DataFrame:
    return lake.ref("mart_monthly_cashflow").orderBy(F.desc("month")).limit(months)


def interval_histogram(lake: Lake) -> DataFrame:
    """Measured intervals in five unequal buckets."""
    years, (label_over, key_over) = c("interval_years"), fixed.INTERVAL_OVERFLOW
    label = key = None
    for upper, name, sort in fixed.INTERVAL_BUCKETS:
        inside = years <= upper
        label = F.when(inside, name) if label is None else label.when(inside, name)
        key = F.when(inside, sort) if key is None else key.when(inside, sort)
    return (
        lake.ref("mart_property_cycle_intervals")
        .where(years.isNotNull())
        .groupBy(label.otherwise(label_over).alias("bucket"), key.otherwise(key_over).alias("sort_key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("sort_key")
    )


def entity_credit(lake: Lake, entity: str | None = None) -> DataFrame:
    wanted = entity or lake.settings.focus_entity
    return lake.ref("mart_credit_cycle").where(c("entity") == wanted)


def digest_rows(lake: Lake) -> DataFrame:
    return (
        lake.ref("mart_review_digest")
        .orderBy("severity", "ord", "headline")
        .select("severity", "section", "headline", "detail", "value")
    )


def recent_snapshots(snapshots: DataFrame, rows: int = 30) -> DataFrame:
    return snapshots.orderBy(F.desc("snapshot_date")).limit(rows)


def digest_summary(lake: Lake) -> DataFrame:
    return lake.ref("mart_review_digest").agg(
        F.count_if(c("severity") == 1).alias("items_now"),
        F.count(F.lit(1)).alias("items_total"),
    )


# Gold tables the dashboards read as they are: query name -> (table, columns or all).
PASS_THROUGH: dict[str, tuple[str, list[str] | None]] = {
    "indicator_strip": ("mart_macro_indicators", ["series", "latest_value", "change_90d_pct", "direction"]),
    "regime": ("mart_macro_regime", None),
    "spark_lines": ("mart_macro_history", ["series", "obs_date", "value"]),
    "outreach_funnel": (
        "mart_outreach_funnel",
        ["angle", "total_touches", "opens", "replies", "open_rate_pct", "reply_rate_pct"],
    ),
    "networth_line": ("mart_networth", ["snapshot_date", "net_worth"]),
    "freshness": ("mart_data_freshness", None),
    "actions": ("mart_portfolio_actions", None),
    "positions": ("mart_positions", None),
    "allocation": ("mart_allocation", None),
}


def pass_through(lake: Lake, query: str) -> DataFrame:
    table, columns = PASS_THROUGH[query]
    df = lake.ref(table)
    return df.select(*columns) if columns else df


def networth_change(lake: Lake, rows_back: int = 30) -> DataFrame:
    """Newest net worth against the value 30 rows earlier (rows, not days).

    With fewer rows the oldest one is the base; with none, both are zero. Only the
    newest rows reach the comparison: a top-k per partition, then one merge.
    """
    newest = lake.ref("mart_networth").orderBy(F.desc("snapshot_date")).limit(rows_back + 1)
    now = F.coalesce(F.max_by("net_worth", "snapshot_date"), F.lit(0.0))
    before = F.coalesce(F.min_by("net_worth", "snapshot_date"), F.lit(0.0))
    return newest.agg(now.alias("net_worth_now"), before.alias("net_worth_before")).withColumn(
        "net_worth_change", c("net_worth_now") - c("net_worth_before")
    )


def complete_months_savings(lake: Lake) -> DataFrame:
    """Mean savings rate of the second to fourth newest months."""
    rate = F.coalesce("savings_rate_pct", F.lit(0.0))
    four = lake.ref("mart_monthly_cashflow").orderBy(F.desc("month")).limit(4)
    newest_first = F.sort_array(F.collect_list(F.struct("month", rate.alias("rate"))), asc=False)
    complete = F.slice(F.col("newest")["rate"], 2, 3)
    added = F.aggregate(complete, F.lit(0.0), lambda total, x: total + x)
    mean = added / F.nullif(F.size(complete).cast("double"), F.lit(0.0))
    return four.agg(newest_first.alias("newest")).select(
        round_to(F.coalesce(mean, F.lit(0.0))).alias("savings_rate_pct")
    )


def flexible_pace(lake: Lake) -> DataFrame:
    """Daily allowance for the rest of the month and the pace of flexible spend."""
    month = lake.month
    left, budget = c("flexible_left"), c("flexible_target")
    spent = c("flexible_spent_this_month")
    projected = spent / float(month.elapsed) * float(month.days)
    return lake.ref("mart_safe_to_spend").select(
        F.lit(month.days - month.elapsed + 1).alias("days_left"),
        (F.greatest(left, F.lit(0.0)) / float(month.days - month.elapsed + 1)).alias("daily_allowance"),
        projected.alias("projected"),
        (projected - budget).alias("projected_over"),
        F.coalesce(F.least(ratio(spent, budget, 100), F.lit(100.0)), F.lit(0.0)).alias("pct_spent"),
    )


def sleeve_totals(lake: Lake) -> DataFrame:
    return (
        lake.ref("mart_positions")
        .groupBy("sleeve")
        .agg(round_money(F.sum(c("value").cast("decimal(18,0)"))).alias("value"))
        .orderBy("sleeve")
    )


def smallest_standard_position(lake: Lake) -> DataFrame:
    return (
        lake.ref("mart_positions")
        .where(c("sleeve") == "standard")
        .orderBy("pct_of_active", "ticker", "name", "value")
        .limit(1)
        .select("ticker", "name", "value", "pct_of_active")
    )


def decline_count(lake: Lake) -> DataFrame:
    return lake.ref("mart_debasement_signals").agg(
        F.count_if(c("points_to_decline")).alias("signals_pointing_to_decline"),
        F.count(F.lit(1)).alias("signals"),
    )


def shared_hedge(lake: Lake) -> DataFrame:
    """Ticker list when both inflationary boxes rest on the same holdings, else null."""
    box = c("box")

    def listed(name: str):
        return F.max(F.when(box == name, c("covering_tickers")))

    both = lake.ref("mart_all_weather").agg(
        listed("rising_growth_rising_inflation").alias("growth_up"),
        listed("falling_growth_rising_inflation").alias("growth_down"),
    )
    return both.select(F.when(c("growth_up") == c("growth_down"), c("growth_up")).alias("shared_hedge"))


def valuation_ladder(lake: Lake) -> DataFrame:
    now = lake.ref("mart_valuation").select(
        F.lit("Now").alias("label"), "cape", F.lit(True).alias("is_now")
    )
    named = lake.ref("mart_valuation_reference").select("label", "cape", F.lit(False).alias("is_now"))
    return now.unionByName(named).orderBy(F.desc("cape"), "label")


def freshness_summary(lake: Lake) -> DataFrame:
    stale, lagging = F.count_if(c("status") == "stale"), F.count_if(c("status") == "lagging")
    counts = lake.ref("mart_data_freshness").agg(
        F.count(F.lit(1)).alias("sources"), stale.alias("stale"), lagging.alias("lagging")
    )
    behind = c("stale") + c("lagging")
    return counts.select(
        F.when(c("stale") > 0, "stale").when(c("lagging") > 0, "lagging").otherwise("current").alias("worst"),
        behind.alias("sources_behind"),
        "sources",
        F.when(behind == 0, F.concat(F.lit("All "), c("sources").cast("string"), F.lit(" sources current")))
        .otherwise(
            F.concat(
                behind.cast("string"), F.lit(" of "), c("sources").cast("string"),
                F.lit(" sources behind"),
            )
        )
        .alias("summary"),
    )


def regime_box(lake: Lake) -> DataFrame:
    """Coverage boxes with the one the regime is heading to flagged."""
    heading = lake.ref("mart_macro_regime").select("aw_box")
    return (
        lake.ref("mart_all_weather")
        .crossJoin(F.broadcast(heading))
        .select(
            "box",
            "box_order",
            "coverage",
            "covering_pct",
            F.coalesce(c("box") == c("aw_box"), F.lit(False)).alias("is_now"),
        )
        .orderBy("box_order")
    )


SERVING = {
    "outreach_kpis": outreach_kpis,
    "last_refresh": last_refresh,
    "newest_month_spend": newest_month_spend,
    "shown_spend_total": shown_spend_total,
    "top_category_trend": top_category_trend,
    "upcoming_bills": upcoming_bills,
    "recent_transactions": recent_transactions,
    "recent_cashflow": recent_cashflow,
    "interval_histogram": interval_histogram,
    "entity_credit": entity_credit,
    "digest_rows": digest_rows,
    "digest_summary": digest_summary,
    "networth_change": networth_change,
    "complete_months_savings": complete_months_savings,
    "flexible_pace": flexible_pace,
    "sleeve_totals": sleeve_totals,
    "smallest_standard_position": smallest_standard_position,
    "decline_count": decline_count,
    "shared_hedge": shared_hedge,
    "valuation_ladder": valuation_ladder,
    "freshness_summary": freshness_summary,
    "regime_box": regime_box,
    **{f"read_{name}": (lambda lake, q=name: pass_through(lake, q)) for name in PASS_THROUGH},
}
