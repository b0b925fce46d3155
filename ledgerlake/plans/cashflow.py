"""Personal-finance gold tables: cash-flow, budget, balances."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import Lake, literal_rows, model
from ledgerlake.functions.columns import (
    Typed,
    month_of,
    percent,
    ratio,
    round_money,
    round_to,
)
from ledgerlake.operators.periods import effective_dated, in_force, pace_projection


@model("ephemeral")
def int_transactions(lake: Lake) -> DataFrame:
    """Visible, non-transfer transactions with signed spend and income.

    Amounts keep their sign inside each group, so refunds lower spend and reversals
    lower income. No category match counts as neither.
    """
    amount, kind = F.col("amount"), F.col("group_type")
    categories = lake.ref("stg_categories").select("category_id", "category_group", "group_type")
    joined = (
        lake.ref("stg_transactions")
        .where(~F.col("hide_from_reports"))
        .join(categories, "category_id", "left")
        .where(F.coalesce(kind, F.lit("")) != "transfer")
    )
    zero = F.lit(0).cast("decimal(18,3)")
    paycheck = (F.col("category") == lake.settings.paycheck_category) & (amount > 0)
    return joined.select(
        "transaction_id",
        "txn_date",
        "amount",
        F.coalesce(kind, F.lit("uncategorized")).alias("group_type"),
        F.coalesce("category_group", F.lit("Uncategorized")).alias("category_group"),
        "category",
        "merchant",
        "account",
        F.when(kind == "expense", -amount).otherwise(zero).alias("expense_amount"),
        F.when(kind == "income", amount).otherwise(zero).alias("income_amount"),
        F.when(paycheck, amount).otherwise(zero).alias("w2_income"),
    )


def month_parts(lake: Lake, since: date | None = None) -> DataFrame:
    """Visible transactions summed to month, category and sign: one exact sum a row, reduced map-side.

    No table but the transactions goes in, so a month's sums change by its transactions alone.
    """
    txns = lake.ref("stg_transactions").where(~F.col("hide_from_reports"))
    if since:
        txns = txns.where(F.col("txn_date") >= F.lit(since))
    return txns.groupBy(
        month_of(F.col("txn_date")).alias("month"),
        "category_id",
        "category",
        (F.col("amount") < 0).alias("outflow"),
    ).agg(F.sum("amount").alias("total"))


@model("ephemeral")
def int_monthly_parts(lake: Lake) -> DataFrame:
    """Kept up by change where transactions land in loads (`sinks/upkeep.py`), computed elsewhere."""
    return month_parts(lake)


def monthly_totals(lake: Lake, since: date | None = None) -> DataFrame:
    """int_transactions summed to month × category group, for everything monthly.

    Rows are summed per (month, category, sign) before the category join, so only totals reach
    the join.
    """
    if lake.is_settled("int_monthly_parts"):
        totals = lake.ref("int_monthly_parts")
        if since:
            totals = totals.where(F.col("month") >= F.lit(since))
    else:
        totals = month_parts(lake, since)
    paycheck = (F.col("category") == lake.settings.paycheck_category) & ~F.col("outflow")
    categories = lake.ref("stg_categories").select("category_id", "category_group", "group_type")
    kind, total, zero = F.col("group_type"), F.col("total"), F.lit(0).cast("decimal(28,3)")
    return (
        totals.join(categories, "category_id", "left")
        .where(F.coalesce(kind, F.lit("")) != "transfer")
        .select(
            "month",
            F.coalesce("category_group", F.lit("Uncategorized")).alias("category_group"),
            F.when(kind == "expense", -total).otherwise(zero).alias("expense"),
            F.when(kind == "income", total).otherwise(zero).alias("income"),
            F.when(paycheck, total).otherwise(zero).alias("w2"),
            (F.col("outflow") & (kind == "expense")).alias("is_spend"),
        )
    )


@model("gold")
def int_monthly_totals(lake: Lake) -> DataFrame:
    """Expense, income and paycheck per month and category group, spending and refunds apart.

    The build stores it by month; the monthly tables then read it in place of the transactions.
    """
    spend = F.coalesce("is_spend", F.lit(False)).alias("is_spend")
    return (
        monthly_totals(lake)
        .groupBy("month", "category_group", spend)
        .agg(*[F.sum(name).alias(name) for name in ("expense", "income", "w2")])
    )


def totals_since(lake: Lake, since: date | None = None) -> DataFrame:
    """Monthly totals from their stored table where there is one: a read of the months asked for."""
    if not lake.is_settled("int_monthly_totals"):
        return monthly_totals(lake, since)
    stored = lake.ref("int_monthly_totals")
    return stored.where(F.col("month") >= F.lit(since)) if since else stored


@model("gold")
def mart_monthly_cashflow(lake: Lake) -> DataFrame:
    sums = totals_since(lake).groupBy("month").agg(
        F.sum("income").alias("inc"), F.sum("w2").alias("w2"), F.sum("expense").alias("exp")
    )
    inc, w2, exp = F.col("inc"), F.col("w2"), F.col("exp")
    return sums.select(
        "month",
        round_money(inc).alias("income"),
        round_money(w2).alias("w2_income"),
        round_money(inc - w2).alias("other_income"),
        round_money(exp).alias("spend"),
        round_money(inc - exp).alias("net"),
        percent(inc - exp, inc, 0).alias("savings_rate_pct"),
    ).orderBy("month")


@model("gold")
def mart_spend_by_category(lake: Lake) -> DataFrame:
    """Expense rows above zero only: refunds do not lower a category's month here."""
    return (
        totals_since(lake)
        .where("is_spend")
        .groupBy("category_group", "month")
        .agg(round_money(F.sum("expense")).alias("spend"))
        .orderBy(F.desc("month"), F.desc("spend"))
    )


@model("gold")
def mart_top_merchants(lake: Lake) -> DataFrame:
    return (
        lake.ref("int_transactions")
        .where(
            (F.col("expense_amount") > 0)
            & F.col("merchant").isNotNull()
            & (F.col("txn_date") >= lake.days_ago(30))
        )
        .groupBy("merchant")
        .agg(
            round_money(F.sum("expense_amount")).alias("spend"),
            F.count(F.lit(1)).alias("txns"),
        )
        .orderBy(F.desc("spend"), "merchant")
        .limit(8)
    )


def _recent_spend(lake: Lake) -> DataFrame:
    """Per category group, one pass: this month's spend and the three before it, summed."""
    start = F.lit(lake.month.start)
    running = F.col("month") >= start
    return (
        totals_since(lake, since=lake.month.back(3))
        .groupBy("category_group")
        .agg(
            F.sum(F.when(running, F.col("expense"))).alias("mtd"),
            F.sum(F.when(~running, F.col("expense"))).alias("prior"),
        )
    )


@model("gold")
def mart_category_trend(lake: Lake) -> DataFrame:
    average = F.coalesce(F.col("prior").cast("double") / 3.0, F.lit(0.0))
    return (
        _recent_spend(lake)
        .where(F.col("mtd") > 0)
        .select(
            "category_group",
            round_money(F.col("mtd")).alias("this_month"),
            round_to(average).alias("avg_3mo"),
            round_to(F.col("mtd").cast("double") - average).alias("delta"),
        )
        .orderBy(F.desc("this_month"))
    )


def budget_targets(lake: Lake) -> DataFrame:
    src = lake.seed("budget_targets")
    t = Typed(src)
    return src.select(
        "category_group",
        "tier",
        "note",
        t.number("monthly_target").alias("monthly_target"),
        t.date("effective_from").alias("effective_from"),
        t.date("effective_to").alias("effective_to"),
    )


@model("gold")
def mart_budget_vs_actual(lake: Lake) -> DataFrame:
    month, targets = lake.month, budget_targets(lake)
    current = targets.where(in_force(F.lit(month.start))).select(
        "category_group", "tier", "note", F.col("monthly_target").alias("target")
    )
    window = literal_rows(lake.spark, ["mo"], [(d,) for d in month.complete_months(3)])
    trailing = (
        effective_dated(targets, window, "mo")
        .groupBy("category_group")
        .agg((F.sum("monthly_target").cast("double") / F.count("monthly_target")).alias("blended"))
    )
    joined = current.join(trailing, "category_group", "left").join(
        _recent_spend(lake), "category_group", "left"
    )
    target = F.coalesce("blended", F.col("target").cast("double"))
    spent = F.coalesce("mtd", F.lit(0).cast("decimal(18,3)"))
    average = F.coalesce(F.col("prior").cast("double") / 3.0, F.lit(0.0))
    gap = average - target
    return (
        joined.withColumn("__gap", gap)
        .select(
            "category_group",
            "tier",
            "note",
            round_money(F.col("target")).alias("monthly_target"),
            round_to(target).alias("target_trailing"),
            (target != F.col("target").cast("double")).alias("target_changed"),
            round_money(spent).alias("spend_mtd"),
            round_to(average).alias("avg_3mo"),
            round_to(gap).alias("gap_vs_target"),
            F.lit(month.elapsed).alias("days_elapsed"),
            F.lit(month.days).alias("days_in_month"),
            round_to(F.lit(100.0 * month.elapsed / month.days)).alias("mtd_pct_of_month"),
            pace_projection(spent, month, F.col("tier") == "fixed").alias("projected_month"),
            F.when(average <= target, "on_target")
            .when(average <= target * 1.25, "over")
            .otherwise("well_over")
            .alias("status"),
            "__gap",
        )
        .orderBy(F.desc("__gap"))
        .drop("__gap")
    )


@model("gold")
def mart_safe_to_spend(lake: Lake) -> DataFrame:
    """Month position against the targets.

    Targets are those in force this month. Settings.legacy_targets sums every dated row
    instead, expired ones included, and lets a flexible group count once per row.
    """
    start = F.lit(lake.month.start)
    targets = budget_targets(lake)
    if not lake.settings.legacy_targets:
        targets = targets.where(in_force(start))
    flexible = F.col("tier") == "flexible"
    totals = targets.agg(
        F.sum("monthly_target").alias("total_target"),
        F.sum(F.when(flexible, F.col("monthly_target")).otherwise(0)).alias("flexible_target"),
    )
    weight = F.count(F.lit(1)) if lake.settings.legacy_targets else F.max(F.lit(1))
    flexible_groups = targets.where(flexible).groupBy("category_group").agg(weight.alias("times"))

    # One scan of the transactions: totals per month and group, then per month, then the
    # single row. The last step holds one entry per calendar month.
    times = F.coalesce("times", F.lit(0)).cast("int")
    by_month = (
        totals_since(lake)
        .join(flexible_groups, "category_group", "left")
        .groupBy(F.col("month").alias("mo"))
        .agg(
            F.sum("income").alias("income"),
            F.sum("w2").alias("w2"),
            F.sum("expense").alias("spend"),
            F.sum(F.col("expense") * times).alias("flex"),
        )
    )
    complete = F.when(F.col("mo") < start, F.struct("mo", "income", "w2", "spend"))
    running = F.col("mo") >= start

    def month_to_date(name: str):
        return F.coalesce(F.sum(F.when(running, F.col(name))), F.lit(0))

    sums = by_month.agg(
        F.slice(F.sort_array(F.collect_list(complete), asc=False), 1, 3).alias("newest"),
        month_to_date("spend").alias("spent"),
        month_to_date("income").alias("earned"),
        month_to_date("flex").alias("flex_spent"),
    )

    def average(name: str):
        known = F.filter(F.col("newest")[name], lambda x: x.isNotNull())
        added = F.aggregate(known, F.lit(0).cast("decimal(38,3)"), lambda acc, x: (acc + x).cast("decimal(38,3)"))
        return F.coalesce(
            added.cast("double") / F.nullif(F.size(known).cast("double"), F.lit(0.0)), F.lit(0.0)
        )

    row = sums.select(
        average("income").alias("avg_income"),
        average("w2").alias("avg_w2"),
        average("spend").alias("avg_spend"),
        "spent",
        "earned",
        "flex_spent",
    ).crossJoin(F.broadcast(totals))
    income, spend = F.col("avg_income"), F.col("avg_spend")
    total = F.col("total_target").cast("double")
    return row.select(
        round_to(income).alias("avg_monthly_income"),
        round_to(F.col("avg_w2")).alias("avg_monthly_w2"),
        round_to(spend).alias("avg_monthly_spend"),
        total.alias("total_target"),
        F.col("flexible_target").cast("double").alias("flexible_target"),
        round_money(F.col("spent")).alias("spent_this_month"),
        round_money(F.col("earned")).alias("income_this_month"),
        round_money(F.col("flex_spent")).alias("flexible_spent_this_month"),
        round_money(F.col("flexible_target") - F.col("flex_spent")).alias("flexible_left"),
        round_to(income - total).alias("target_monthly_savings"),
        percent(income - total, income, 0).alias("target_savings_rate_pct"),
        percent(income - spend, income, 0).alias("actual_savings_rate_pct"),
    )


@model("ephemeral")
def int_account_sums(lake: Lake) -> DataFrame:
    """One row: liquid cash and both health accounts' balances."""
    balance, account = F.col("current_balance"), F.col("account")

    def held(condition):
        return F.coalesce(F.sum(F.when(condition, balance)), F.lit(0).cast("decimal(18,3)"))

    return lake.ref("stg_accounts").agg(
        held((F.col("account_type") == "Cash") & F.col("is_asset")).alias("liquid"),
        held(account.startswith(lake.settings.hsa_cash_prefix)).alias("hsa_cash"),
        held(account.startswith(lake.settings.hsa_invested_prefix)).alias("hsa_invested"),
    )


@model("gold")
def mart_runway(lake: Lake) -> DataFrame:
    liquid = lake.ref("int_account_sums").select("liquid")
    burn = lake.ref("mart_safe_to_spend").select(F.col("avg_monthly_spend").alias("burn"))
    return liquid.crossJoin(F.broadcast(burn)).select(
        round_money(F.col("liquid")).alias("liquid_savings"),
        round_to(F.col("burn")).alias("monthly_burn"),
        round_to(ratio(F.col("liquid"), F.col("burn")), 1).alias("runway_months"),
    )


@model("gold")
def mart_networth(lake: Lake) -> DataFrame:
    return (
        lake.ref("stg_networth")
        .select("snapshot_date", round_money(F.col("net_worth")).alias("net_worth"))
        .orderBy("snapshot_date")
    )


@model("gold")
def mart_networth_breakdown(lake: Lake) -> DataFrame:
    """Debt, Cash, Investments; any other account type is its own bucket."""
    kind = F.col("account_type")
    return (
        lake.ref("stg_accounts")
        .where("include_in_net_worth")
        .groupBy(F.when(kind.isin("Credit Cards", "Loans"), "Debt").otherwise(kind).alias("bucket"))
        .agg(round_money(F.sum("current_balance")).alias("balance"))
        .orderBy(F.desc("balance"))
    )


@model("gold")
def mart_account_balances(lake: Lake) -> DataFrame:
    """Unordered, as the table has no bound: order belongs to the read that has a limit."""
    return lake.ref("stg_accounts").select(
        "account",
        "account_type",
        F.col("current_balance").cast("double").alias("current_balance"),
        "is_asset",
        "include_in_net_worth",
    )


@model("gold")
def mart_recurring_summary(lake: Lake) -> DataFrame:
    return (
        lake.ref("stg_recurring")
        .where(F.col("amount") < 0)
        .agg(
            round_money(F.sum(F.abs("amount"))).alias("monthly_recurring"),
            F.count(F.lit(1)).alias("bills"),
        )
    )
