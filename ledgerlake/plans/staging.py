"""Silver: rename, safe typing, light cleaning. One model per landed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import Lake, model
from ledgerlake.functions.columns import Typed, tri_flag


@model("silver")
def stg_leads(lake: Lake) -> DataFrame:
    src = lake.source("leads_master")
    t = Typed(src)
    return src.select(
        F.col("id").cast("int").alias("lead_id"),
        "name", "practice_name", "specialty", "city", "state", "website",
        F.lower(F.trim("email")).alias("email"),
        "linkedin_url", "community_platform", "status", "source", "angle_assigned", "cohort",
        "segment", "contact_type", "content_signals", "audience_size_estimate", "notes",
        (F.col("has_team") == "Y").alias("has_team"),
        (F.col("operator_visible") == "Y").alias("operator_visible"),
        "email_list",
        tri_flag(t.text("linkedin_active"), ("true", "yes"), ("false",)).alias("linkedin_active"),
        *[t.date(c).alias(c) for c in ("found_date", "last_touch_date", "next_action_date")],
    )


@model("silver")
def stg_touches(lake: Lake) -> DataFrame:
    src = lake.source("touch_log")
    t = Typed(src)
    return src.select(
        "touch_id",
        F.col("lead_id").cast("int").alias("lead_id"),
        F.col("date").cast("date").alias("touch_date"),
        "channel",
        t.integer("touch_number").alias("touch_number"),
        "angle",
        "subject_line",
        tri_flag(F.col("replied"), ("yes",), ("no",)).alias("replied"),
        "reply_sentiment",
        "objection_tag",
        "notes",
        tri_flag(F.col("opened"), ("yes",), ("no",)).alias("opened"),
    )


@model("silver")
def stg_accounts(lake: Lake) -> DataFrame:
    src = lake.source("mm_accounts")
    t = Typed(src)
    return src.select(
        F.col("id").alias("account_id"),
        F.col("display_name").alias("account"),
        t.number("current_balance").alias("current_balance"),
        F.col("type__display").alias("account_type"),
        t.flag("is_asset").alias("is_asset"),
        t.flag("include_in_net_worth").alias("include_in_net_worth"),
        F.col("institution__name").alias("institution"),
    )


@model("silver")
def stg_transactions(lake: Lake) -> DataFrame:
    src = lake.source("mm_transactions")
    t = Typed(src)
    return src.select(
        F.col("id").alias("transaction_id"),
        t.date("date").alias("txn_date"),
        t.number("amount").alias("amount"),
        F.col("category__name").alias("category"),
        F.col("category__id").alias("category_id"),
        F.col("merchant__name").alias("merchant"),
        F.col("account__display_name").alias("account"),
        F.col("account__id").alias("account_id"),
        *[t.flag(c).alias(c) for c in ("is_recurring", "pending", "hide_from_reports")],
    )


@model("silver")
def stg_categories(lake: Lake) -> DataFrame:
    return lake.source("mm_categories").select(
        F.col("id").alias("category_id"),
        F.col("name").alias("category"),
        F.col("group__name").alias("category_group"),
        F.col("group__type").alias("group_type"),
    )


@model("silver")
def stg_recurring(lake: Lake) -> DataFrame:
    src = lake.source("mm_recurring")
    t = Typed(src)
    return src.select(
        t.date("date").alias("due_date"),
        t.number("amount").alias("amount"),
        F.col("stream__frequency").alias("frequency"),
        F.col("stream__merchant__name").alias("merchant"),
        F.col("category__name").alias("category"),
        F.col("account__display_name").alias("account"),
    )


@model("silver")
def stg_networth(lake: Lake) -> DataFrame:
    src = lake.source("mm_networth")
    t = Typed(src)
    return src.select(t.date("date").alias("snapshot_date"), t.number("balance").alias("net_worth"))


@model("silver")
def stg_holdings(lake: Lake) -> DataFrame:
    src = lake.source("mm_holdings")
    t = Typed(src)
    held = src.select(
        "account", "ticker", "name", "security_type",
        t.number("market_value").alias("market_value"),
        t.number("change_pct").alias("change_pct"),
    )
    return held.join(lake.seed("security_map"), "ticker", "left").select(
        "account",
        "ticker",
        "name",
        F.coalesce("region", F.lit("US")).alias("region"),
        F.coalesce("asset_class", "security_type").alias("asset_class"),
        F.coalesce("sleeve", F.lit("standard")).alias("sleeve"),
        "market_value",
        "change_pct",
    )


@model("silver")
def stg_fred(lake: Lake) -> DataFrame:
    src = lake.source("fred_observations")
    t = Typed(src)
    return src.select(
        "series", "series_id", t.date("obs_date").alias("obs_date"), t.ratio("obs_value").alias("value")
    )


def _long_history(lake: Lake, table: str) -> DataFrame:
    src = lake.source(table)
    t = Typed(src)
    return src.select(
        "entity",
        t.integer("year").alias("year"),
        t.integer("period").alias("period"),
        "series",
        t.ratio("value").alias("value"),
    )


@model("silver")
def stg_lh_shiller(lake: Lake) -> DataFrame:
    return _long_history(lake, "lh_shiller")


@model("silver")
def stg_lh_jst(lake: Lake) -> DataFrame:
    return _long_history(lake, "lh_jst")


@model("silver")
def stg_lh_boe(lake: Lake) -> DataFrame:
    return _long_history(lake, "lh_boe")


def _from_cents(t: Typed, name: str):
    """Smallest currency unit to whole units, exactly, and only here."""
    return (t.number(name) * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,5)")


@model("silver")
def stg_stripe_charges(lake: Lake) -> DataFrame:
    src = lake.source("stripe_charges")
    t = Typed(src)
    return src.select(
        F.col("id").alias("charge_id"),
        _from_cents(t, "amount").alias("amount"),
        _from_cents(t, "amount_refunded").alias("amount_refunded"),
        "currency",
        t.epoch_date("created").alias("created_date"),
        "status",
        t.flag("paid").alias("paid"),
        t.flag("refunded").alias("refunded"),
        "description",
        F.col("customer").alias("customer_id"),
        F.col("invoice").alias("invoice_id"),
        t.flag("livemode").alias("livemode"),
    )


@model("silver")
def stg_stripe_customers(lake: Lake) -> DataFrame:
    src = lake.source("stripe_customers")
    t = Typed(src)
    return src.select(
        F.col("id").alias("customer_id"),
        "email",
        "name",
        t.epoch_date("created").alias("created_date"),
        t.flag("livemode").alias("livemode"),
    )


@model("silver")
def stg_stripe_subscriptions(lake: Lake) -> DataFrame:
    src = lake.source("stripe_subscriptions")
    t = Typed(src)
    return src.select(
        F.col("id").alias("subscription_id"),
        "status",
        F.col("customer").alias("customer_id"),
        t.epoch_date("created").alias("created_date"),
        t.flag("cancel_at_period_end").alias("cancel_at_period_end"),
        t.flag("livemode").alias("livemode"),
    )
