"""Business revenue against a dated client target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed_values as fixed
from ledgerlake.context import Lake, model
from ledgerlake.functions.columns import round_to


@model("ephemeral")
def int_charge_sums(lake: Lake) -> DataFrame:
    """One row: sums, counts and dates of live charges, sums of test ones, the newest date of all."""
    live = F.col("livemode") & F.col("paid") & (F.col("status") == "succeeded")
    test = ~F.col("livemode")
    zero = F.lit(0).cast("decimal(18,5)")
    net = F.col("amount") - F.coalesce("amount_refunded", zero)
    recent = live & (F.col("created_date") >= lake.days_ago(90))

    def total(condition, value):
        return F.coalesce(F.sum(F.when(condition, value)), zero).cast("double")

    return lake.ref("stg_stripe_charges").agg(
        total(live, net).alias("net_collected"),
        F.count_if(live).alias("paid_charges"),
        F.countDistinct(F.when(live, F.col("customer_id"))).alias("paying_customers"),
        F.min(F.when(live, F.col("created_date"))).alias("first_payment"),
        F.max(F.when(live, F.col("created_date"))).alias("last_payment"),
        total(recent, net).alias("collected_90d"),
        F.count_if(test).alias("test_charges"),
        total(test, F.col("amount")).alias("test_amount"),
        F.max("created_date").alias("newest_charge"),
    )


@model("gold")
def mart_revenue(lake: Lake) -> DataFrame:
    """One row. Test-mode rows are counted on their own and never as revenue."""
    subscriptions = (
        lake.ref("stg_stripe_subscriptions")
        .where("livemode")
        .agg(
            F.sum(F.when(F.col("status") == "active", 1).otherwise(0)).alias("active_subscriptions"),
            F.count(F.lit(1)).alias("total_subscriptions"),
        )
    )
    deadline = lake.settings.revenue_deadline
    days_left = (deadline - lake.as_of).days
    at_least, at_most = fixed.CLIENTS_TARGET
    payers = F.col("paying_customers")
    return lake.ref("int_charge_sums").crossJoin(F.broadcast(subscriptions)).select(
        "net_collected", "paid_charges", "paying_customers", "first_payment", "last_payment",
        "collected_90d", "active_subscriptions", "total_subscriptions", "test_charges",
        "test_amount",
        F.lit(deadline).alias("deadline"),
        F.lit(at_least).alias("clients_target_min"),
        F.lit(at_most).alias("clients_target_max"),
        F.lit(days_left).alias("days_to_deadline"),
        round_to(F.lit(days_left) / fixed.DAYS_PER_MONTH, 1).alias("months_to_deadline"),
        F.greatest(F.lit(at_least) - payers, F.lit(0)).alias("clients_still_needed"),
        F.when((F.col("test_charges") > 0) & (F.col("paid_charges") == 0), "test_data_only")
        .when(payers >= at_least, "on_target")
        .when(F.lit(days_left < 90), "at_risk")
        .otherwise("behind")
        .alias("status"),
    )
