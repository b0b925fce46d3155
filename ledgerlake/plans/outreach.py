"""Outreach gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import Lake, model
from ledgerlake.functions.columns import one_zero, percent


@model("gold")
def fact_touch(lake: Lake) -> DataFrame:
    return lake.ref("stg_touches").select(
        "touch_id", "lead_id", "touch_date", "channel", "angle", "touch_number",
        "reply_sentiment", "objection_tag",
        one_zero(F.col("replied")).alias("is_reply"),
        one_zero(F.col("opened")).alias("is_open"),
    )


@model("gold")
def mart_outreach_funnel(lake: Lake) -> DataFrame:
    counts = (
        lake.ref("fact_touch")
        .groupBy("angle")
        .agg(
            F.count(F.lit(1)).alias("total_touches"),
            F.sum("is_open").alias("opens"),
            F.sum("is_reply").alias("replies"),
        )
    )
    touches, opens, replies = F.col("total_touches"), F.col("opens"), F.col("replies")
    return counts.select(
        F.coalesce("angle", F.lit("unassigned")).alias("angle"),
        "total_touches",
        "opens",
        "replies",
        percent(opens, touches, 1).alias("open_rate_pct"),
        percent(replies, touches, 1).alias("reply_rate_pct"),
        percent(replies, opens, 1).alias("reply_over_open_rate_pct"),
    ).orderBy(F.desc("total_touches"))
