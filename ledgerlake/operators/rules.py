"""Rule checks, freshness and due-date wording."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import round_to


@dataclass(frozen=True)
class Rule:
    """One visible check: it yields an 'act' or an 'ok' row, never nothing."""

    key: str
    current: Column
    target: Column
    act: Column


def rule_checks(metrics: DataFrame, rules: Sequence[Rule], texts: DataFrame) -> DataFrame:
    """One row per rule from a one-row frame of metrics, open actions first.

    texts is the fixed rule table: key, severity, area, title, detail, unit.
    """
    rows = [
        F.struct(
            F.lit(r.key).alias("key"),
            r.current.cast("double").alias("current"),
            r.target.cast("double").alias("target"),
            r.act.alias("act"),
        )
        for r in rules
    ]
    checks = metrics.select(F.inline(F.array(*rows))).join(F.broadcast(texts), "key")
    status = F.when(F.col("act"), "act").otherwise("ok")
    return checks.select(
        "severity",
        "area",
        "title",
        "detail",
        round_to(F.col("current"), 1).alias("current_value"),
        round_to(F.col("target"), 1).alias("target_value"),
        "unit",
        status.alias("status"),
    ).orderBy(F.when(F.col("status") == "act", 0).otherwise(1), "severity", "area")


def freshness_status(age: Column, expected_lag: Column) -> Column:
    return (
        F.when(age.isNull(), "unknown")
        .when(age <= expected_lag, "current")
        .when(age <= expected_lag * 2, "lagging")
        .otherwise("stale")
    )


def cadence_due(df: DataFrame, as_of: Column) -> DataFrame:
    """Adds days_since, overdue and the due wording of a review with a cadence."""
    since = F.datediff(as_of, F.col("last_completed"))
    overdue = since > F.col("cadence_days")
    late = (since - F.col("cadence_days")).cast("string")
    left = (F.col("cadence_days") - since).cast("string")
    return df.withColumns(
        {
            "days_since": since,
            "overdue": overdue,
            "due_headline": F.when(overdue, F.concat("review", F.lit(" is OVERDUE"))).otherwise(
                F.concat("review", F.lit(" due in "), left, F.lit(" days"))
            ),
            "due_value": F.when(overdue, F.concat(late, F.lit(" days past due"))).otherwise(
                "on schedule"
            ),
        }
    )
