"""Column lists of the landed (bronze) tables and the seed dimensions.

Bronze is text throughout. A column missing from a load becomes a null string,
so the schema never depends on which values happened to arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRONZE: dict[str, list[str]] = {
    "leads_master": [
        "id", "name", "practice_name", "specialty", "city", "state", "website", "email",
        "found_date", "source", "status", "content_signals", "linkedin_url", "linkedin_active",
        "community_platform", "audience_size_estimate", "angle_assigned", "cohort",
        "last_touch_date", "next_action_date", "has_team", "operator_visible", "email_list",
        "contact_type", "segment", "notes",
    ],
    "touch_log": [
        "touch_id", "lead_id", "date", "channel", "touch_number", "angle", "subject_line",
        "replied", "reply_sentiment", "objection_tag", "notes", "opened",
    ],
    "mm_accounts": [
        "id", "display_name", "current_balance", "is_asset", "include_in_net_worth",
        "type__display", "institution__name", "order",
    ],
    "mm_categories": ["id", "name", "group__name", "group__type"],
    "mm_transactions": [
        "id", "date", "amount", "category__id", "category__name", "merchant__name",
        "account__id", "account__display_name", "is_recurring", "pending", "hide_from_reports",
    ],
    "mm_recurring": [
        "date", "amount", "stream__frequency", "stream__amount", "stream__merchant__name",
        "category__id", "category__name", "account__id", "account__display_name",
    ],
    "mm_networth": ["date", "balance"],
    "mm_holdings": [
        "account", "account_id", "ticker", "name", "security_type", "market_value", "quantity",
        "basis", "change_pct",
    ],
    "fred_observations": ["series", "series_id", "obs_date", "obs_value"],
    "lh_shiller": ["entity", "year", "period", "series", "value"],
    "lh_jst": ["entity", "year", "period", "series", "value"],
    "lh_boe": ["entity", "year", "period", "series", "value"],
    "stripe_charges": [
        "id", "amount", "amount_refunded", "currency", "created", "status", "paid", "refunded",
        "description", "customer", "invoice", "livemode",
    ],
    "stripe_invoices": [
        "id", "amount_due", "amount_paid", "currency", "created", "status", "customer",
        "subscription", "period_start", "period_end", "livemode",
    ],
    "stripe_subscriptions": [
        "id", "status", "created", "customer", "current_period_start", "current_period_end",
        "cancel_at_period_end", "livemode",
    ],
    "stripe_customers": ["id", "created", "email", "name", "delinquent", "livemode"],
}

# Nested landing files, every leaf read as its text: nothing is inferred and no digit is
# lost. A list declared as string arrives as its JSON text.
RAW: dict[str, str] = {
    "accounts": """
        id string, displayName string, currentBalance string, isAsset string,
        includeInNetWorth string, type struct<display: string>, institution struct<name: string>,
        `order` string,
        portfolio struct<aggregateHoldings: struct<edges: array<struct<node: struct<
            security: struct<ticker: string, name: string, type: string, typeDisplay: string>,
            holdings: array<struct<ticker: string, name: string, type: string>>,
            totalValue: string, quantity: string, basis: string,
            securityPriceChangePercent: string>>>>>""",
    "categories": "id string, name string, `group` struct<name: string, type: string>",
    "transactions": """
        id string, date string, amount string, category struct<id: string, name: string>,
        merchant struct<name: string>, account struct<id: string, displayName: string>,
        isRecurring string, pending string, hideFromReports string""",
    "recurring": """
        date string, amount string,
        stream struct<frequency: string, amount: string, merchant: struct<name: string>>,
        category struct<id: string, name: string>, account struct<id: string, displayName: string>""",
    "networth": "date string, balance string",
}

SEEDS: dict[str, list[str]] = {
    "security_map": ["ticker", "region", "asset_class", "sleeve"],
    "budget_targets": [
        "category_group", "tier", "monthly_target", "effective_from", "effective_to", "note",
    ],
    "review_cadence": ["review", "cadence_days", "last_completed", "source", "what_to_do"],
}

LOAD_LOG = T.StructType(
    [
        T.StructField("schema_name", T.StringType()),
        T.StructField("inserted_at", T.TimestampType()),
    ]
)


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def with_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """At least `columns`: absent ones are added as null strings."""
    present = set(df.columns)
    absent = [c for c in columns if c not in present]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly `columns`, in order; absent ones are null strings."""
    present = set(df.columns)
    return df.select(
        *[F.col(f"`{c}`") if c in present else F.lit(None).cast("string").alias(c) for c in columns]
    )
