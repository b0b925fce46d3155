"""Freshness, the review digest and the daily snapshot row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed_values as fixed
from ledgerlake.context import Lake, literal_rows, model
from ledgerlake.functions.columns import Typed, number_text, whole_text
from ledgerlake.operators.rules import cadence_due, freshness_status
from ledgerlake.plans.portfolio import scope_shares


def newest_facts(lake: Lake) -> DataFrame:
    """One row: the newest fact date of every source, each source read once."""
    per_series = lake.ref("stg_fred").groupBy("series").agg(F.max("obs_date").alias("latest"))
    macro = per_series.agg(
        F.max(F.when(F.col("series").isin(fixed.FAST_SERIES), F.col("latest"))).alias("macro_fast"),
        F.min(F.when(F.col("series").isin(fixed.SLOW_SERIES), F.col("latest"))).alias("macro_slow"),
    )
    # Year and month of the same newest row; separate maxima could pair two rows.
    cape = lake.ref("int_newest_cape").select(
        F.make_date(F.floor(F.col("ym") / 100).cast("int"), (F.col("ym") % 100).cast("int"), F.lit(1))
        .alias("valuation")
    )

    def year_end(table: str, name: str) -> DataFrame:
        newest = F.max("year")
        return lake.ref(table).agg(F.make_date(newest, F.lit(12), F.lit(31)).alias(name))

    one_row = [
        lake.ref("stg_transactions").agg(F.max("txn_date").alias("transactions")),
        macro,
        cape,
        year_end("stg_lh_jst", "country_panel"),
        year_end("stg_lh_boe", "millennium"),
        lake.ref("int_charge_sums").select(F.col("newest_charge").alias("revenue")),
        lake.ref("stg_leads").agg(F.max("found_date").alias("leads")),
    ]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), one_row)


def last_loads(lake: Lake) -> DataFrame:
    """Newest load per pipeline, recognised by the start of the load's schema name."""
    key = None
    for prefix, pipeline in lake.settings.load_prefixes.items():
        test = F.col("schema_name").startswith(prefix)
        key = F.when(test, pipeline) if key is None else key.when(test, pipeline)
    return (
        lake.load_log()
        .groupBy(key.otherwise("bronze").alias("pipeline"))
        .agg(F.max("inserted_at").alias("last_loaded"))
    )


@model("gold")
def mart_data_freshness(lake: Lake) -> DataFrame:
    keys = list(fixed.FRESHNESS_SOURCES)
    long = newest_facts(lake).unpivot([], keys, "key", "data_through")
    config = literal_rows(
        lake.spark,
        ["key", "source", "ord", "pipeline", "expected_lag_days", "feeds"],
        [
            (k, lake.settings.source_labels[k], order, pipeline, lag, feeds)
            for k, (order, pipeline, lag, feeds) in fixed.FRESHNESS_SOURCES.items()
        ],
    )
    age = F.datediff(lake.today, "data_through")
    return (
        config.join(long, "key")
        .join(last_loads(lake), "pipeline", "left")
        .select(
            "source",
            "ord",
            "feeds",
            "data_through",
            "last_loaded",
            "expected_lag_days",
            age.alias("data_age_days"),
            freshness_status(age, F.col("expected_lag_days")).alias("status"),
        )
        .orderBy("ord")
    )


def _section(df: DataFrame, section: str, order: int, headline, detail, value, severity) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        F.lit(order).alias("ord"),
        headline.alias("headline"),
        detail.alias("detail"),
        value.alias("value"),
        severity.cast("int").alias("severity"),
    )


@model("gold")
def mart_review_digest(lake: Lake) -> DataFrame:
    c, text = F.col, F.lit
    lake.settle("int_monthly_totals")  # months × groups; the budget and the actions read it
    lake.settle_rows("int_charge_sums")  # revenue and freshness read it
    seed = lake.seed("review_cadence")
    t = Typed(seed)
    cadence = cadence_due(
        seed.select(
            "review",
            "what_to_do",
            t.integer("cadence_days").alias("cadence_days"),
            t.date("last_completed").alias("last_completed"),
        ),
        lake.today,
    )
    actions = lake.ref("mart_portfolio_actions").where(c("status") == "act")
    budget = lake.ref("mart_budget_vs_actual").where(c("gap_vs_target") > 50)
    stale = lake.ref("mart_data_freshness").where(c("status") == "stale")
    sections = [
        _section(
            cadence, "Cadence", 1, c("due_headline"), c("what_to_do"), c("due_value"),
            F.when(c("overdue"), 1).otherwise(3),
        ),
        _section(
            actions, "Portfolio", 2, c("title"), c("detail"),
            F.when(c("unit") == "$", F.concat(text("$"), whole_text(c("current_value")))).otherwise(
                F.concat(number_text(c("current_value")), c("unit"))
            ),
            c("severity"),
        ),
        _section(
            budget, "Budget", 3,
            F.concat(
                c("category_group"), text(" is running "), whole_text(c("gap_vs_target")),
                text("/mo over a "), whole_text(c("target_trailing")), text(" target"),
            ),
            F.coalesce("note", text("")),
            F.concat(text("$"), whole_text(c("avg_3mo")), text("/mo actual")),
            F.when(c("status") == "well_over", 2).otherwise(3),
        ),
        _section(
            lake.ref("mart_revenue"), "Revenue", 4,
            F.concat(
                c("paying_customers").cast("string"), text(" of "),
                c("clients_target_min").cast("string"), text(" paying clients, "),
                number_text(c("months_to_deadline")), text(" months to the binary"),
            ),
            text(fixed.REVENUE_DETAIL),
            F.concat(text("$"), whole_text(c("net_collected")), text(" collected")),
            F.when(c("status") == "on_target", 3).otherwise(2),
        ),
        _section(
            stale, "Data", 5,
            F.concat(
                c("source"), text(" has not published in "), c("data_age_days").cast("string"),
                text(" days"),
            ),
            c("feeds"),
            F.concat(text("through "), c("data_through").cast("string")),
            text(3),
        ),
    ]
    return reduce(DataFrame.unionByName, sections).orderBy("severity", "ord", "headline")


@model("gold")
def mart_review_snapshot(lake: Lake) -> DataFrame:
    """The one row of today; sinks.tables.append_snapshot adds it once per day."""
    c = F.col
    # One row each, read here and by the runway, the actions, revenue or freshness.
    lake.settle_rows(
        "mart_safe_to_spend", "int_holding_sums", "int_account_sums", "int_charge_sums", "int_newest_cape"
    )
    one_row = [
        lake.ref("int_holding_sums").select(
            scope_shares("Active")[1].alias("active_us_pct"),
            scope_shares("Combined")[0].alias("combined_equity"),
        ),
        lake.ref("mart_portfolio_actions").agg(F.count_if(c("status") == "act").alias("open_actions")),
        lake.ref("mart_safe_to_spend").agg(
            F.max("avg_monthly_spend").alias("avg_monthly_spend"),
            F.max("actual_savings_rate_pct").alias("savings_rate_pct"),
        ),
        lake.ref("mart_runway").agg(
            F.max("liquid_savings").alias("liquid_savings"),
            F.max("runway_months").alias("runway_months"),
        ),
        lake.ref("mart_revenue").agg(
            F.max("net_collected").alias("revenue_collected"),
            F.max("paying_customers").alias("paying_customers"),
        ),
        lake.ref("int_newest_cape").select("cape"),
        lake.ref("mart_macro_regime").agg(F.max("quadrant").alias("regime")),
        lake.ref("mart_data_freshness").agg(F.count_if(c("status") == "stale").alias("stale_sources")),
    ]
    row = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), one_row)
    return row.select(lake.today.alias("snapshot_date"), "*")
