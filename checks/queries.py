"""Every registered query: the models, the read queries and the operators on their own.

QUERIES: name -> (spark, sf_dir) -> DataFrame; ORACLE: name -> DuckDB SQL. All of them
read the whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import feeds, oracle
from checks.feeds import AS_OF, SETTINGS, cents, day, money, table
from ledgerlake import MODELS, Lake, Settings
from ledgerlake import fixed_values as fixed
from ledgerlake.context import literal_rows
from ledgerlake.functions.columns import percent
from ledgerlake.operators import quality
from ledgerlake.operators.dates import date_table, occurrences, rolling_sums, without_gaps
from ledgerlake.operators.history import first_history, scd2_merge
from ledgerlake.operators.keyfilter import likely_in
from ledgerlake.operators.ordered import running_before
from ledgerlake.operators.periods import effective_for_facts, interval_join, share_of_total
from ledgerlake.operators.timeseries import (
    asof_join,
    asof_lookback,
    change_metrics,
    deflate,
    intervals,
    latest_by,
    local_minima,
    rank_quantiles,
    value_percentiles,
    with_lag,
    with_percentile,
)
from ledgerlake.plans.cashflow import budget_targets, month_parts
from ledgerlake.plans.checks import build_report
from ledgerlake.plans.serving import SERVING, lead_status_counts, recent_snapshots
from ledgerlake.session import cut_lineage, ensure_checkpoint_dir
from ledgerlake.sinks.tables import new_rows, read_history, update_history
from ledgerlake.sinks.upkeep import append_load, refresh_months
from ledgerlake.sources.landing import (
    country_panel,
    csv_lines,
    explode_holdings,
    fixed_records,
    flatten,
    json_records,
    macro_observations,
    monthly_equity_history,
    positional_history,
    read_csv_text,
    read_records,
    recent_transactions_window,
    sheet_headings,
    within_lookback,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
c = F.col


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = oracle.oracle(sql)
        return fn

    return register


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, as the comparison expects."""
    return df.select(
        *[c(n).cast("double").alias(n) if t.startswith("decimal") else c(n) for n, t in df.dtypes]
    )


# -- models: silver from all-text bronze, the rest from typed feeds ------------------------

for _name, (_layer, _) in MODELS.items():
    QUERIES[_name] = lambda spark, sf, n=_name, text=_layer == "silver": _plain(
        feeds.lake(spark, sf, text_bronze=text).ref(n)
    )
    ORACLE[_name] = oracle.model_oracle(_name)


@query("select * from safe_to_spend_all_targets")
def safe_to_spend_all_targets(spark, sf):
    settings = Settings(**{**SETTINGS.__dict__, "legacy_targets": True})
    return feeds.lake(spark, sf, settings=settings).ref("mart_safe_to_spend")


# -- read queries --------------------------------------------------------------------------

_SERVING_SQL = {
    "outreach_kpis": f"""
        select (select count(*) from stg_leads) as leads, count(*) as touches,
               {oracle.pct('sum(is_open)', 'count(*)', 1)} as open_rate, {oracle.pct('sum(is_reply)', 'count(*)', 1)} as reply_rate
        from fact_touch""",
    "last_refresh": "select max(inserted_at) as refreshed_at from load_log",
    "newest_month_spend": """
        select category_group, spend from mart_spend_by_category
        where month = (select max(month) from mart_spend_by_category) order by spend desc, category_group limit 8""",
    "shown_spend_total": """
        select sum(spend) as total_spend from (
            select category_group, spend from mart_spend_by_category
            where month = (select max(month) from mart_spend_by_category) order by spend desc, category_group limit 8)""",
    "top_category_trend": "select * from mart_category_trend order by this_month desc, category_group limit 8",
    "read_outreach_funnel": """
        select angle, total_touches, opens, replies, open_rate_pct, reply_rate_pct from mart_outreach_funnel""",
    "upcoming_bills": f"""
        select due_date, merchant, round(abs(amount))::double as amount from stg_recurring
        where due_date >= {oracle.AS_OF} order by 1, 2, 3 limit 6""",
    "recent_transactions": """
        select txn_date, merchant, category, round(amount)::double as amount from stg_transactions
        where not hide_from_reports order by txn_date desc, 2, 3, 4 limit 10""",
    "recent_cashflow": "select * from mart_monthly_cashflow order by month desc limit 8",
    "interval_histogram": """
        select ['6-11', '12-15', '16-20', '21-25', '26+'][k] as bucket, k as sort_key, count(*) as n
        from (select 1 + (interval_years >= 12)::int + (interval_years >= 16)::int + (interval_years > 20)::int
                     + (interval_years > 25)::int as k
              from mart_property_cycle_intervals where interval_years is not null) group by all""",
    "entity_credit": "select * from mart_credit_cycle where entity = 'NATION_1'",
    "digest_rows": "select severity, section, headline, detail, value from mart_review_digest",
    "digest_summary": """
        select count(*) filter (severity = 1) as items_now, count(*) as items_total from mart_review_digest""",
    "networth_change": """
        with r as (select net_worth as v, row_number() over (order by snapshot_date desc) as rn from mart_networth)
        select max(v) filter (rn = 1) as net_worth_now, max(v) filter (rn = 31) as net_worth_before,
               max(v) filter (rn = 1) - max(v) filter (rn = 31) as net_worth_change from r""",
    "complete_months_savings": """
        select round(avg(savings_rate_pct)) as savings_rate_pct
        from (select * from mart_monthly_cashflow order by month desc limit 3 offset 1)""",
    "flexible_pace": """
        select 27 as days_left, greatest(flexible_left, 0) / 27.0::double as daily_allowance,
               flexible_spent_this_month / 4.0::double * 30.0::double as projected,
               flexible_spent_this_month / 4.0::double * 30.0::double - flexible_target as projected_over,
               least(flexible_spent_this_month * 100 / flexible_target, 100) as pct_spent
        from mart_safe_to_spend""",
    "sleeve_totals": "select sleeve, round(sum(value)) as value from mart_positions group by 1",
    "smallest_standard_position": """
        select ticker, name, value, pct_of_active from mart_positions where sleeve = 'standard'
        order by pct_of_active, ticker nulls first, name, value limit 1""",
    "decline_count": """
        select count(*) filter (points_to_decline) as signals_pointing_to_decline, count(*) as signals
        from mart_debasement_signals""",
    "shared_hedge": """
        select if(a.covering_tickers = b.covering_tickers, a.covering_tickers, null) as shared_hedge
        from mart_all_weather a, mart_all_weather b
        where a.box = 'rising_growth_rising_inflation' and b.box = 'falling_growth_rising_inflation'""",
    "valuation_ladder": """
        select 'Now' as label, cape, true as is_now from mart_valuation
        union all select label, cape, false from mart_valuation_reference""",
    "freshness_summary": """
        with s as (select count(*) filter (status = 'stale') as st, count(*) filter (status = 'lagging') as la, count(*) as n
                   from mart_data_freshness)
        select case when st > 0 then 'stale' when la > 0 then 'lagging' else 'current' end as worst, st + la as sources_behind,
               n as sources, if(st + la = 0, format('All {} sources current', n), format('{} of {} sources behind', st + la, n)) as summary
        from s""",
    "regime_box": """
        select box, box_order, coverage, covering_pct, box = aw_box as is_now from mart_all_weather, mart_macro_regime""",
    "read_indicator_strip": "select series, latest_value, change_90d_pct, direction from mart_macro_indicators",
    "read_regime": "select * from mart_macro_regime",
    "read_spark_lines": "select series, obs_date, value from mart_macro_history",
    "read_networth_line": "select snapshot_date, net_worth from mart_networth",
    "read_freshness": "select * from mart_data_freshness",
    "read_actions": "select * from mart_portfolio_actions",
    "read_positions": "select * from mart_positions",
    "read_allocation": "select * from mart_allocation",
}
for _name, _fn in SERVING.items():
    QUERIES[_name] = lambda spark, sf, fn=_fn: _plain(fn(feeds.lake(spark, sf)))
    ORACLE[_name] = oracle.oracle(_SERVING_SQL[_name])


# -- time-series operators -----------------------------------------------------------------


@query("""
    select o_custkey, o_orderkey, o_orderdate::date as o_orderdate, o_totalprice from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""")
def latest_order_by_customer(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", day("o_orderdate").alias("o_orderdate"), "o_totalprice"
    )
    return latest_by(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


_CUSTOMER_DAYS = "(select o_custkey, o_orderdate::date as d, sum(o_totalprice::decimal(12,2))::double as v from orders group by all)"


@query(f"""
    with s as {_CUSTOMER_DAYS},
    n as (select o_custkey, max(d) as ld, arg_max(v, d) as lv from s group by 1)
    select n.o_custkey, lv as latest_value, ld as latest_date, s.v as prior, round(lv - s.v, 2) as change,
           {oracle.pct('(lv - s.v)', 's.v', 1)} as change_pct,
           case when lv > s.v then 'up' when lv < s.v then 'down' else 'flat' end as direction
    from n asof left join s on n.o_custkey = s.o_custkey and n.ld - 90 >= s.d""")
def asof_change_by_customer(spark, sf):
    daily = (
        table(spark, sf, "orders")
        .groupBy("o_custkey", day("o_orderdate").alias("d"))
        .agg(money(F.sum(cents("o_totalprice"))).cast("double").alias("v"))
    )
    looked = asof_lookback(daily, ["o_custkey"], "d", "v", {"prior": ("days", 90)})
    return change_metrics(looked, "latest_value", "prior")


@query("""
    with s as (select o_orderpriority as p, o_orderdate::date as d, sum(o_totalprice::decimal(12,2))::double as v from orders group by all),
    n as (select p, max(d) as ld, arg_max(v, d) as lv from s group by 1)
    select n.p as o_orderpriority, lv as latest_value, ld as latest_date, a.v as m3, b.v as m12, e.v as m15
    from n asof left join s a on n.p = a.p and (n.ld - interval 3 month)::date >= a.d
           asof left join s b on n.p = b.p and (n.ld - interval 12 month)::date >= b.d
           asof left join s e on n.p = e.p and (n.ld - interval 15 month)::date >= e.d""")
def asof_multi_offset(spark, sf):
    daily = (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority", day("o_orderdate").alias("d"))
        .agg(money(F.sum(cents("o_totalprice"))).cast("double").alias("v"))
    )
    offsets = {"m3": ("months", 3), "m12": ("months", 12), "m15": ("months", 15)}
    return asof_lookback(daily, ["o_orderpriority"], "d", "v", offsets)


@query("""
    select o_orderkey, o_totalprice, percent_rank() over (order by o_totalprice) as pctile, count(*) over () as n_obs
    from orders""")
def percentile_global(spark, sf):
    return with_percentile(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [], "o_totalprice")


@query("""
    select event_id, event_type, value, percent_rank() over (partition by event_type order by value) as pctile,
           count(*) over (partition by event_type) as n_obs
    from events""")
def percentile_by_type(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return with_percentile(events, ["event_type"], "value")


_HELD_BY_A_THIRD = "case when l_orderkey % 3 = 0 then 0.0 else l_extendedprice::double end"


@query(f"""
    select l_orderkey, l_linenumber, v, percent_rank() over (order by v) as pctile, count(*) over () as n_obs
    from (select l_orderkey, l_linenumber, {_HELD_BY_A_THIRD} as v from lineitem)""")
def percentile_hot_value(spark, sf):
    """A third of the rows hold one value: its rank goes to the rows, not they to it."""
    price = F.when(c("l_orderkey") % 3 == 0, 0.0).otherwise(c("l_extendedprice").cast("double"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", price.alias("v"))
    return with_percentile(lines, [], "v")


@query("""
    select distinct l_quantity, count(*) over (partition by l_quantity) as n, count(*) over () as n_obs,
           percent_rank() over (order by l_quantity) as pctile
    from lineitem""")
def percentile_of_repeated_values(spark, sf):
    """Few distinct values: a hot value is counted before it is ranked."""
    return value_percentiles(table(spark, sf, "lineitem"), [], "l_quantity")


@query("""
    select event_type, min(value) filter (p >= 0.25) as p25, min(value) filter (p >= 0.5) as p50,
           min(value) filter (p >= 0.75) as p75
    from (select event_type, value, percent_rank() over (partition by event_type order by value) as p from events)
    group by 1""")
def rank_quantiles_by_type(spark, sf):
    shares = {"p25": 0.25, "p50": 0.50, "p75": 0.75}
    return rank_quantiles(table(spark, sf, "events"), ["event_type"], "value", shares)


@query("""
    select min(l_extendedprice) filter (p >= 0.1) as p10, min(l_extendedprice) filter (p >= 0.9) as p90
    from (select l_extendedprice, percent_rank() over (order by l_extendedprice) as p from lineitem)""")
def rank_quantiles_global(spark, sf):
    return rank_quantiles(table(spark, sf, "lineitem"), [], "l_extendedprice", {"p10": 0.1, "p90": 0.9})


@query("""
    select l_shipdate::date as d, l_orderkey, l_linenumber, l_quantity,
           (coalesce(sum(l_quantity::bigint) over (partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
                     rows between unbounded preceding and 1 preceding), 0))::bigint as quantity_before
    from lineitem""")
def running_quantity(spark, sf):
    """Running totals of three hot keys: each key is spread over many partitions."""
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", *keys)
    ran = running_before(lines, ["l_returnflag"], keys, c("l_quantity").cast("bigint"), "quantity_before")
    return ran.select(
        day("l_shipdate").alias("d"), "l_orderkey", "l_linenumber", "l_quantity", "quantity_before"
    )


@query("""
    select l_orderkey, l_linenumber, nullif(l_returnflag, 'A') as flag,
           coalesce(sum(l_extendedprice::decimal(12,2)) over (
               partition by nullif(l_returnflag, 'A')
               order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
               rows between unbounded preceding and 1 preceding), 0)::double as before
    from lineitem""")
def running_amount(spark, sf):
    """Decimal running totals; one key is null."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf, "lineitem").select(*order, F.nullif(c("l_returnflag"), F.lit("A")).alias("flag"))
    ran = running_before(lines, ["flag"], order, c("l_extendedprice").cast("decimal(12,2)"), "before")
    return ran.select("l_orderkey", "l_linenumber", "flag", c("before").cast("double").alias("before"))


@query("""
    select event_id, nullif(event_type, 'click') as kind, value,
           percent_rank() over (partition by nullif(event_type, 'click') order by value) as pctile,
           count(*) over (partition by nullif(event_type, 'click')) as n_obs
    from events""")
def percentile_null_key(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.nullif(c("event_type"), F.lit("click")).alias("kind"), "value"
    )
    return with_percentile(events, ["kind"], "value")


_DAILY = """(select o_orderpriority, (o_orderdate::date - date '1995-01-01')::int as n,
                   sum(o_totalprice::decimal(12,2))::double as v from orders group by all)"""


def _daily_revenue(spark, sf):
    n = F.datediff(day("o_orderdate"), F.lit("1995-01-01").cast("date"))
    return (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority", n.alias("n"))
        .agg(money(F.sum(cents("o_totalprice"))).cast("double").alias("v"))
    )


_TROUGHS = f"""
    with hit as (
        select * from {_DAILY}
        window f as (partition by o_orderpriority order by n rows between 5 preceding and 5 following)
        qualify v = min(v) over f and count(*) over f = 11),
    kept as (select * from hit qualify coalesce(n - lag(n) over (partition by o_orderpriority order by n) > 7, true))"""


@query(_TROUGHS + " select o_orderpriority, n, v from kept")
def local_minima_daily(spark, sf):
    return local_minima(_daily_revenue(spark, sf), ["o_orderpriority"], "n", "v", 5, 7)


@query(_TROUGHS + """
    select o_orderpriority, n, v, lag(n) over w as previous, n - lag(n) over w as gap
    from kept window w as (partition by o_orderpriority order by n)""")
def trough_intervals_daily(spark, sf):
    kept = local_minima(_daily_revenue(spark, sf), ["o_orderpriority"], "n", "v", 5, 7, keep_slice=True)
    return intervals(kept, ["o_orderpriority"], "n", "previous", "gap")


@query("""
    select l_returnflag, n, v from (
        select l_returnflag, (l_shipdate::date - date '1995-01-01')::int as n, sum(l_quantity::bigint)::bigint as v
        from lineitem group by all)
    window f as (partition by l_returnflag order by n rows between 60 preceding and 60 following)
    qualify v = min(v) over f and count(*) over f = 121""")
def wide_minima_daily(spark, sf):
    """Minima of 60 rows to either side."""
    n = F.datediff(day("l_shipdate"), F.lit("1995-01-01").cast("date")).alias("n")
    daily = table(spark, sf, "lineitem").groupBy("l_returnflag", n).agg(F.sum(c("l_quantity").cast("bigint")).alias("v"))
    return local_minima(daily, ["l_returnflag"], "n", "v", 60)


@query("""
    with r as (
        select l_returnflag, v, percent_rank() over (partition by l_returnflag order by v) as p
        from (select l_returnflag, (l_quantity::decimal(12,2) / 8)::decimal(12,1) as v from lineitem))
    select l_returnflag, min(v) filter (p >= 0.05)::double as p5, min(v) filter (p >= 0.5)::double as p50,
           min(v) filter (p >= 1)::double as p100
    from r group by 1""")
def rank_quantiles_of_ties(spark, sf):
    """Decimals of which each stands for very many rows."""
    v = (c("l_quantity").cast("decimal(12,2)") / 8).cast("decimal(12,1)").alias("v")
    shares = {"p5": 0.05, "p50": 0.5, "p100": 1.0}
    return _plain(rank_quantiles(table(spark, sf, "lineitem").select("l_returnflag", v), ["l_returnflag"], "v", shares))


@query("""
    with prices as (
        select l_linestatus as status, l_shipdate::date as priced_on, max(l_extendedprice) as price from lineitem
        where (l_shipdate::date - date '1995-01-01')::int % 3 = 0 group by all)
    select o_orderkey, status_of as status, ordered_on, priced_on, price
    from (select o_orderkey, nullif(o_orderstatus, 'P') as status_of, o_orderdate::date as ordered_on from orders) o
    asof left join prices p on o.status_of = p.status and o.ordered_on >= p.priced_on""")
def orders_asof_prices(spark, sf):
    """Orders with the newest price of their status; two statuses hold nearly all rows, one is null."""
    shipped = day("l_shipdate")
    prices = table(spark, sf, "lineitem").where(F.datediff(shipped, F.lit("1995-01-01").cast("date")) % 3 == 0)
    prices = prices.select(c("l_linestatus").alias("status"), shipped.alias("priced_on"), c("l_extendedprice").alias("price"))
    newest = prices.groupBy("status", "priced_on").agg(F.max("price").alias("price"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(c("o_orderstatus"), F.lit("P")).alias("status"), day("o_orderdate").alias("ordered_on")
    )
    return asof_join(orders, newest, ["status"], "ordered_on", "priced_on", ["priced_on", "price"])


@query("""
    with promotions as (
        select p_partkey, timestamp '2024-01-01' + to_minutes((p_partkey * 37 % 43200)::int) as starts,
               if(p_partkey % 500 = 0, null, timestamp '2024-01-01' + to_minutes((p_partkey * 37 % 43200)::int + p_size)) as ends
        from part)
    select event_id, p_partkey from events join promotions on ts >= starts and (ends is null or ts <= ends)""")
def events_in_promotions(spark, sf):
    """Events against dated promotions, some without an end; the two have no column in common."""

    def after(minutes) -> Column:
        return F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))

    first = c("p_partkey") * 37 % 43200
    promotions = table(spark, sf, "part").select(
        "p_partkey", after(first).alias("starts"), F.when(c("p_partkey") % 500 != 0, after(first + c("p_size"))).alias("ends")
    )
    events = table(spark, sf, "events").select("event_id", "ts")
    return interval_join(events, promotions, "ts", "starts", "ends").select("event_id", "p_partkey")


@query(f"""
    select o_orderpriority, n, v, lag(v, 5) over (partition by o_orderpriority order by n) as v_5_rows_ago from {_DAILY}""")
def lag_five_rows(spark, sf):
    return with_lag(_daily_revenue(spark, sf), ["o_orderpriority"], "n", {"v_5_rows_ago": "v"}, 5)


@query("""
    select l_shipdate::date as d, sum(l_extendedprice::decimal(12,2))::double as revenue,
           sum(l_extendedprice::decimal(12,2))::double / sum(l_quantity) as per_unit
    from lineitem group by 1""")
def deflated_series(spark, sf):
    lines = table(spark, sf, "lineitem")
    revenue = lines.groupBy(day("l_shipdate").alias("d")).agg(
        money(F.sum(cents("l_extendedprice"))).cast("double").alias("revenue")
    )
    units = lines.groupBy(day("l_shipdate").alias("d")).agg(F.sum("l_quantity").alias("units"))
    return deflate(revenue, units, ["d"], "revenue", "units", "per_unit").drop("units")


# -- periods, shares, dated rows -----------------------------------------------------------

_RATES = [
    ("R", "fixed", "1.5", "1995-01-01", "1998-06-30", ""),
    ("R", "fixed", "2.0", "1998-07-01", "", ""),
    ("A", "flexible", "3.0", "1997-01-01", "2999-12-31", ""),
]


@query("""
    select l_returnflag, rate::double as rate, count(*) as n, sum(l_quantity) as quantity
    from lineitem left join (values ('R', 1.5, date '1995-01-01', date '1998-06-30'), ('R', 2.0, date '1998-07-01', date '2999-12-31'),
                                    ('A', 3.0, date '1997-01-01', date '2999-12-31')) r(flag, rate, f, u)
         on l_returnflag = flag and l_shipdate::date between f and u
    group by all""")
def effective_dated_rates(spark, sf):
    seed = literal_rows(spark, feeds.SEEDS["budget_targets"], _RATES)
    lake = feeds.lake(spark, sf)
    lake._seeds["budget_targets"] = seed
    rates = budget_targets(lake).withColumnRenamed("category_group", "l_returnflag")
    lines = table(spark, sf, "lineitem").withColumn("shipped", day("l_shipdate"))
    return (
        effective_for_facts(lines, rates, ["l_returnflag"], "shipped")
        .groupBy("l_returnflag", c("monthly_target").cast("double").alias("rate"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    )


@query(f"""
    with b as (select p_brand, p_type, sum(p_retailprice::decimal(12,2)) as v from part group by all)
    select p_brand, p_type, v::double as v, {oracle.pct('v', '(select sum(v) from b)', 1)} as share_pct from b""")
def brand_share_of_total(spark, sf):
    brands = table(spark, sf, "part").groupBy("p_brand", "p_type").agg(money(F.sum(cents("p_retailprice"))).alias("v"))
    return _plain(share_of_total(brands, "v", "share_pct"))


# -- history, increments, snapshots --------------------------------------------------------


def _status_at(spark, sf, until: str) -> DataFrame:
    """Each customer's newest order status up to a date."""
    orders = table(spark, sf, "orders").where(day("o_orderdate") <= F.lit(until).cast("date"))
    newest = latest_by(
        orders.select(c("o_custkey").alias("lead_id"), c("o_orderstatus").alias("status"), "o_orderdate", "o_orderkey"),
        ["lead_id"],
        ["o_orderdate", "o_orderkey"],
    )
    return newest.select("lead_id", F.nullif("status", F.lit("P")).alias("status"))


_BATCHES = ("1997-12-31", "1999-12-31", "2001-08-01")


def _history(spark, sf) -> DataFrame:
    first, *later = _BATCHES
    history = first_history(_status_at(spark, sf, first), F.lit(first))
    for batch in later:
        history = scd2_merge(history, _status_at(spark, sf, batch), ["lead_id"], ["status"], F.lit(batch))
    return history.select(
        "lead_id", "status", c("valid_from").cast("date").alias("valid_from"), c("valid_to").cast("date").alias("valid_to")
    )


_HISTORY_SQL = """
    with seen as (
        select batch, o_custkey as lead_id, nullif(arg_max(o_orderstatus, (o_orderdate, o_orderkey)), 'P') as status
        from orders join (values (date '1997-12-31'), (date '1999-12-31'), (date '2001-08-01')) b(batch) on o_orderdate::date <= batch
        group by all),
    starts as (
        select * from seen
        qualify row_number() over w = 1 or status is distinct from lag(status) over w
        window w as (partition by lead_id order by batch)),
    scd as (select lead_id, status, batch as valid_from, lead(batch) over (partition by lead_id order by batch) as valid_to from starts)"""
_HISTORY_SQL = _HISTORY_SQL.replace(
    """qualify row_number() over w = 1 or status is distinct from lag(status) over w
        window w as (partition by lead_id order by batch)""",
    """window w as (partition by lead_id order by batch)
        qualify row_number() over w = 1 or status is distinct from lag(status) over w""",
)


@query(_HISTORY_SQL + " select * from scd")
def scd2_status_history(spark, sf):
    return _history(spark, sf)


@query(_HISTORY_SQL + " select * from scd")
def stored_status_history(spark, sf):
    """The same history as a table in parts below the session's warehouse, one run per batch."""
    name = f"status_history_{uuid.uuid4().hex}"
    for batch in _BATCHES:
        update_history(_status_at(spark, sf, batch), name, ["lead_id"], ["status"], F.lit(batch))
    history = cut_lineage(
        read_history(spark, name).select(
            "lead_id", "status", c("valid_from").cast("date").alias("valid_from"), c("valid_to").cast("date").alias("valid_to")
        )
    )
    spark.sql(f"drop table silver.{name}")
    return history


@query(_HISTORY_SQL + " select status, count(*) as leads from scd where valid_to is null group by 1 order by 2 desc, 1 nulls last limit 10")
def scd2_open_status_counts(spark, sf):
    return lead_status_counts(_history(spark, sf))


@query("select event_id, if(event_type = 'error', null, ts::date) as d, event_type from events")
def incremental_append(spark, sf):
    """A second, overlapping batch by cursor and key: late rows and such without a cursor arrive,
    what is there already adds nothing."""
    events = table(spark, sf, "events").select(
        "event_id", F.when(c("event_type") != "error", c("ts")).alias("ts"), "event_type"
    )
    late = c("event_id") % 7 == 0
    landed = events.where((c("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & ~late)
    batch = events.unionByName(events.where(late))
    grown = landed.unionByName(new_rows(landed, batch, ["event_id"], cursor="ts"))
    return grown.select("event_id", day("ts").alias("d"), "event_type")


@query("""
    select * from (
        select o_orderdate::date as snapshot_date, round(sum(o_totalprice::decimal(12,2)))::double as total, count(*) as n
        from orders group by 1) order by 1 desc limit 30""")
def daily_snapshot_append(spark, sf):
    """Daily rows added once per date: the re-run half brings no second row."""
    daily = (
        table(spark, sf, "orders")
        .groupBy(day("o_orderdate").alias("snapshot_date"))
        .agg(F.round(money(F.sum(cents("o_totalprice")))).cast("double").alias("total"), F.count(F.lit(1)).alias("n"))
    )
    taken = daily.where(c("snapshot_date") < F.lit("1999-01-01").cast("date"))
    again = daily.unionByName(taken.withColumn("n", F.lit(-1).cast("bigint")))
    return recent_snapshots(taken.unionByName(new_rows(taken, again, ["snapshot_date"])), 30)


@query("""
    select * replace (expense::double as expense, income::double as income, w2::double as w2) from int_monthly_totals""")
def monthly_totals_by_change(spark, sf):
    """Two loads below the session's warehouse, the second of late rows, a few new months and rows that
    are there already; monthly sums are brought up after each, and the totals read them. Lines of the
    test tables repeat their ids, hence the number of the copy."""
    name = f"transactions_{uuid.uuid4().hex}"
    lake = feeds.lake(spark, sf)
    rows = lake.source("mm_transactions")
    in_copies = Window.partitionBy("id").orderBy(*[n for n in rows.columns if n != "id"])

    def numbered(found: DataFrame) -> DataFrame:
        return found.withColumn("copy", F.row_number().over(in_copies))

    month = F.trunc("date", "month")
    late = month.isin(date(1997, 3, 1), date(1999, 11, 1)) & (F.pmod(F.xxhash64("id"), F.lit(3)) == 0)
    second, again = F.coalesce(late | (month >= date(2001, 8, 1)), F.lit(False)), month == date(2001, 7, 1)
    # The second load is computed once, and of all rows only those of its ids are put in order for it.
    ids = rows.where(second | again).select("id")
    reload = cut_lineage(numbered(likely_in(rows, ["id"], ids, ["id"], ids.count())).where(second | again))

    def sums(found: DataFrame) -> DataFrame:
        return month_parts(Lake(spark, {"mm_transactions": found}, as_of=AS_OF, settings=SETTINGS))

    for load in (numbered(rows).where(~second), reload):
        append_load(load, "bronze", name, ["id", "copy"], c("date"))
        refresh_months(spark, f"bronze.{name}", "gold", name, sums, c("month"))
    lake.use("int_monthly_parts", cut_lineage(spark.table(f"gold.{name}")))
    for stored in (f"bronze.{name}", f"gold.{name}", f"gold.{name}__loads"):
        spark.sql(f"drop table {stored}")
    return _plain(lake.ref("int_monthly_totals"))


# -- calendar additions --------------------------------------------------------------------


@query("""
    select category, day, total::double as total,
           sum(total) over (w range between interval 6 days preceding and current row)::double as last_7_days,
           sum(total) over (w range between interval 29 days preceding and current row)::double as last_30_days
    from (select category, txn_date as day, sum(expense_amount) as total from int_transactions
          where txn_date is not null and day(txn_date) not in (3, 4, 5, 6, 7, 8, 9, 10) group by 1, 2)
    window w as (partition by category order by day)""")
def rolling_spend(spark, sf):
    """Spend of the last 7 and 30 calendar days by category; the 3rd to 10th of a month have no rows."""
    txns = feeds.lake(spark, sf).ref("int_transactions").where(~F.dayofmonth("txn_date").between(3, 10))
    rows = txns.select("category", c("txn_date").alias("day"), "expense_amount")
    return _plain(rolling_sums(rows, ["category"], "day", "expense_amount", {"last_7_days": 7, "last_30_days": 30}))


@query(f"""
    select day::date as day, year(day)::int as year, quarter(day)::int as quarter, month(day)::int as month,
           weekofyear(day)::int as iso_week, isodow(day)::int as iso_weekday,
           date_trunc('month', day)::date as month_start, last_day(day)::date as month_end, isodow(day) >= 6 as is_weekend,
           coalesce(n, 0) as transactions
    from (select unnest(generate_series((select min(txn_date) from stg_transactions), {oracle.AS_OF}, interval 1 day))::date as day)
    left join (select txn_date, count(*) as n from stg_transactions group by 1) on day = txn_date""")
def dim_date(spark, sf):
    """Every day from the first transaction on, with the number of its transactions."""
    lake = feeds.lake(spark, sf)
    txns = lake.ref("stg_transactions").groupBy(c("txn_date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    first = txns.agg(F.min("day")).head()[0]
    days = date_table(spark, first or AS_OF, AS_OF)
    return days.join(txns, "day", "left").withColumn("transactions", F.coalesce("n", F.lit(0))).drop("n")


@query(f"""
    with sums as (
        select o_custkey, date_trunc('month', o_orderdate)::date as month, sum(o_totalprice::decimal(12,2)) as spent,
               arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as status
        from orders group by 1, 2),
    spine as (
        select o_custkey, unnest(generate_series(min(month), greatest(max(month), date_trunc('month', {oracle.AS_OF})::date), interval 1 month))::date as month
        from sums group by 1)
    select o_custkey, month, coalesce(spent, 0)::double as spent, spent is null as is_filled,
           last_value(status ignore nulls) over (partition by o_custkey order by month) as status
    from spine left join sums using (o_custkey, month)""")
def customer_months_without_gaps(spark, sf):
    """What a customer spent in every month, and the last order's status carried forward."""
    newest = F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey"))
    sums = (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month"))
        .agg(money(F.sum(cents("o_totalprice"))).alias("spent"), newest.alias("status"))
    )
    until = F.trunc(F.lit(AS_OF), "month")
    return _plain(without_gaps(sums, ["o_custkey"], "month", until, flows=["spent"], states=["status"]))


_FORECAST_LAST = date(2002, 2, 28)
_ORDER_STEPS = {"1-urgent": (7, "days"), "2-high": (14, "days"), "3-medium": (1, "months"), "4-not specified": (3, "months")}


@query(f"""
    with steps as (
        select * from (values ('1-URGENT', 7, 0), ('2-HIGH', 14, 0), ('3-MEDIUM', 0, 1), ('4-NOT SPECIFIED', 0, 3)) t(frequency, d, m)),
    dated as (
        select amount, (due_date + (k * d)::int + to_months((k * m)::int))::date as occurs_on
        from stg_recurring join steps using (frequency), range(0, 420) r(k)
        union all
        select amount, due_date from stg_recurring where frequency is null or frequency not in (select frequency from steps))
    select date_trunc('month', occurs_on)::date as month, sum(if(amount > 0, amount, 0))::double as inflow,
           sum(if(amount < 0, -amount, 0))::double as outflow, sum(amount)::double as net, count(*) as items
    from dated where occurs_on > {oracle.AS_OF} and occurs_on <= date '{_FORECAST_LAST}' group by 1""")
def cashflow_forecast(spark, sf):
    """Recurring items that fall due until the end of the third month from now."""
    items = feeds.lake(spark, sf).ref("stg_recurring")
    due = occurrences(items, "due_date", "frequency", AS_OF + timedelta(days=1), _FORECAST_LAST, _ORDER_STEPS)
    amount, zero = c("amount"), F.lit(0).cast("decimal(18,3)")
    return _plain(
        due.groupBy(F.trunc("occurs_on", "month").alias("month")).agg(
            F.sum(F.when(amount > 0, amount).otherwise(zero)).alias("inflow"),
            F.sum(F.when(amount < 0, -amount).otherwise(zero)).alias("outflow"),
            F.sum(amount).alias("net"),
            F.count(F.lit(1)).alias("items"),
        )
    )


# -- data quality --------------------------------------------------------------------------


@query("""
    select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1""")
def dq_unique(spark, sf):
    return quality.not_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select account, name, market_value::double as market_value from stg_holdings where ticker is null")
def dq_not_null(spark, sf):
    holdings = feeds.lake(spark, sf).ref("stg_holdings")
    return _plain(quality.null_rows(holdings, "ticker").select("account", "name", "market_value"))


@query("""
    select event_id, user_id from events
    where user_id not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')""")
def dq_relationships(spark, sf):
    parents = table(spark, sf, "customer").where(c("c_mktsegment") != "BUILDING")
    return quality.orphans(
        table(spark, sf, "events").select("event_id", "user_id"), "user_id", parents, "c_custkey"
    )


@query("""
    select event_type as value_field, count(*) as n_records from events
    where event_type not in ('view', 'click', 'purchase') group by 1""")
def dq_accepted_values(spark, sf):
    return quality.unaccepted(table(spark, sf, "events"), "event_type", ["view", "click", "purchase"])


@query("""
    select 'not_null_touch_id' as "check", count(*) filter (touch_id is null) as failing_rows from stg_touches
    union all select 'not_null_angle', count(*) filter (angle is null) from stg_touches
    union all select 'accepted_values_channel', count(*) filter (channel not in ('call', 'email', 'linkedin')) from stg_touches""")
def dq_table_report(spark, sf):
    touches = feeds.lake(spark, sf).ref("stg_touches")
    return quality.column_report(touches, ["touch_id", "angle"], {"channel": fixed.TOUCH_CHANNELS})


_BUILD_CHECKS = {
    ("stg_leads", "not_null_lead_id"): "select count(*) from stg_leads where lead_id is null",
    ("stg_leads", "unique_lead_id"): "select count(*) from (select 1 from stg_leads where lead_id is not null group by lead_id having count(*) > 1)",
    ("stg_touches", "not_null_touch_id"): "select count(*) from stg_touches where touch_id is null",
    ("stg_touches", "not_null_lead_id"): "select count(*) from stg_touches where lead_id is null",
    ("stg_touches", "accepted_values_channel"): "select count(*) from stg_touches where channel not in ('email', 'call', 'linkedin')",
    ("stg_touches", "unique_touch_id"): "select count(*) from (select 1 from stg_touches where touch_id is not null group by touch_id having count(*) > 1)",
    ("stg_touches", "relationships_lead_id"): "select count(*) from stg_touches t where lead_id is not null and not exists (select 1 from stg_leads l where l.lead_id = t.lead_id)",
    ("stg_holdings", "not_null_ticker"): "select count(*) from stg_holdings where ticker is null",
    ("mart_all_weather", "not_null_box"): "select count(*) from mart_all_weather where box is null",
    ("mart_all_weather", "accepted_values_box"): "select count(*) from mart_all_weather where not regexp_full_match(box, '(rising|falling)_growth_(rising|falling)_inflation')",
    ("mart_all_weather", "unique_box"): "select count(*) from (select 1 from mart_all_weather group by box having count(*) > 1)",
    ("mart_debasement_signals", "not_null_criterion_order"): "select count(*) from mart_debasement_signals where criterion_order is null",
    ("mart_debasement_signals", "unique_criterion_order"): "select count(*) from (select 1 from mart_debasement_signals group by criterion_order having count(*) > 1)",
}


@query(
    " union all ".join(
        f"select '{model}' as model, '{check}' as \"check\", ({count}) as failing_rows"
        for (model, check), count in _BUILD_CHECKS.items()
    )
)
def dq_build_report(spark, sf):
    """Every check that the build declares, with its number of failing rows."""
    return build_report(feeds.lake(spark, sf).ref)


# -- landing -------------------------------------------------------------------------------


@query("""
    select o_orderkey::varchar as id, 'order "' || o_orderkey || '", ' || o_orderpriority as note, o_orderstatus as status
    from orders""")
def csv_text_scan(spark, sf):
    """Lines of CSV text with quotes and commas within fields."""
    note = F.concat(F.lit('"order ""'), c("o_orderkey"), F.lit('"", '), c("o_orderpriority"), F.lit('"'))
    lines = table(spark, sf, "orders").select(F.concat_ws(",", "o_orderkey", note, "o_orderstatus").alias("value"))
    return csv_lines(lines, ["id", "note", "status"])


#: Rows in a landed file: more rows are more files, which are read side by side.
LANDED_ROWS = 50_000


def _landing(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one for files that a query lands and reads; gone with the session."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


@query("""
    select o_orderkey::varchar as id, 'order "' || o_orderkey || '",' || chr(10) || o_orderpriority as note,
           case when o_orderkey % 5 <> 0 then o_orderstatus end as status
    from orders""")
def csv_file_scan(spark, sf):
    """CSV files with quotes, commas and line breaks within fields, landed and read again as text."""
    note = F.concat(F.lit('order "'), c("o_orderkey"), F.lit('",\n'), c("o_orderpriority"))
    status = F.when(c("o_orderkey") % 5 != 0, c("o_orderstatus"))
    folder = _landing(spark, "csv-files")
    rows = table(spark, sf, "orders").select(c("o_orderkey").cast("string").alias("id"), note.alias("note"), status.alias("status"))
    rows.write.options(header=True, escape='"', maxRecordsPerFile=LANDED_ROWS).csv(folder)
    return read_csv_text(spark, folder, ["id", "note", "status"])


@query("""
    select o_orderkey::varchar as order_id, o_orderpriority as details__priority, o_custkey::varchar as details__customer__id,
           '["' || o_orderstatus || '"]' as tags
    from orders""")
def json_file_scan(spark, sf):
    """Files of JSON lines with objects in objects, landed, read by a schema and flattened to text."""
    customer = F.struct(c("o_custkey").alias("id"))
    details = F.struct(c("o_orderpriority").alias("priority"), customer.alias("customer"), c("o_totalprice").alias("unlisted"))
    folder = _landing(spark, "json-files")
    rows = table(spark, sf, "orders").select(c("o_orderkey").alias("orderId"), details.alias("details"), F.array("o_orderstatus").alias("tags"))
    rows.write.option("maxRecordsPerFile", LANDED_ROWS).json(folder)
    schema = "orderId bigint, details struct<priority:string,customer:struct<id:bigint>>, tags array<string>"
    return flatten(read_records(spark, folder, schema, json_lines=True))


@query("select (props->>'$.k')::int as k from events")
def json_record_scan(spark, sf):
    return json_records(table(spark, sf, "events"), "k int", "props")


@query("select (props->>'$.k') as k, null::varchar as absent from events")
def fixed_field_scan(spark, sf):
    """Listed fields as text; one that no record has is a null column."""
    return fixed_records(table(spark, sf, "events"), ["k", "absent"], "props")


@query("select o_orderkey::varchar as id from orders")
def field_whitelist(spark, sf):
    """Fields that aren't listed are not parsed."""
    record = F.to_json(F.struct(c("o_orderkey").alias("id"), c("o_orderpriority").alias("secret"), "o_totalprice"))
    return fixed_records(table(spark, sf, "orders").select(record.alias("value")), ["id"])


@query("""
    select event_id::varchar as event_id, event_type, (props->>'$.k') as props__k, '["' || event_type || '"]' as tags
    from events""")
def flatten_nested(spark, sf):
    nested = table(spark, sf, "events").select(
        c("event_id").alias("eventId"),
        c("event_type").alias("eventType"),
        F.from_json("props", "struct<k: int>").alias("props"),
        F.array("event_type").alias("tags"),
        F.array("value").alias("attachments"),
    )
    return flatten(nested, drop=["attachments"])


@query("""
    select if(p_size <= 20, 'Active Investing', 'ROTH IRA') as account, p_partkey::varchar as account_id,
           p_brand as ticker, p_name as name, lower(p_type) as security_type, p_retailprice as market_value
    from part where p_size <= 35""")
def explode_with_fallback(spark, sf):
    """Promo parts have an unmatched security; ticker and type come from the position."""
    unmatched = c("p_type") == "PROMO"
    node = F.struct(
        F.struct(
            F.when(~unmatched, c("p_brand")).alias("ticker"),
            c("p_name").alias("name"),
            F.when(~unmatched, F.lower("p_type")).alias("type"),
            F.lit(None).cast("string").alias("typeDisplay"),
        ).alias("security"),
        F.array(
            F.struct(c("p_brand").alias("ticker"), c("p_name").alias("name"), F.lower("p_type").alias("type"))
        ).alias("holdings"),
        c("p_retailprice").alias("totalValue"),
        c("p_size").alias("quantity"),
        c("p_retailprice").alias("basis"),
        F.lit(0.0).alias("securityPriceChangePercent"),
    )
    accounts = table(spark, sf, "part").select(
        c("p_partkey").cast("string").alias("id"),
        F.when(c("p_size") <= 20, "Active Investing").when(c("p_size") <= 35, "ROTH IRA").otherwise("Joint").alias("displayName"),
        F.struct(F.when(c("p_size") <= 35, "Investments").otherwise("Cash").alias("display")).alias("type"),
        F.struct(
            F.struct(F.array(F.struct(node.alias("node"))).alias("edges")).alias("aggregateHoldings")
        ).alias("portfolio"),
    )
    return explode_holdings(accounts).select(
        "account", "account_id", "ticker", "name", "security_type", "market_value"
    )


@query("""
    select 'USA' as entity, year(o_orderdate)::int as year, month(o_orderdate)::int as period,
           unnest(['price', 'dividend']) as series, unnest([sum(o_totalprice::decimal(12,2))::double, count(*)::double]) as value
    from orders group by 2, 3""")
def unpivot_monthly_sheet(spark, sf):
    """Wide sheet with YYYY.MM dates; October is written YYYY.1."""
    stamp = F.concat(F.year("o_orderdate").cast("string"), F.lit("."), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"))
    wide = (
        table(spark, sf, "orders")
        .groupBy(F.regexp_replace(stamp, r"\.10$", ".1").alias("Date"))
        .agg(
            money(F.sum(cents("o_totalprice"))).cast("string").alias("P"),
            F.count(F.lit(1)).cast("string").alias("D"),
        )
        .withColumn("CAPE", F.lit("NA"))
    )
    return monthly_equity_history(wide)


@query("""
    select n_name as entity, year(o_orderdate)::int as year, 0 as period, unnest(['nominal_gdp', 'total_loans']) as series,
           unnest([sum(o_totalprice::decimal(12,2))::double, count(*) filter (o_orderstatus = 'F')::double]) as value
    from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey group by 1, 2""")
def unpivot_country_panel(spark, sf):
    panel = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), c("o_custkey") == c("c_custkey"))
        .join(table(spark, sf, "nation"), c("n_nationkey") == c("c_nationkey"))
        .groupBy(c("n_name").alias("country"), F.year("o_orderdate").alias("year"))
        .agg(
            money(F.sum(cents("o_totalprice"))).alias("gdp"),
            F.count_if(c("o_orderstatus") == "F").alias("tloans"),
            F.lit(None).cast("double").alias("ltrate"),
        )
    )
    return country_panel(panel)


@query("""
    select 'GBR' as entity, year(o_orderdate)::int as year, 0 as period, 'cpi' as series, count(*)::double as value
    from orders group by 2""")
def header_checked_unpivot(spark, sf):
    """Two data columns, one of which moved: the moved one is refused."""
    data = (
        table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").alias("y"))
        .agg(F.count(F.lit(1)).alias("a"), money(F.sum(cents("o_totalprice"))).alias("b"))
        .select(F.lit(1).alias("__block"), *[c(n).cast("string").alias(n) for n in ("y", "a", "b")])
    )
    heading = literal_rows(
        spark, ["__block", "y", "a", "b"], [(0, "Description", "Consumer price index (2015=100)", "Unemployment rate")]
    )
    sheet = heading.unionByName(data).orderBy("__block").drop("__block")
    positions = {1: ("cpi", "Consumer price index"), 2: ("bank_rate", "Bank Rate")}
    return positional_history(sheet, description_row=0, columns=positions)


@query("""
    select 'GBR' as entity, o_custkey::int as year, 0 as period, 'cpi' as series, count(*)::double as value
    from orders group by 2""")
def sheet_files_unpivot(spark, sf):
    """A sheet of many files: the headings stand in one that is named, wherever Spark reads it among the others."""
    folder = _landing(spark, "sheet")
    heading = ("Description", "Consumer price index (2015=100)", "Unemployment rate")
    literal_rows(spark, ["y", "a", "b"], [("Title", "", ""), heading]).coalesce(1).write.csv(f"{folder}/headings")
    data = table(spark, sf, "orders").groupBy(c("o_custkey").alias("y")).agg(F.count(F.lit(1)).alias("a"), F.min("o_orderkey").alias("b"))
    data.write.option("maxRecordsPerFile", LANDED_ROWS).csv(f"{folder}/rows")
    sheet = spark.read.schema("y string, a string, b string").csv([f"{folder}/rows", f"{folder}/headings"])
    positions = {1: ("cpi", "Consumer price index"), 2: ("bank_rate", "Bank Rate")}
    return positional_history(sheet, 1, positions, headings=sheet_headings(spark, f"{folder}/headings", 2))


@query("""
    select event_type as series, event_id::varchar as series_id, ts::date::varchar as obs_date, value::varchar as obs_value
    from events where value >= 1""")
def sentinel_drop(spark, sf):
    """Values below one arrive as the missing mark or empty, and are dropped."""
    small = c("value") < 1
    raw = table(spark, sf, "events").select(
        c("event_type").alias("series"),
        c("event_id").cast("string").alias("series_id"),
        day("ts").cast("string").alias("date"),
        F.when(small & (c("value") < 0.5), ".").when(small, "").otherwise(c("value").cast("string")).alias("value"),
    )
    return macro_observations(raw)


_KEEP_DAYS = {"cpi": 800, "vix": 200, "house_prices": 60000}


@query(f"""
    select series, obs_date, value from stg_fred
    join (values ('cpi', 800), ('vix', 200), ('house_prices', 60000)) k(series, days) using (series)
    where obs_date >= {oracle.AS_OF} - days""")
def series_lookback(spark, sf):
    obs = feeds.lake(spark, sf).ref("stg_fred")
    return within_lookback(obs, F.lit(AS_OF), _KEEP_DAYS).select("series", "obs_date", "value")


@query(f"""
    select transaction_id, txn_date, amount::double as amount from stg_transactions
    where txn_date between {oracle.AS_OF} - 400 and {oracle.AS_OF}""")
def transaction_lookback(spark, sf):
    txns = feeds.lake(spark, sf).ref("stg_transactions").select("transaction_id", "txn_date", "amount")
    return _plain(recent_transactions_window(txns, F.lit(AS_OF), "txn_date"))


# -- funnel straight on the event table ------------------------------------------------------


@query(f"""
    select event_type, count(distinct user_id) as users, count(*) as n, {oracle.pct('count(*)', '(select count(*) from events)', 1)} as share_pct
    from events group by 1""")
def funnel_by_type(spark, sf):
    by_type = (
        table(spark, sf, "events")
        .groupBy("event_type")
        .agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("n"))
    )
    total = by_type.agg(F.sum("n").alias("total"))
    return by_type.crossJoin(F.broadcast(total)).select(
        "event_type", "users", "n", percent(c("n"), c("total"), 1).alias("share_pct")
    )
