"""The same results written for DuckDB, straight on the driver's tables.

PARTS holds named subqueries; oracle(name) puts the ones a query mentions, directly or
not, in front of it as CTEs. Results are doubles, bigints, dates and text, as in Spark.
"""

from __future__ import annotations

import re

from checks import feeds
from ledgerlake import fixed_values as fixed

AS_OF = f"date '{feeds.AS_OF}'"
MONTH = "date '2001-11-01'"
PRIOR3 = "date '2001-08-01'"


def values(rows, columns) -> str:
    def lit(v):
        if v is None:
            return "null"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"{v!r}::double" if isinstance(v, float) else str(v)

    body = ",\n".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"select * from (values {body}) v({', '.join(columns)})"


def pct(part: str, whole: str, digits: int) -> str:
    return f"round(({part} * 100)::double / nullif(({whole})::double, 0), {digits})"


def level(expr: str, lowest: str) -> str:
    return (
        f"case when {expr} >= 0.9 then 'extreme' when {expr} >= 0.7 then 'elevated' "
        f"when {expr} >= 0.3 then 'normal' else '{lowest}' end"
    )


_cells = [
    (name, "ID_" + name.upper(), priority, status)
    for name, priority, wanted in feeds.MACRO_CELLS
    for status in (feeds.STATUSES if wanted == "*" else (wanted,))
]

PARTS: dict[str, str] = {
    # -- silver ---------------------------------------------------------------------------
    "stg_transactions": """
        select l_orderkey || '-' || l_linenumber as transaction_id, l_shipdate::date as txn_date,
               (case when (n_regionkey = 1) <> (l_returnflag = 'R') then 1 else -1 end
                * (l_extendedprice::decimal(12,2) * (1 - l_discount::decimal(4,2)))::decimal(18,3))::decimal(18,3) as amount,
               n_name as category, s_nationkey::varchar as category_id, s_name as merchant,
               'Ledger ' || l_linestatus as account, l_linestatus as account_id,
               l_returnflag = 'A' as is_recurring, l_linestatus = 'O' as pending,
               l_tax::decimal(4,2) = 0.08 as hide_from_reports
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""",
    "stg_categories": """
        select n_nationkey::varchar as category_id, n_name as category,
               r_name || if(n_nationkey < 10, ' core', ' other') as category_group,
               case r_name when 'AMERICA' then 'income' when 'MIDDLE EAST' then 'transfer' else 'expense' end as group_type
        from nation join region on n_regionkey = r_regionkey where n_name <> 'NATION_23'""",
    "stg_accounts": """
        select c_custkey::varchar as account_id, c_mktsegment || ' ' || c_name as account,
               c_acctbal::decimal(18,3) as current_balance,
               case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'Cash'
                    when c_mktsegment = 'AUTOMOBILE' then 'Investments'
                    when c_mktsegment = 'HOUSEHOLD' then if(c_acctbal < 0, 'Loans', 'Credit Cards')
                    else 'Vehicle' end as account_type,
               c_acctbal >= 0 as is_asset,
               not (c_mktsegment = 'MACHINERY' and c_nationkey = 3) as include_in_net_worth,
               'Bank ' || c_nationkey as institution
        from customer""",
    "stg_recurring": """
        select o_orderdate::date + 120 as due_date,
               (if(o_orderstatus = 'P', 1, -1) * o_totalprice::decimal(12,2))::decimal(18,3) as amount,
               o_orderpriority as frequency, 'Payee ' || o_custkey as merchant,
               o_orderstatus as category, 'Ledger ' || o_orderkey as account
        from orders""",
    "stg_networth": """
        select o_orderdate::date as snapshot_date, sum(o_totalprice::decimal(12,2))::decimal(18,3) as net_worth
        from orders group by all""",
    "security_map": values(feeds.SECURITY_MAP, ["ticker", "region", "asset_class", "sleeve"]),
    "holdings_landed": """
        select case when p_size <= 20 then 'Active Investing' when p_size <= 35 then 'ROTH IRA' else 'Joint' end as account,
               if(p_type = 'PROMO' and p_size = 50, null, p_brand) as ticker, p_name as name,
               case when p_type in ('LARGE', 'MEDIUM') then 'equity' when p_type = 'SMALL' then 'bond'
                    when p_type = 'ECONOMY' then 'cash' when p_type = 'STANDARD' then 'commodity' else 'etf' end as security_type,
               (p_retailprice::decimal(12,2) * p_size)::decimal(18,3) as market_value,
               (p_retailprice::decimal(12,2) - 950)::decimal(18,3) as change_pct
        from part""",
    "stg_holdings": """
        select account, ticker, name, coalesce(region, 'US') as region,
               coalesce(asset_class, security_type) as asset_class, coalesce(sleeve, 'standard') as sleeve,
               market_value, change_pct
        from holdings_landed left join security_map using (ticker)""",
    "macro_cells": values(_cells, ["series", "series_id", "o_orderpriority", "o_orderstatus"]),
    "stg_fred": """
        select series, series_id, o_orderdate::date as obs_date,
               (sum(o_totalprice::decimal(12,2)) * 0.0002::decimal(4,4))::decimal(28,4)::double as value
        from orders join macro_cells using (o_orderpriority, o_orderstatus) group by all""",
    "jst_wide": """
        select n_name as entity, ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) + 1869)::int as year,
               sum(o_totalprice::decimal(12,2))::double as total, count(*)::double as n,
               sum(o_totalprice::decimal(12,2)) filter (o_orderstatus <> 'P')::double as opened,
               count(*) filter (o_orderpriority = '1-URGENT')::double as urgent
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all""",
    "stg_lh_jst": """
        select entity, year, 0 as period, series, value from (
            select entity, year, unnest(['house_prices_nominal', 'cpi', 'nominal_gdp', 'total_loans', 'public_debt_to_gdp']) as series,
                   unnest([total, n, total, opened, urgent]) as value from jst_wide)""",
    "stg_lh_shiller": """
        select 'USA' as entity, year, period, unnest(['cape', 'price', 'cpi']) as series,
               unnest([total / n / 10000, total, n]) as value
        from (select year(o_orderdate)::int as year, month(o_orderdate)::int as period,
                     sum(o_totalprice::decimal(12,2))::double as total, count(*)::double as n from orders group by all)""",
    "stg_lh_boe": """
        select 'GBR' as entity, year, 0 as period, unnest(['public_debt', 'bank_rate']) as series, unnest([total, n]) as value
        from (select year(o_orderdate)::int as year, sum(o_totalprice::decimal(12,2))::double as total,
                     count(*)::double as n from orders group by all)""",
    "stg_stripe_charges": """
        select 'ch_' || o_orderkey as charge_id, o_totalprice::decimal(12,2)::decimal(18,5) as amount,
               if(o_orderstatus = 'P', ((o_totalprice::decimal(12,2) * 100)::bigint // 2) * 0.01::decimal(3,2), 0)::decimal(18,5) as amount_refunded,
               'usd' as currency, o_orderdate::date + 60 as created_date,
               if(o_orderpriority = '4-NOT SPECIFIED', 'failed', 'succeeded') as status,
               o_orderpriority <> '4-NOT SPECIFIED' as paid, o_orderstatus = 'P' as refunded,
               o_orderpriority as description, 'cus_' || o_custkey as customer_id,
               if(o_orderstatus = 'P', 'in_' || o_orderkey, null) as invoice_id, o_orderpriority <> '5-LOW' as livemode
        from orders""",
    "stg_stripe_customers": """
        select 'cus_' || c_custkey as customer_id, lower(replace(c_name, '#', '.')) || '@example.test' as email,
               if(c_mktsegment = 'HOUSEHOLD', null, c_name) as name, date '2000-01-01' + c_nationkey as created_date,
               c_mktsegment <> 'FURNITURE' as livemode
        from customer""",
    "stg_stripe_subscriptions": """
        select 'sub_' || c_custkey as subscription_id,
               if(c_mktsegment in ('BUILDING', 'AUTOMOBILE'), 'active', 'canceled') as status,
               'cus_' || c_custkey as customer_id, date '2000-01-01' + c_nationkey as created_date,
               c_acctbal < 0 as cancel_at_period_end, c_mktsegment <> 'FURNITURE' as livemode
        from customer""",
    "stg_leads": """
        select c_custkey::int as lead_id, c_name as name, c_mktsegment || ' practice' as practice_name,
               c_mktsegment as specialty, 'City ' || c_nationkey as city, 'S' || c_nationkey as state,
               'https://' || c_custkey || '.example' as website, 'lead.' || c_custkey || '@example.test' as email,
               null::varchar as linkedin_url, null::varchar as community_platform, lower(c_mktsegment) as status,
               'registry' as source,
               case when c_nationkey < 8 then 'A' when c_nationkey < 16 then 'B' when c_nationkey < 22 then 'C' end as angle_assigned,
               null::varchar as cohort, c_mktsegment as segment, 'personal' as contact_type,
               'blog, newsletter' as content_signals, null::varchar as audience_size_estimate,
               'note, line one' || chr(13) || chr(10) || 'line two for ' || c_name as notes,
               c_acctbal > 0 as has_team, if(c_nationkey > 12, true, null) as operator_visible,
               if(c_mktsegment = 'BUILDING', 'personal', 'N') as email_list,
               case c_mktsegment when 'BUILDING' then true when 'HOUSEHOLD' then true when 'FURNITURE' then false end as linkedin_active,
               date '2001-01-01' + c_nationkey as found_date,
               if(c_nationkey = 4, null, date '2001-01-31' + c_nationkey) as last_touch_date,
               if(c_nationkey = 7, null, date '2001-03-02' + c_nationkey) as next_action_date
        from customer""",
    "stg_touches": """
        select event_id::varchar as touch_id, user_id::int as lead_id, ts::date as touch_date,
               case when event_type in ('view', 'click') then 'email' when event_type = 'purchase' then 'call' else 'linkedin' end as channel,
               k as touch_number, case when k < 33 then 'A' when k < 66 then 'B' when k < 95 then 'C' end as angle,
               'About ' || event_type as subject_line,
               case event_type when 'purchase' then true when 'error' then null else false end as replied,
               if(event_type = 'purchase', 'positive', null) as reply_sentiment,
               if(value > 20, 'budget', null) as objection_tag, props as notes,
               event_type in ('purchase', 'click') as opened
        from (select *, (props->>'$.k')::int as k from events)""",
    # -- outreach -------------------------------------------------------------------------
    "fact_touch": """
        select touch_id, lead_id, touch_date, channel, angle, touch_number, reply_sentiment, objection_tag,
               coalesce(replied, false)::int as is_reply, coalesce(opened, false)::int as is_open
        from stg_touches""",
    "mart_outreach_funnel": f"""
        select coalesce(angle, 'unassigned') as angle, n as total_touches, o as opens, r as replies,
               {pct('o', 'n', 1)} as open_rate_pct, {pct('r', 'n', 1)} as reply_rate_pct,
               {pct('r', 'o', 1)} as reply_over_open_rate_pct
        from (select angle, count(*) as n, count(*) filter (is_open = 1) as o, count(*) filter (is_reply = 1) as r
              from fact_touch group by angle)""",
    # -- cash-flow ------------------------------------------------------------------------
    "int_transactions": """
        select transaction_id, txn_date, amount, coalesce(k.group_type, 'uncategorized') as group_type,
               coalesce(k.category_group, 'Uncategorized') as category_group, t.category, merchant, account,
               if(k.group_type = 'expense', -amount, 0)::decimal(18,3) as expense_amount,
               if(k.group_type = 'income', amount, 0)::decimal(18,3) as income_amount,
               if(t.category = 'NATION_6' and amount > 0, amount, 0)::decimal(18,3) as w2_income
        from stg_transactions t left join stg_categories k using (category_id)
        where not hide_from_reports and k.group_type is distinct from 'transfer'""",
    "int_monthly_parts": """
        select date_trunc('month', txn_date)::date as month, category_id, category, amount < 0 as outflow, sum(amount) as total
        from stg_transactions where not hide_from_reports group by all""",
    "int_monthly_totals": """
        select date_trunc('month', txn_date)::date as month, category_group,
               group_type = 'expense' and amount < 0 as is_spend,
               sum(expense_amount) as expense, sum(income_amount) as income, sum(w2_income) as w2
        from int_transactions group by all""",
    "month_sums": """
        select date_trunc('month', txn_date)::date as month, sum(income_amount) as inc, sum(w2_income) as w2,
               sum(expense_amount) as exp
        from int_transactions group by 1""",
    "mart_monthly_cashflow": f"""
        select month, round(inc)::double as income, round(w2)::double as w2_income,
               round(inc - w2)::double as other_income, round(exp)::double as spend,
               round(inc - exp)::double as net, {pct('(inc - exp)', 'inc', 0)} as savings_rate_pct
        from month_sums""",
    "mart_spend_by_category": """
        select category_group, date_trunc('month', txn_date)::date as month, round(sum(expense_amount))::double as spend
        from int_transactions where expense_amount > 0 group by 1, 2""",
    "mart_top_merchants": f"""
        select merchant, round(sum(expense_amount))::double as spend, count(*) as txns
        from int_transactions
        where expense_amount > 0 and merchant is not null and txn_date >= {AS_OF} - 30
        group by 1 order by 2 desc, 1 limit 8""",
    "group_spend": f"""
        select category_group, sum(expense_amount) filter (txn_date >= {MONTH}) as mtd,
               sum(expense_amount) filter (txn_date < {MONTH}) as prior
        from int_transactions where txn_date >= {PRIOR3} group by 1""",
    "mart_category_trend": """
        select category_group, round(mtd)::double as this_month, round(coalesce(prior::double / 3, 0)) as avg_3mo,
               round(mtd::double - coalesce(prior::double / 3, 0)) as delta
        from group_spend where mtd > 0""",
    "target_text": values(feeds.BUDGET_TARGETS, ["category_group", "tier", "t", "f", "u", "note"]),
    "targets": """
        select category_group, tier, note, try_cast(t as decimal(18,3)) as target, try_cast(f as date) as since,
               coalesce(try_cast(u as date), date '2999-12-31') as until
        from target_text""",
    "trailing_targets": f"""
        select category_group, sum(target)::double / count(target) as blended
        from targets join (select unnest(generate_series({PRIOR3}, {MONTH} - interval 1 month, interval 1 month))::date as mo)
             on mo between since and until
        group by 1""",
    "mart_budget_vs_actual": f"""
        with x as (
            select g.*, round(target)::double as monthly_target, coalesce(blended, target::double) as tt,
                   coalesce(mtd, 0) as spent, coalesce(prior::double / 3, 0) as average
            from (select * from targets where {MONTH} between since and until) g
            left join trailing_targets using (category_group) left join group_spend using (category_group))
        select category_group, tier, note, monthly_target, round(tt) as target_trailing,
               tt <> target::double as target_changed, round(spent)::double as spend_mtd, round(average) as avg_3mo,
               round(average - tt) as gap_vs_target, 4 as days_elapsed, 30 as days_in_month,
               round(100.0::double * 4 / 30) as mtd_pct_of_month,
               if(tier = 'fixed', null, round((spent * 30)::double / 4)) as projected_month,
               case when average <= tt then 'on_target' when average <= tt * 1.25 then 'over' else 'well_over' end as status
        from x""",
    "newest_months": f"select * from month_sums where month < {MONTH} order by month desc limit 3",
    "month_averages": """
        select coalesce(sum(inc)::double / count(inc), 0) as ai, coalesce(sum(w2)::double / count(w2), 0) as aw,
               coalesce(sum(exp)::double / count(exp), 0) as ae
        from newest_months""",
    "month_to_date": f"""
        select coalesce(sum(expense_amount), 0) as spent, coalesce(sum(income_amount), 0) as earned
        from int_transactions where txn_date >= {MONTH}""",
    "mart_safe_to_spend": f"""
        with t as (select * from targets where {MONTH} between since and until),
        s as (select sum(target) as total, sum(if(tier = 'flexible', target, 0)) as flex from t),
        f as (select coalesce(sum(expense_amount), 0) as fs from int_transactions
              where txn_date >= {MONTH} and category_group in (select category_group from t where tier = 'flexible'))
        select round(ai) as avg_monthly_income, round(aw) as avg_monthly_w2, round(ae) as avg_monthly_spend,
               total::double as total_target, flex::double as flexible_target,
               round(spent)::double as spent_this_month, round(earned)::double as income_this_month,
               round(fs)::double as flexible_spent_this_month, round(flex - fs)::double as flexible_left,
               round(ai - total::double) as target_monthly_savings,
               {pct('(ai - total::double)', 'ai', 0)} as target_savings_rate_pct,
               {pct('(ai - ae)', 'ai', 0)} as actual_savings_rate_pct
        from month_averages, s, month_to_date, f""",
    "safe_to_spend_all_targets": f"""
        with s as (select sum(target) as total, sum(if(tier = 'flexible', target, 0)) as flex from targets),
        f as (select coalesce(sum(expense_amount), 0) as fs
              from int_transactions join targets using (category_group)
              where txn_date >= {MONTH} and tier = 'flexible')
        select round(ai) as avg_monthly_income, round(aw) as avg_monthly_w2, round(ae) as avg_monthly_spend,
               total::double as total_target, flex::double as flexible_target,
               round(spent)::double as spent_this_month, round(earned)::double as income_this_month,
               round(fs)::double as flexible_spent_this_month, round(flex - fs)::double as flexible_left,
               round(ai - total::double) as target_monthly_savings,
               {pct('(ai - total::double)', 'ai', 0)} as target_savings_rate_pct,
               {pct('(ai - ae)', 'ai', 0)} as actual_savings_rate_pct
        from month_averages, s, month_to_date, f""",
    "liquid_cash": """
        select coalesce(sum(current_balance) filter (account_type = 'Cash' and is_asset), 0) as liquid from stg_accounts""",
    "mart_runway": """
        select round(liquid)::double as liquid_savings, round(avg_monthly_spend) as monthly_burn,
               round(liquid::double / nullif(avg_monthly_spend, 0), 1) as runway_months
        from liquid_cash, mart_safe_to_spend""",
    "mart_networth": "select snapshot_date, round(net_worth)::double as net_worth from stg_networth",
    "mart_networth_breakdown": """
        select if(account_type in ('Credit Cards', 'Loans'), 'Debt', account_type) as bucket,
               round(sum(current_balance))::double as balance
        from stg_accounts where include_in_net_worth group by 1""",
    "mart_account_balances": """
        select account, account_type, current_balance::double as current_balance, is_asset, include_in_net_worth
        from stg_accounts""",
    "mart_recurring_summary": """
        select round(sum(abs(amount)))::double as monthly_recurring, count(*) as bills from stg_recurring where amount < 0""",
    # -- portfolio ------------------------------------------------------------------------
    "mart_allocation": f"""
        with e as (select region, sum(market_value) as held from stg_holdings where asset_class = 'equity' group by 1)
        select region, round(held)::double as value, {pct('held', '(select sum(held) from e)', 1)} as pct from e""",
    "mart_positions": f"""
        with a as (select ticker, name, sleeve, market_value as v from stg_holdings where starts_with(account, 'Active')),
        s as (select a.*, (v * 100)::double / (select sum(v) from a)::double as share from a)
        select ticker, name, sleeve, round(v)::double as value, round(share, 1) as pct_of_active,
               case sleeve when 'conviction' then 12 when 'standard' then 7 end as cap_pct,
               coalesce(share > case sleeve when 'conviction' then 12 when 'standard' then 7 end, false) as over_cap
        from s""",
    "mart_portfolio_signals": f"""
        with s as (
            select sum(market_value) as total, sum(market_value) filter (asset_class = 'equity') as eq,
                   sum(market_value) filter (starts_with(account, 'Active')) as act,
                   sum(market_value) filter (asset_class = 'equity' and region = 'US') as us,
                   sum(market_value) filter (asset_class = 'equity' and region = 'Intl') as intl,
                   coalesce(sum(market_value) filter (asset_class = 'bond'), 0) as bond,
                   coalesce(sum(market_value) filter (starts_with(account, 'Active') and ticker = 'Brand#6'), 0) as def,
                   coalesce(sum(market_value) filter (starts_with(account, 'Active') and sleeve = 'dry_powder'), 0) as dry,
                   count(*) filter (starts_with(account, 'Active') and sleeve = 'standard') as n
            from stg_holdings)
        select {pct('us', 'eq', 1)} as us_equity_pct, {pct('intl', 'eq', 1)} as intl_equity_pct,
               {pct('bond', 'total', 1)} as bond_pct, {pct('def', 'act', 1)} as vymi_pct_active,
               {pct('dry', 'act', 1)} as dry_powder_pct, n as standard_positions
        from s""",
    "mart_evidence_bands": f"""
        with eq as (select * from stg_holdings where asset_class = 'equity' and market_value is not null),
        scoped as (
            select 'Combined' as scope, region, market_value from eq
            union all select if(starts_with(account, 'Active'), 'Active', 'Roth'), region, market_value from eq
            where starts_with(account, 'Active') or starts_with(account, 'ROTH')),
        p as (
            select scope, sum(market_value) as held, coalesce(sum(market_value) filter (region = 'US'), 0) as us
            from scoped group by 1 having sum(market_value) > 0),
        q as (select scope, list_position(['Active', 'Roth', 'Combined'], scope)::int as scope_order,
                     round(held)::double as equity_value, {pct('us', 'held', 1)} as us_pct,
                     {pct('(held - us)', 'held', 1)} as intl_pct
              from p)
        select *, 50::double as band_min, 55::double as band_max, 11::double as evidence_min, 55::double as evidence_max,
               us_pct between 50 and 55 as in_alto_band, us_pct between 11 and 55 as in_evidence_zone,
               round(us_pct - 55, 1) as pct_over_ceiling
        from q""",
    "weather_boxes": values(
        fixed.WEATHER_BOXES, ["box", "box_order", "box_label", "growth", "inflation", "wins"]
    ),
    "box_members": values(fixed.BOX_MEMBERS, ["box", "asset_class"]),
    "mart_all_weather": f"""
        with v as (
            select box, sum(market_value) as covered, string_agg(distinct ticker, ', ' order by ticker) as listed,
                   count(distinct ticker) as n
            from stg_holdings join box_members using (asset_class) group by 1),
        t as (select sum(market_value) as total from stg_holdings)
        select box, box_order, box_label, growth, inflation, wins, listed as covering_tickers,
               coalesce(n, 0) as n_assets, round(coalesce(covered, 0))::double as covering_value,
               {pct('coalesce(covered, 0)', 'total', 1)} as covering_pct,
               case when total is null then 'unknown' when coalesce(covered, 0) = 0 then 'none'
                    when (covered * 100)::double / total::double < 6.25 then 'thin' else 'covered' end as coverage,
               box = '{fixed.UNCOVERED_BY_DESIGN}' as by_design,
               if(box = '{fixed.UNCOVERED_BY_DESIGN}', '{fixed.BY_DESIGN_REASON}', null) as by_design_reason
        from weather_boxes left join v using (box), t""",
    "rule_text": values(
        [(k, *v) for k, v in fixed.PORTFOLIO_RULES.items()],
        ["rule", "severity", "area", "title", "detail", "unit"],
    ),
    "rule_values": """
        with p as (
            select count(*) filter (sleeve = 'standard') as ns, count(*) filter (over_cap) as oc,
                   coalesce(sum(pct_of_active::decimal(9,1)) filter (sleeve = 'defensive'), 0)::double as d,
                   coalesce(sum(pct_of_active::decimal(9,1)) filter (sleeve = 'inflation_hedge'), 0)::double as h,
                   coalesce(sum(pct_of_active::decimal(9,1)) filter (sleeve = 'dry_powder'), 0)::double as w, sum(value) as total
            from mart_positions),
        a as (select coalesce(sum(current_balance) filter (starts_with(account, 'MACHINERY')), 0)::double as cash,
                     coalesce(sum(current_balance) filter (starts_with(account, 'FURNITURE')), 0)::double as inv from stg_accounts),
        b as (select us_pct, intl_pct from mart_evidence_bands where scope = 'Active')
        select 'hsa' as rule, cash as cur, 2000.0::double as tgt, cash >= 2000 and inv = 0 as act from a
        union all select 'buffer', liquid::double, round(avg_monthly_spend * 3), liquid::double < avg_monthly_spend * 3
                  from liquid_cash, mart_safe_to_spend
        union all select 'us_ceiling', us_pct, 55, us_pct > 55 from b
        union all select 'intl_floor', intl_pct, 45, intl_pct < 45 from b
        union all select 'standard_count', ns, 7, total < 15000 and ns > 7 from p
        union all select 'over_cap', oc, 0, oc > 0 from p
        union all select 'defensive', d, 30, d not between 25 and 35 from p
        union all select 'hedge', h, 5, h > 5 from p
        union all select 'powder', w, 15, w > 15 from p""",
    "mart_portfolio_actions": """
        select severity, area, title, detail, round(cur, 1) as current_value, round(tgt, 1) as target_value, unit,
               if(act, 'act', 'ok') as status
        from rule_text join rule_values using (rule)""",
    # -- macro ----------------------------------------------------------------------------
    "obs": "select series, obs_date, value from stg_fred where value is not null",
    "newest_obs": "select series, max(obs_date) as ld, arg_max(value, obs_date) as lv from obs group by 1",
    "lookback": """
        select n.series, n.ld, n.lv, d90.value as d90, m3.value as m3, m12.value as m12, m15.value as m15
        from newest_obs n
        asof left join obs d90 on n.series = d90.series and n.ld - 90 >= d90.obs_date
        asof left join obs m3 on n.series = m3.series and (n.ld - interval 3 month)::date >= m3.obs_date
        asof left join obs m12 on n.series = m12.series and (n.ld - interval 12 month)::date >= m12.obs_date
        asof left join obs m15 on n.series = m15.series and (n.ld - interval 15 month)::date >= m15.obs_date""",
    "mart_macro_indicators": f"""
        select series, round(lv, 2) as latest_value, ld as latest_date, round(lv - d90, 2) as change_90d,
               {pct('(lv - d90)', 'd90', 1)} as change_90d_pct,
               case sign(lv - d90) when 1 then 'up' when -1 then 'down' else 'flat' end as direction
        from lookback""",
    "mart_macro_history": f"select series, obs_date, round(value, 2) as value from obs where obs_date >= {AS_OF} - 180",
    "mart_house_price_history": "select obs_date, round(value, 1) as value from obs where series = 'house_prices'",
    "yoy": f"""
        select series, {pct('(lv - m12)', 'm12', 1)} as y0, {pct('(m3 - m15)', 'm15', 1)} as y3
        from lookback where series in ('industrial_production', 'cpi')""",
    "mart_macro_regime": """
        with w as (
            select max(y0) filter (series <> 'cpi') as growth_yoy, max(y3) filter (series <> 'cpi') as growth_yoy_3m_ago,
                   max(y0) filter (series = 'cpi') as inflation_yoy, max(y3) filter (series = 'cpi') as inflation_yoy_3m_ago
            from yoy),
        d as (
            select *, coalesce(if(growth_yoy >= growth_yoy_3m_ago, 'rising', if(growth_yoy < growth_yoy_3m_ago, 'falling', null)), 'unknown') as growth_direction,
                   coalesce(if(inflation_yoy >= inflation_yoy_3m_ago, 'rising', if(inflation_yoy < inflation_yoy_3m_ago, 'falling', null)), 'unknown') as inflation_direction
            from w)
        select *, case when growth_yoy is null or inflation_yoy is null then 'Unknown'
                       when growth_yoy > 0.5 then if(inflation_yoy > 2.5, 'Reflation / late-cycle', 'Goldilocks / expansion')
                       else if(inflation_yoy > 2.5, 'Stagflation', 'Deflation / slowdown') end as quadrant,
               if('unknown' in (growth_direction, inflation_direction), 'unknown',
                  format('{}_growth_{}_inflation', growth_direction, inflation_direction)) as aw_box
        from d""",
    "series_means": """
        select series, sum(value::decimal(28,9))::double / count(value) as mean_all, count(*) as n from obs group by 1""",
    "mart_macro_equilibrium": """
        with m as (select * from lookback join series_means using (series)),
        w as (
            select max(round(lv, 1)) filter (series = 'debt_to_gdp') as debt_to_gdp,
                   max(round(lv - m12, 1)) filter (series = 'debt_to_gdp') as debt_to_gdp_chg_1y,
                   max(round(lv, 1)) filter (series = 'capacity_utilization') as capacity_utilization,
                   max(round(mean_all, 1)) filter (series = 'capacity_utilization') as capacity_longrun_avg,
                   max(n) filter (series = 'capacity_utilization') as capacity_n_obs,
                   max(round(lv, 2)) filter (series = 'fed_funds') as cash_yield,
                   max(round(lv, 2)) filter (series = 'bond_10y') as bond_yield,
                   max(round(lv, 2)) filter (series = 'corp_baa') as credit_yield
            from m)
        select *, round(capacity_utilization - capacity_longrun_avg, 1) as capacity_gap,
               round(bond_yield - cash_yield, 2) as bond_over_cash, round(credit_yield - bond_yield, 2) as credit_over_bond,
               coalesce(if(least(bond_yield - cash_yield, credit_yield - bond_yield) > 0 and cash_yield + bond_yield + credit_yield is not null,
                           'upward_sloping', if(cash_yield + bond_yield + credit_yield is null, 'unknown', 'inverted')), 'unknown') as stack_shape
        from w""",
    "debt_stages": values(
        fixed.DEBT_STAGES,
        ["stage_order", "stage_name", "debt_min", "debt_max", "description", "implication"],
    ),
    "mart_big_cycle": """
        select stage_order, stage_name, description, implication, debt_min, debt_max, debt_to_gdp, debt_to_gdp_chg_1y,
               coalesce(stage_order < 6 and debt_to_gdp >= debt_min and debt_to_gdp < debt_max, false) as is_current,
               case when debt_to_gdp is null then 'unknown' when debt_to_gdp < 100 then 'low'
                    when debt_to_gdp < 130 then 'medium' else 'high' end as debasement_risk
        from debt_stages, mart_macro_equilibrium""",
    "decline_criteria": values(
        fixed.DECLINE_CRITERIA, ["criterion_order", "criterion", "series", "explanation", "unit"]
    ),
    "mart_debasement_signals": f"""
        select criterion_order, criterion, explanation, round(lv, 2) as latest_value, ld as latest_date, chg as chg_1y_pct,
               case series when 'debt_to_gdp' then lv > 130 when 'real_rate_10y' then lv < 0 else chg < 0 end as points_to_decline,
               unit
        from decline_criteria left join (select *, {pct('(lv - m12)', 'abs(m12)', 1)} as chg from lookback) using (series)""",
    "climate_labels": values(fixed.CLIMATE_LABELS, ["series", "ord", "label", "explanation"]),
    "mart_news_climate": f"""
        with r as (
            select *, percent_rank() over (partition by series order by value) as p, count(*) over (partition by series) as n,
                   min(obs_date) over (partition by series) as since
            from obs where series in (select series from climate_labels)
            qualify row_number() over (partition by series order by obs_date desc) = 1)
        select ord, label, explanation, series, round(value, 2) as latest_value, obs_date as latest_date,
               round(100 * p) as percentile, n as n_obs, since as since_date, {level('p', 'calm')} as level
        from r join climate_labels using (series)""",
    # -- long history ---------------------------------------------------------------------
    "cape_history": "select year, period as month, value as v from stg_lh_shiller where series = 'cape'",
    "cape_ranks": "select *, percent_rank() over (order by v) as p from cape_history",
    "mart_valuation": f"""
        with s as (
            select count(*) as n, min(year) as since, round(sum(v::decimal(28,9))::double / count(*), 1) as mean_v,
                   round(min(v) filter (p >= 0.5), 1) as med, round(max(v), 1) as max_v
            from cape_ranks)
        select round(v, 1) as cape, round(100 * p) as percentile, year as as_of_year, month as as_of_month, n as n_obs,
               since as since_year, mean_v as mean_cape, med as median_cape, max_v as max_cape, {level('p', 'cheap')} as level
        from cape_ranks, s order by year desc, month desc limit 1""",
    "valuation_points": values(feeds.SETTINGS.valuation_points, ["label", "ord", "y", "m"]),
    "mart_valuation_reference": """
        select ord, label, y as year, round(v, 1) as cape from valuation_points join cape_history on year = y and month = m""",
    "credit_panel": """
        select entity, year, max(value) filter (series = 'total_loans') * 100 / max(value) filter (series = 'nominal_gdp') as c,
               max(value) filter (series = 'public_debt_to_gdp') * 100 as p
        from stg_lh_jst group by 1, 2
        having max(value) filter (series = 'total_loans') is not null and max(value) filter (series = 'nominal_gdp') > 0""",
    "mart_credit_cycle": f"""
        with r as (
            select *, c - lag(c, 5) over (partition by entity order by year) as chg,
                   percent_rank() over (partition by entity order by c) as pr, count(*) over e as n,
                   min(year) over e as since, max(year) over e as until
            from credit_panel window e as (partition by entity)
            qualify row_number() over (partition by entity order by year desc) = 1)
        select entity, year as as_of_year, round(c, 1) as credit_to_gdp, round(chg, 1) as credit_change_5y,
               round(100 * pr) as credit_percentile, round(p, 1) as public_debt_to_gdp, n as n_obs, since as since_year,
               until as until_year, {level('pr', 'low')} as level,
               case when chg is null then 'unknown' when chg >= 10 then 'boom' when chg <= -10 then 'deleveraging'
                    else 'stable' end as credit_trend
        from r""",
    "entity_troughs": """
        with r as (select entity, year, total / n as rp from jst_wide where n > 0),
        w as (select entity, year from r
              window f as (partition by entity order by year rows between 5 preceding and 5 following)
              qualify rp = min(rp) over f and count(*) over f = 11)
        select entity, year as t from w qualify coalesce(year - lag(year) over (partition by entity order by year) > 2, true)""",
    "mart_property_cycle_intervals": """
        select entity, t as trough_year, lag(t) over e as prev_trough_year, t - lag(t) over e as interval_years
        from entity_troughs window e as (partition by entity order by t)""",
    "real_prices": """
        select obs_date as d, h.value as nominal, h.value / k.value as rp
        from (select * from obs where series = 'house_prices') h
        join (select * from obs where series = 'cpi' and value > 0) k using (obs_date)""",
    "price_troughs": """
        select d, nominal from real_prices
        window f as (order by d rows between 60 preceding and 60 following)
        qualify rp = min(rp) over f and count(*) over f = 121""",
    "interval_ranks": """
        select entity, interval_years as v, percent_rank() over (order by interval_years) as pr
        from mart_property_cycle_intervals where interval_years is not null""",
    "mart_property_cycle": f"""
        with t as (select max(d) as td, arg_max(nominal, d) as tv from price_troughs having count(*) > 0),
        pt as (select max(d) as pd from price_troughs where d < (select td from t)),
        b as (select min(d) as fd, max(d) as ld, max(nominal) filter (d >= (select td from t)) as peak from real_prices),
        pos as (select td, pd, fd, ld, round((ld - td) / 365.25::double, 1) as yst, {pct('(peak - tv)', 'tv', 1)} as off,
                       round((td - pd) / 365.25::double, 1) as last_iv from t, pt, b),
        dist as (
            select count(*) as n, round(avg(v), 1) as me, round(stddev(v), 1) as sd, min(v) as mi, max(v) as ma,
                   min(v) filter (pr >= 0.5) as p50, min(v) filter (pr >= 0.25) as p25, min(v) filter (pr >= 0.75) as p75,
                   round(100 * count(*) filter (v between 16 and 20)::double / nullif(count(*), 0)) as inside,
                   count(distinct entity) as nc, count(*) filter (entity = 'NATION_1') as un,
                   round(avg(v) filter (entity = 'NATION_1'), 1) as um, min(v) filter (entity = 'NATION_1') as umi,
                   max(v) filter (entity = 'NATION_1') as uma
            from interval_ranks)
        select td as trough_date, pd as prior_trough_date, ld as last_date, fd as first_date, yst as years_since_trough,
               off as pct_off_trough, last_iv as last_us_interval_years, n as n_intervals, me as measured_mean,
               sd as measured_sd, mi as measured_min, ma as measured_max, p50 as measured_median, p25 as measured_p25,
               p75 as measured_p75, inside as pct_within_16_20, nc as n_countries, un as usa_n_intervals, um as usa_mean,
               umi as usa_min, uma as usa_max, 18::double as model_cycle_years, round(100 * yst / 18, 1) as cycle_pct_complete,
               case when yst < 7 then 'Recovery' when yst < 9 then 'Mid-cycle slowdown' when yst < 14 then 'Expansion'
                    when yst < 16 then 'Mania / peak' when yst < 18 then 'Downturn' else '{fixed.PAST_HORIZON}' end as phase,
               (year(td) + p25)::int as next_low_earliest, (year(td) + p75)::int as next_low_latest
        from pos, dist""",
    # -- revenue and review ---------------------------------------------------------------
    "mart_revenue": f"""
        with x as (select *, livemode and paid and status = 'succeeded' as live,
                          amount - coalesce(amount_refunded, 0) as net from stg_stripe_charges),
        t as (select coalesce(sum(net) filter (live), 0)::double as net_collected, count(*) filter (live) as paid_charges,
                     count(distinct customer_id) filter (live) as paying_customers,
                     min(created_date) filter (live) as first_payment, max(created_date) filter (live) as last_payment,
                     coalesce(sum(net) filter (live and created_date >= {AS_OF} - 90), 0)::double as collected_90d,
                     count(*) filter (not livemode) as test_charges,
                     coalesce(sum(amount) filter (not livemode), 0)::double as test_amount from x),
        s as (select count(*) filter (status = 'active') as a, count(*) as n from stg_stripe_subscriptions where livemode)
        select net_collected, paid_charges, paying_customers, first_payment, last_payment, collected_90d,
               if(n = 0, null, a) as active_subscriptions, n as total_subscriptions, test_charges, test_amount,
               date '2002-02-10' as deadline, 2 as clients_target_min, 3 as clients_target_max,
               date '2002-02-10' - {AS_OF} as days_to_deadline,
               round((date '2002-02-10' - {AS_OF}) / 30.44::double, 1) as months_to_deadline,
               greatest(2 - paying_customers, 0) as clients_still_needed,
               case when test_charges > 0 and paid_charges = 0 then 'test_data_only' when paying_customers >= 2 then 'on_target'
                    when date '2002-02-10' - {AS_OF} < 90 then 'at_risk' else 'behind' end as status
        from t, s""",
    "load_log": """
        select 'macro_daily' as schema_name, max(o_orderdate)::timestamp as inserted_at from orders
        union all select 'stripe_daily', max(o_orderdate) from orders
        union all select 'finance_daily', max(l_shipdate) from lineitem
        union all select 'outreach', max(ts) from events""",
    "pipeline_loads": """
        select coalesce(nullif(regexp_extract(schema_name, '^(macro|longhistory|finance|stripe)', 1), ''), 'bronze') as pipeline,
               max(inserted_at) as last_loaded
        from load_log group by 1""",
    "source_text": values(
        [
            (k, feeds.SETTINGS.source_labels[k], order, pipeline, lag, feeds_text)
            for k, (order, pipeline, lag, feeds_text) in fixed.FRESHNESS_SOURCES.items()
        ],
        ["key", "source", "ord", "pipeline", "lag", "feeds"],
    ),
    "newest_dates": """
        select 'transactions' as key, max(txn_date) as d from stg_transactions
        union all select 'macro_fast', max(obs_date) from stg_fred where series in ('fed_funds', 'bond_10y', 'vix', 'dollar_index')
        union all select 'macro_slow', min(x) from (select max(obs_date) as x from stg_fred
            where series in ('debt_to_gdp', 'foreign_treasury', 'capacity_utilization') group by series)
        union all select 'valuation', max(make_date(year, period, 1)) from stg_lh_shiller where series = 'cape'
        union all select 'country_panel', make_date(max(year), 12, 31) from stg_lh_jst
        union all select 'millennium', make_date(max(year), 12, 31) from stg_lh_boe
        union all select 'revenue', max(created_date) from stg_stripe_charges
        union all select 'leads', max(found_date) from stg_leads""",
    "mart_data_freshness": f"""
        select source, ord, feeds, d as data_through, last_loaded, lag as expected_lag_days, {AS_OF} - d as data_age_days,
               case when d is null then 'unknown' when {AS_OF} - d <= lag then 'current'
                    when {AS_OF} - d <= lag * 2 then 'lagging' else 'stale' end as status
        from source_text join newest_dates using (key) left join pipeline_loads using (pipeline)""",
    "cadence_text": values(
        feeds.REVIEW_CADENCE, ["review", "days", "done", "source", "what_to_do"]
    ),
    "mart_review_digest": f"""
        with k as (select *, {AS_OF} - done::date as since, days::int as every from cadence_text)
        select 'Cadence' as section, 1 as ord,
               if(since > every, review || ' is OVERDUE', format('{{}} due in {{}} days', review, every - since)) as headline,
               what_to_do as detail, if(since > every, format('{{}} days past due', since - every), 'on schedule') as value,
               if(since > every, 1, 3) as severity
        from k
        union all
        select 'Portfolio', 2, title, detail,
               if(unit = '$', '$' || round(current_value)::bigint, printf('%.1f', current_value) || unit), severity
        from mart_portfolio_actions where status = 'act'
        union all
        select 'Budget', 3, format('{{}} is running {{}}/mo over a {{}} target', category_group, gap_vs_target::bigint, target_trailing::bigint),
               coalesce(note, ''), format('${{}}/mo actual', avg_3mo::bigint), if(status = 'well_over', 2, 3)
        from mart_budget_vs_actual where gap_vs_target > 50
        union all
        select 'Revenue', 4, format('{{}} of {{}} paying clients, {{}} months to the binary', paying_customers, clients_target_min,
                                    printf('%.1f', months_to_deadline)),
               '{fixed.REVENUE_DETAIL}', format('${{}} collected', round(net_collected)::bigint), if(status = 'on_target', 3, 2)
        from mart_revenue
        union all
        select 'Data', 5, format('{{}} has not published in {{}} days', source, data_age_days), feeds,
               'through ' || data_through, 3
        from mart_data_freshness where status = 'stale'""",
    "mart_review_snapshot": f"""
        select {AS_OF} as snapshot_date, a.us_pct as active_us_pct, k.equity_value as combined_equity,
               (select count(*) from mart_portfolio_actions where status = 'act') as open_actions,
               avg_monthly_spend, actual_savings_rate_pct as savings_rate_pct, liquid_savings, runway_months,
               net_collected as revenue_collected, paying_customers, cape, quadrant as regime,
               (select count(*) from mart_data_freshness where status = 'stale') as stale_sources
        from mart_evidence_bands a, mart_evidence_bands k, mart_safe_to_spend, mart_runway, mart_revenue, mart_valuation,
             mart_macro_regime
        where a.scope = 'Active' and k.scope = 'Combined'""",
}

# Silver rows with exact decimals handed out as doubles, as the Spark queries do.
_DECIMALS = {
    "stg_transactions": ["amount"],
    "stg_accounts": ["current_balance"],
    "stg_recurring": ["amount"],
    "stg_networth": ["net_worth"],
    "stg_holdings": ["market_value", "change_pct"],
    "stg_stripe_charges": ["amount", "amount_refunded"],
    "int_transactions": ["amount", "expense_amount", "income_amount", "w2_income"],
    "int_monthly_parts": ["total"],
    "int_monthly_totals": ["expense", "income", "w2"],
}


def oracle(query: str) -> str:
    """`query` with every part it mentions as CTEs, dependencies first."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in PARTS:
            if PARTS[name] is not sql and name not in ordered and re.search(rf"\b{name}\b", sql):
                visit(PARTS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(query)
    if not ordered:
        return query
    ctes = ",\n".join(f"{n} as ({PARTS[n]})" for n in ordered)
    if query.lstrip().lower().startswith("with"):
        query = f"select * from ({query})"
    return f"with {ctes}\n{query}"


def model_oracle(name: str) -> str:
    doubles = _DECIMALS.get(name, [])
    if not doubles:
        return oracle(f"select * from {name}")
    casts = ", ".join(f"{d}::double as {d}" for d in doubles)
    return oracle(f"select * replace ({casts}) from {name}")
