from __future__ import annotations

from datetime import date, datetime

import pytest

from ledgerlake import MODELS, Lake, Settings
from ledgerlake.plans import serving
from ledgerlake.schemas import BRONZE, SEEDS
from tests import fixtures


def rows(df):
    return [r.asDict() for r in df.collect()]


def one(df):
    (row,) = rows(df)
    return row


@pytest.mark.parametrize("name", sorted(MODELS))
def test_every_model_has_rows(lake, name):
    expected_empty = {"stg_stripe_subscriptions"}
    assert lake.ref(name).isEmpty() == (name in expected_empty)


def test_leads_are_typed_safely(lake):
    by_id = {r["lead_id"]: r for r in rows(lake.ref("stg_leads"))}
    assert by_id.keys() == {lead["id"] for lead in fixtures.LEADS}
    assert by_id[31]["email"] == "plain.person@example.test"
    assert by_id[31]["found_date"] == date(2026, 3, 9)
    assert by_id[32]["found_date"] is None  # a bare year is not a date
    assert by_id[33]["last_touch_date"] is None
    assert by_id[37]["last_touch_date"] == date(2026, 6, 2)
    assert "\r\n" in by_id[34]["notes"] and '"word"' in by_id[34]["notes"]
    active = {i: by_id[i]["linkedin_active"] for i in (31, 32, 33, 34)}
    assert active == {31: False, 32: None, 33: True, 34: True}
    assert by_id[32]["has_team"] is True and by_id[31]["has_team"] is False


def test_touch_measures_and_funnel(lake):
    touches = rows(lake.ref("stg_touches"))
    opened = [t["opened"] for t in touches]
    assert (opened.count(True), opened.count(False), opened.count(None)) == (4, 3, 1)
    assert sum(f["is_open"] for f in rows(lake.ref("fact_touch"))) == 4
    funnel = {r["angle"]: (r["total_touches"], r["opens"]) for r in rows(lake.ref("mart_outreach_funnel"))}
    assert funnel == {"A": (3, 2), "B": (2, 1), "C": (1, 0), "unassigned": (2, 1)}
    for r in rows(lake.ref("mart_outreach_funnel")):
        assert (r["reply_over_open_rate_pct"] is None) == (r["opens"] == 0)


def test_refunds_reversals_transfers_and_hidden_rows(lake):
    txns = rows(lake.ref("int_transactions"))
    assert not any(t["merchant"] in ("Hidden shop", "Own account") for t in txns)
    unknown = next(t for t in txns if t["merchant"] == "Nowhere")
    assert (unknown["group_type"], unknown["category_group"]) == ("uncategorized", "Uncategorized")
    assert unknown["expense_amount"] == 0
    newest = rows(lake.ref("mart_monthly_cashflow"))[-1]
    assert newest["month"] == date(2026, 8, 1)
    assert newest["income"] == 3925 and newest["w2_income"] == 4000 and newest["other_income"] == -75
    assert newest["spend"] == 1991  # 1600 + 310.25 + 120.5 - 40.25, half up
    food = next(
        r for r in rows(lake.ref("mart_spend_by_category"))
        if r["category_group"] == "Food" and r["month"] == date(2026, 8, 1)
    )
    assert food["spend"] == 431  # the refund does not count here: 310.25 + 120.5


def test_budget_resolves_dated_targets(lake):
    budget = {r["category_group"]: r for r in rows(lake.ref("mart_budget_vs_actual"))}
    assert set(budget) == {"Housing", "Food", "Gifts"}
    housing = budget["Housing"]
    assert housing["monthly_target"] == 1500
    assert housing["target_trailing"] == 1567 and housing["target_changed"]
    assert housing["projected_month"] is None and housing["status"] == "over"
    food = budget["Food"]
    assert food["projected_month"] == round((310.25 + 120.5 - 40.25) * 31 / 20)
    assert food["status"] == "well_over" and not food["target_changed"]
    assert budget["Gifts"]["status"] == "on_target" and budget["Gifts"]["avg_3mo"] == 0


def test_safe_to_spend_uses_targets_in_force(spark, lake, tmp_path):
    now = one(lake.ref("mart_safe_to_spend"))
    assert now["total_target"] == 1500 + 300 + 75 and now["flexible_target"] == 375
    assert now["avg_monthly_income"] == 4020 and now["avg_monthly_w2"] == 4020
    assert now["flexible_spent_this_month"] == 391  # 390.5
    every = fixtures.landed_lake(
        spark, tmp_path, settings=Settings(**{**fixtures.SETTINGS.__dict__, "legacy_targets": True})
    )
    assert one(every.ref("mart_safe_to_spend"))["total_target"] == 1600 + 1500 + 300 + 75


def test_balances_and_runway(lake):
    breakdown = {r["bucket"]: r["balance"] for r in rows(lake.ref("mart_networth_breakdown"))}
    assert breakdown == {"Cash": 9000, "Debt": -1201, "Investments": 9700, "Credit": 55}
    runway = one(lake.ref("mart_runway"))
    assert runway["liquid_savings"] == 11100
    assert one(lake.ref("mart_recurring_summary")) == {"monthly_recurring": 36.0, "bills": 2}


def test_portfolio_tables(lake):
    held = {r["ticker"]: r for r in rows(lake.ref("stg_holdings")) if r["account"].startswith("Active")}
    assert held["XOM"]["sleeve"] == "standard" and held["XOM"]["asset_class"] == "equity"
    assert held["NEWCO"]["region"] == "US" and held["NEWCO"]["asset_class"] == "equity"
    positions = {r["ticker"]: r for r in rows(lake.ref("mart_positions"))}
    assert positions["XOM"]["over_cap"] and positions["XOM"]["cap_pct"] == 7
    assert not positions["GOOGL"]["over_cap"] and positions["GOOGL"]["cap_pct"] == 12
    assert positions["VOO"]["cap_pct"] is None
    bands = {r["scope"]: r for r in rows(lake.ref("mart_evidence_bands"))}
    assert list(bands) == ["Active", "Roth", "Combined"]
    assert bands["Roth"]["us_pct"] == 60.0 and not bands["Roth"]["in_alto_band"]
    boxes = {r["box"]: r for r in rows(lake.ref("mart_all_weather"))}
    assert len(boxes) == 4
    assert boxes["rising_growth_rising_inflation"]["covering_tickers"] == "GLD"
    assert boxes["rising_growth_rising_inflation"]["coverage"] == "thin"
    assert one(serving.shared_hedge(lake))["shared_hedge"] == "GLD"
    actions = {r["title"]: r["status"] for r in rows(lake.ref("mart_portfolio_actions"))}
    assert len(actions) == 9
    assert actions["Invest the HSA"] == "act"
    assert actions["Rebuild the emergency buffer"] == "ok"
    assert actions["Trim positions over their cap"] == "act"
    assert actions["Defensive sleeve inside 25-35%"] == "ok"


def test_an_uncovered_box_stays_as_none(spark):
    lake = Lake(spark, {"mm_holdings": spark.createDataFrame(
        [("Active Investing", "VOO", "100")], "account string, ticker string, market_value string")},
        {"security_map": spark.createDataFrame(fixtures.SECURITIES, SEEDS["security_map"])},
        as_of=fixtures.AS_OF, optional=BRONZE)
    boxes = {r["box"]: r["coverage"] for r in rows(lake.ref("mart_all_weather"))}
    assert boxes["rising_growth_falling_inflation"] == "covered"
    assert boxes["falling_growth_rising_inflation"] == "none" and len(boxes) == 4


def test_empty_lake_still_builds(spark):
    lake = Lake(spark, {}, as_of=fixtures.AS_OF, optional=[*BRONZE, *SEEDS])
    for name in ("mart_safe_to_spend", "mart_macro_regime", "mart_macro_equilibrium", "mart_data_freshness", "mart_revenue"):
        assert lake.ref(name).count() >= 1
    assert one(lake.ref("mart_macro_regime"))["quadrant"] == "Unknown"
    assert {r["status"] for r in rows(lake.ref("mart_data_freshness"))} == {"unknown"}
    assert lake.ref("mart_property_cycle").isEmpty()


def test_an_input_that_is_nowhere_is_an_error(spark):
    with pytest.raises(LookupError, match="mm_accounts"):
        Lake(spark, {}, as_of=fixtures.AS_OF).ref("stg_accounts")
    empty = Lake(spark, {}, as_of=fixtures.AS_OF, optional=[*BRONZE, *SEEDS])
    assert all(r["value"] != "n%" for r in rows(empty.ref("mart_review_digest")))


def test_macro_tables(lake):
    regime = one(lake.ref("mart_macro_regime"))
    assert regime["quadrant"] == "Reflation / late-cycle"
    assert regime["inflation_yoy"] == fixtures.INFLATION
    equilibrium = one(lake.ref("mart_macro_equilibrium"))
    assert equilibrium["capacity_n_obs"] == fixtures.MONTHS
    assert equilibrium["stack_shape"] == "upward_sloping"
    stages = rows(lake.ref("mart_big_cycle"))
    assert [s["stage_order"] for s in stages if s["is_current"]] == [4]
    signals = {r["criterion_order"]: r for r in rows(lake.ref("mart_debasement_signals"))}
    assert [signals[i]["points_to_decline"] for i in (1, 2, 3, 4)] == [False, False, False, True]
    assert one(serving.decline_count(lake)) == {"signals_pointing_to_decline": 1, "signals": 4}
    climate = {r["series"]: r for r in rows(lake.ref("mart_news_climate"))}
    assert climate["vix"]["percentile"] == 0 and climate["vix"]["level"] == "calm"
    assert climate["policy_uncertainty"]["percentile"] == 100 and climate["vix"]["n_obs"] == fixtures.MONTHS


def test_trough_intervals_are_the_cycle(lake):
    found = rows(lake.ref("mart_property_cycle_intervals"))
    gaps = [r["interval_years"] for r in found if r["interval_years"] is not None]
    # Lows less than half a window from either end don't count.
    inner = {e: [y for y in lows if 1880 <= y <= 2015] for e, lows in fixtures.PANEL_LOWS.items()}
    assert len(found) == sum(map(len, inner.values()))
    expected = sorted(b - a for lows in inner.values() for a, b in zip(lows, lows[1:]))
    assert sorted(gaps) == expected and set(expected) == {17, 19}
    assert rows(serving.interval_histogram(lake)) == [{"bucket": "16-20", "sort_key": 3, "n": len(gaps)}]


def test_property_cycle_position(lake):
    position = one(lake.ref("mart_property_cycle"))
    assert position["trough_date"] == fixtures._month(fixtures.LAST - fixtures.HOUSE_LOWS[1])
    assert position["prior_trough_date"] == fixtures._month(fixtures.LAST - fixtures.HOUSE_LOWS[0])
    assert position["last_us_interval_years"] == 13.0
    inner = [[y for y in lows if 1880 <= y <= 2015] for lows in fixtures.PANEL_LOWS.values()]
    gaps = [b - a for lows in inner for a, b in zip(lows, lows[1:])]
    assert position["measured_mean"] == round(sum(gaps) / len(gaps), 1) and position["pct_within_16_20"] == 100
    assert position["phase"] == "Expansion"
    # Intervals of 17 years rank 0, those of 19 by the share of the shorter ones: with fewer
    # than half of them no rank reaches the median.
    assert (position["measured_median"] is None) == (gaps.count(17) < len(gaps) / 2)


def test_credit_and_valuation(lake):
    credit = {r["entity"]: r for r in rows(lake.ref("mart_credit_cycle"))}
    assert credit["USA"]["n_obs"] == len(fixtures.PANEL_YEARS) and credit["USA"]["credit_percentile"] == 100
    assert credit["USA"]["level"] == "extreme" and credit["USA"]["until_year"] == 2020
    value = one(lake.ref("mart_valuation"))
    assert (value["as_of_year"], value["as_of_month"]) == fixtures.CAPE_UNTIL
    assert len(rows(lake.ref("mart_valuation_reference"))) == 5
    assert rows(serving.valuation_ladder(lake))[0]["cape"] >= value["cape"]


def test_revenue_never_counts_test_rows(lake):
    revenue = one(lake.ref("mart_revenue"))
    assert revenue["net_collected"] == 4321 + 80 - 25.5
    assert revenue["paying_customers"] == 2 and revenue["paid_charges"] == 2
    assert revenue["test_charges"] == 1 and revenue["test_amount"] == 120
    assert revenue["collected_90d"] == 54.5 and revenue["status"] == "on_target"
    assert revenue["active_subscriptions"] is None and revenue["total_subscriptions"] == 0
    charges = lake.ref("stg_stripe_charges")
    assert "card_number" not in charges.columns


@pytest.mark.parametrize(
    ("charges", "as_of", "status"),
    [
        ([fixtures.charge(1, 100, fixtures.EARLY, livemode=False)], date(2026, 8, 20), "test_data_only"),
        ([fixtures.charge(1, 100, fixtures.EARLY)], date(2026, 8, 20), "behind"),
        ([fixtures.charge(1, 100, fixtures.EARLY)], date(2027, 1, 20), "at_risk"),
    ],
)
def test_revenue_status(spark, charges, as_of, status):
    text = [{k: None if v is None else str(v) for k, v in c.items()} for c in charges]
    columns = list(text[0])
    df = spark.createDataFrame([tuple(c.values()) for c in text], ", ".join(f"{c} string" for c in columns))
    assert one(Lake(spark, {"stripe_charges": df}, as_of=as_of, optional=BRONZE).ref("mart_revenue"))["status"] == status


def test_freshness_and_digest(lake):
    fresh = {r["source"]: r for r in rows(lake.ref("mart_data_freshness"))}
    assert fresh["Bank transactions"]["last_loaded"] == datetime(2026, 8, 19, 6)
    assert fresh["Bank transactions"]["status"] == "current"
    assert fresh["Shiller CAPE"]["data_through"] == date(2025, 4, 1)
    assert fresh["JST macrohistory"]["data_through"] == date(2020, 12, 31)
    assert fresh["JST macrohistory"]["status"] == "stale" and fresh["JST macrohistory"]["last_loaded"] is None
    digest = rows(lake.ref("mart_review_digest"))
    assert digest == sorted(digest, key=lambda r: (r["severity"], r["ord"], r["headline"]))
    headlines = {r["headline"]: r for r in digest}
    assert headlines["Quarterly rebalance is OVERDUE"]["value"] == "14 days past due"
    assert "Monthly review due in 11 days" in headlines
    assert headlines["Invest the HSA"]["value"] == "$2100"
    assert headlines["Trim positions over their cap"]["value"] == "1.0 positions"
    assert any(h.startswith("Food is running 133/mo over a 300 target") for h in headlines)
    summary = one(serving.digest_summary(lake))
    assert summary["items_total"] == len(digest)


def test_snapshot_row(lake):
    snapshot = one(lake.ref("mart_review_snapshot"))
    assert snapshot["snapshot_date"] == fixtures.AS_OF
    assert snapshot["paying_customers"] == 2 and snapshot["regime"] == "Reflation / late-cycle"


def test_serving_reads(lake):
    change = one(serving.networth_change(lake))
    assert change == {"net_worth_now": 10039.0, "net_worth_before": 10009.0, "net_worth_change": 30.0}
    assert [r["merchant"] for r in rows(serving.upcoming_bills(lake))] == ["Video", "Employer"]
    assert len(rows(serving.recent_transactions(lake))) == 10
    pace = one(serving.flexible_pace(lake))
    assert pace["days_left"] == 12 and pace["pct_spent"] == 100.0
    for name, read in serving.SERVING.items():
        assert read(lake).columns, name


def test_settled_rows_keep_types_and_must_be_single(spark, lake):
    other = Lake(spark, {}, as_of=lake.as_of)
    other._built["a"] = spark.sql("select date'2020-01-31' as d, cast(null as decimal(18,3)) as n, 1.250BD as m")
    other._built["b"] = spark.sql("select 'x' as d, timestamp'2020-01-01 10:00:00' as t")
    before = [other.ref(n).schema.simpleString() for n in "ab"], [other.ref(n).collect() for n in "ab"]
    other.settle_rows("a", "b")
    other.settle_rows("a")
    assert ([other.ref(n).schema.simpleString() for n in "ab"], [other.ref(n).collect() for n in "ab"]) == before
    assert other.is_settled("a") and other.is_settled("b")
    other._built["c"] = spark.range(3)
    with pytest.raises(ValueError):
        other.settle_rows("c")
