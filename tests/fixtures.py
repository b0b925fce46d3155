"""Synthetic landing files for every source, deterministic, with a case for each branch."""

from __future__ import annotations

import csv
import json
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

from ledgerlake import Lake, Settings
from ledgerlake.schemas import BRONZE, RAW, SEEDS
from ledgerlake.sources import landing

AS_OF = date(2026, 8, 20)
SETTINGS = Settings(paycheck_category="Salary", hsa_cash_prefix="Health cash", hsa_invested_prefix="Health invested")


def _month(back: int) -> date:
    index = AS_OF.year * 12 + AS_OF.month - 1 - back
    return date(index // 12, index % 12 + 1, 1)


# -- outreach ---------------------------------------------------------------------------

#: One lead per case that the typing has to get right; columns not named are empty.
LEADS = [
    {"id": 31, "name": "Plain", "email": " Plain.Person@Example.TEST ", "status": "warm", "found_date": "2026-03-09",
     "linkedin_active": "false", "has_team": "N", "operator_visible": "Y", "email_list": "Y", "angle_assigned": "B",
     "last_touch_date": "2026-05-11", "notes": "nothing odd"},
    {"id": 32, "name": "Year only", "status": "sent", "found_date": "2025", "linkedin_active": "", "has_team": "Y"},
    {"id": 33, "name": "Text for a date", "status": "replied", "last_touch_date": "left a message", "linkedin_active": "true"},
    {"id": 34, "name": "Quoted", "status": "warm", "notes": 'first line\r\nsecond with a "word", and a comma',
     "linkedin_active": "yes", "angle_assigned": "C"},
    {"id": 35, "name": "Lists", "status": "enriched", "content_signals": "podcast, talks", "email_list": "personal"},
    {"id": 36, "name": "Never touched", "status": "qualified", "has_team": "N", "email_list": "N"},
    {"id": 37, "name": "Often touched", "status": "sent", "angle_assigned": "A", "last_touch_date": "2026-06-02"},
]

#: lead, day in June, channel, angle, opened, replied
TOUCHES = [
    (31, 1, "call", "B", "yes", "yes"),
    (31, 4, "email", "B", "no", "no"),
    (33, 2, "linkedin", "", "unknown", "no"),
    (34, 9, "email", "C", "no", "no"),
    (37, 1, "email", "A", "Yes", "no"),
    (37, 3, "email", "A", "yes", "yes"),
    (37, 8, "call", "A", "no", "no"),
    (37, 12, "linkedin", "", "yes", "no"),
]


def leads() -> list[dict]:
    return [dict.fromkeys(BRONZE["leads_master"], "") | lead for lead in LEADS]


def touches() -> list[dict]:
    rows, seen = [], {}
    for lead, day, channel, angle, opened, replied in TOUCHES:
        seen[lead] = seen.get(lead, 0) + 1
        touch = dict.fromkeys(BRONZE["touch_log"], "")
        touch |= {
            "touch_id": f"june-{day:02d}-{lead}", "lead_id": lead, "date": f"2026-06-{day:02d}", "channel": channel,
            "touch_number": seen[lead], "angle": angle, "opened": opened, "replied": replied,
        }
        rows.append(touch)
    return rows


# -- personal finance ---------------------------------------------------------------------


def accounts() -> list[dict]:
    def edge(ticker, position_ticker, name, kind, value):
        return {
            "node": {
                "security": {"ticker": ticker, "name": name, "type": kind, "typeDisplay": None},
                "holdings": [{"ticker": position_ticker, "name": name, "type": kind}] if position_ticker else [],
                "totalValue": value, "quantity": 1.5, "basis": 10.0, "securityPriceChangePercent": 0.5,
            }
        }

    def account(i, name, kind, balance, asset=True, net_worth=True, edges=()):
        return {
            "id": str(i), "displayName": name, "currentBalance": balance, "isAsset": asset,
            "includeInNetWorth": net_worth, "type": {"display": kind}, "institution": {"name": "Bank"},
            "order": i, "portfolio": {"aggregateHoldings": {"edges": list(edges)}},
        }

    active = [
        edge("VOO", None, "500 index", "etf", 3000.0),
        edge(None, "XOM", "Oil company", "equity", 900.0),
        edge("VYMI", None, "Abroad dividends", "etf", 2600.0),
        edge("GOOGL", None, "Search", "equity", 1000.0),
        edge("GLD", None, "Gold", "etf", 300.0),
        edge("SPAXX", None, "Money fund", "cash", 800.0),
        edge("", "NEWCO", "Unmapped", "equity", 100.0),
    ]
    retirement = [edge("VOO", None, "500 index", "etf", 600.0), edge("VXUS", None, "World", "etf", 400.0)]
    return [
        account(1, "Checking", "Cash", 9000.25),
        account(2, "Card", "Credit Cards", -1200.5, asset=False),
        account(3, "Active Investing Main", "Investments", 8700.0, edges=active),
        account(4, "ROTH IRA", "Investments", 1000.0, edges=retirement),
        account(5, "Health cash account", "Cash", 2100.0, net_worth=False),
        account(6, "Mystery", "Credit", 55.0),
    ]


CATEGORIES = [
    ("c1", "Groceries", "Food", "expense"),
    ("c2", "Restaurants", "Food", "expense"),
    ("c3", "Rent", "Housing", "expense"),
    ("c4", "Salary", "Income", "income"),
    ("c5", "Transfer", "Transfers", "transfer"),
]


def transactions() -> list[dict]:
    names = {c[0]: c[1] for c in CATEGORIES}
    rows = []

    def add(day, amount, category, merchant, hidden=False):
        rows.append(
            {
                "id": f"t{len(rows)}", "date": day.isoformat(), "amount": amount,
                "category": {"id": category, "name": names.get(category, "Unknown")},
                "merchant": {"name": merchant}, "account": {"id": "1", "displayName": "Checking"},
                "isRecurring": False, "pending": False, "hideFromReports": hidden,
                "tags": [{"name": "x"}], "attachments": [],
            }
        )

    for back in range(4):
        start = _month(back)
        add(start + timedelta(days=1), 4000.0 + 10 * back, "c4", "Employer")
        add(start + timedelta(days=2), -1600.0, "c3", "Landlord")
        add(start + timedelta(days=3), -310.25 - back, "c1", "Market")
        add(start + timedelta(days=4), -120.5, "c2", "Cafe")
    add(AS_OF - timedelta(days=1), 40.25, "c1", "Market")  # refund
    add(AS_OF - timedelta(days=2), -75.0, "c4", "Employer")  # income reversal
    add(AS_OF - timedelta(days=3), -500.0, "c5", "Own account")  # transfer
    add(AS_OF - timedelta(days=4), -60.0, "c9", "Nowhere")  # unknown category
    add(AS_OF - timedelta(days=5), -999.0, "c1", "Hidden shop", hidden=True)
    return rows


RECURRING = [
    {"date": "2026-08-25", "amount": -15.99, "stream": {"frequency": "monthly", "amount": -15.99, "merchant": {"name": "Video"}},
     "category": {"id": "c1", "name": "Groceries"}, "account": {"id": "1", "displayName": "Checking"}},
    {"date": "2026-08-10", "amount": -20.01, "stream": {"frequency": "monthly", "amount": -20.01, "merchant": {"name": "Gym"}},
     "category": {"id": "c1", "name": "Groceries"}, "account": {"id": "1", "displayName": "Checking"}},
    {"date": "2026-09-01", "amount": 4000.0, "stream": {"frequency": "monthly", "amount": 4000.0, "merchant": {"name": "Employer"}},
     "category": {"id": "c4", "name": "Salary"}, "account": {"id": "1", "displayName": "Checking"}},
]

NETWORTH = [
    {"date": (AS_OF - timedelta(days=40 - i)).isoformat(), "balance": 10000.4 + i, "__typename": "Snapshot"} for i in range(40)
]

BUDGET = [
    ("Housing", "fixed", "1600", "2026-01-01", "2026-06-30", "first lease"),
    ("Housing", "fixed", "1500", "2026-07-01", "", "second lease"),
    ("Food", "flexible", "300", "2026-01-01", "2999-12-31", "eat"),
    ("Gifts", "flexible", "75", "2026-01-01", "2999-12-31", ""),
]
CADENCE = [
    ("Quarterly rebalance", "91", "2026-05-07", "plan", "Check bands"),
    ("Monthly review", "30", "2026-08-01", "plan", "Read the month"),
]

SECURITIES = [
    ("VOO", "US", "equity", "passive"),
    ("VXUS", "Intl", "equity", "passive"),
    ("VYMI", "Intl", "equity", "defensive"),
    ("GOOGL", "US", "equity", "conviction"),
    ("XOM", "US", "equity", "standard"),
    ("GLD", "NA", "commodity", "inflation_hedge"),
    ("SPAXX", "NA", "cash", "dry_powder"),
]

# -- macro and long history -----------------------------------------------------------------


def between(points: list[tuple[int, float]], at: int) -> float:
    """The value at `at` on straight lines through (place, value) points."""
    for (left, low), (right, high) in zip(points, points[1:]):
        if left <= at <= right:
            return low + (high - low) * (at - left) / (right - left)
    raise ValueError(at)


def from_lows(lows: list[int], at: int) -> int:
    """How far the nearest low is."""
    return min(abs(at - low) for low in lows)


MONTHS = 384
LAST = MONTHS - 1
#: Months in which real house prices are lowest.
HOUSE_LOWS = [84, 240]
#: Turning points of each series, by month.
TURNS = {
    "oil_wti": [(0, 25), (200, 95), (LAST, 61)],
    "commodities": [(0, 110), (150, 240), (LAST, 300)],
    "fed_funds": [(0, 6), (120, 1), (LAST, 4)],
    "bond_10y": [(0, 7), (250, 2), (LAST, 4.5)],
    "yield_curve_10y2y": [(0, 1.5), (190, -0.4), (LAST, 0.6)],
    "industrial_production": [(0, 70), (100, 78), (LAST, 133)],
    "corp_baa": [(0, 9), (250, 4), (LAST, 6.4)],
    "capacity_utilization": [(0, 84), (210, 71), (LAST, 79)],
    "debt_to_gdp": [(0, 58), (LAST, 121)],
    "dollar_index": [(0, 96), (90, 131), (LAST, 104)],
    "real_rate_10y": [(0, 3), (260, -1), (LAST, 2.1)],
    "foreign_treasury": [(0, 600), (LAST, 8700)],
    "policy_uncertainty": [(0, 70), (LAST, 410)],
    "global_policy_uncertainty": [(0, 80), (300, 240), (LAST, 330)],
    "financial_stress": [(0, 1.2), (LAST, -1.1)],
    "vix": [(0, 44), (LAST, 13)],
    "recession_prob": [(0, 30), (60, 2), (LAST, 9)],
}
INFLATION = 3  # percent a year, the same in every month


def observations() -> list[dict]:
    rows = []

    def put(series, day, value):
        rows.append({"series": series, "series_id": series.upper(), "date": day, "value": value})

    for i in range(MONTHS):
        day = _month(LAST - i).isoformat()
        cpi = 80 * (1 + INFLATION / 100) ** (i / 12)
        put("cpi", day, f"{cpi:.5f}")
        put("house_prices", day, f"{(90 + from_lows(HOUSE_LOWS, i) / 4) * cpi / 80:.5f}")
        for series, points in TURNS.items():
            put(series, day, f"{between(points, i):.5f}")
    for missing in (".", ""):
        put("vix", AS_OF.isoformat(), missing)
    return rows


#: Years of the lowest real house prices: 19 years apart, or 17 in the last entity.
PANEL_LOWS = {
    "USA": list(range(1885, 2021, 19)),
    "Norway": list(range(1881, 2021, 19)),
    "Spain": list(range(1892, 2021, 19)),
    "Italy": list(range(1884, 2021, 17)),
}
PANEL_YEARS = range(1875, 2021)


def panel() -> list[dict]:
    rows = []
    for entity, lows in PANEL_LOWS.items():
        for year in PANEL_YEARS:
            age = year - PANEL_YEARS[0]
            cpi = 4 + 0.5 * age
            values = {
                "cpi": cpi,
                "house_prices_nominal": (50 + 2 * from_lows(lows, year)) * cpi,
                "nominal_gdp": 30 + 4 * age,
                "total_loans": 10 + 3 * age + age * age / 50,
                "public_debt_to_gdp": 0.2 + 0.005 * age,
            }
            rows += [{"entity": entity, "year": year, "period": 0, "series": n, "value": v} for n, v in values.items()]
    return rows


#: Turning points of the valuation ratio, by year.
CAPE_TURNS = [(1915, 9.0), (1929, 31.0), (1933, 8.0), (1966, 24.0), (1982, 7.0), (2000, 43.0), (2009, 14.0), (2026, 38.0)]
CAPE_UNTIL = (2025, 4)


def equity_months() -> list[dict]:
    rows = []
    for year in range(CAPE_TURNS[0][0], CAPE_UNTIL[0] + 1):
        for month in range(1, 13):
            if (year, month) <= CAPE_UNTIL:
                points = [(12 * y, v) for y, v in CAPE_TURNS]
                value = round(between(points, 12 * year + month - 1), 2)
                rows.append({"entity": "USA", "year": year, "period": month, "series": "cape", "value": value})
    return rows


def millennium() -> list[dict]:
    """A price level that stands still and doubles every 40 years."""
    return [
        {"entity": "GBR", "year": year, "period": 0, "series": "cpi", "value": 2.0 ** ((year - 1880) // 40)}
        for year in range(1880, 2017)
    ]


# -- revenue --------------------------------------------------------------------------------


def epoch(day: date) -> int:
    return int(datetime(day.year, day.month, day.day, 12, tzinfo=timezone.utc).timestamp())


EARLY, RECENT = epoch(date(2026, 2, 3)), epoch(date(2026, 7, 20))


def charge(number, amount, created, **changes):
    """A succeeded live charge of so many cents, but for what is changed."""
    row = {
        "id": f"charge-{number}", "amount": amount, "amount_refunded": 0, "currency": "usd", "created": created,
        "status": "succeeded", "paid": True, "refunded": False, "description": "hours", "customer": "north",
        "invoice": None, "livemode": True, "card_number": "never stored",
    }
    return row | changes


CHARGES = [
    charge(1, 432100, EARLY),
    charge(2, 8000, RECENT, amount_refunded=2550, refunded=True, customer="south"),
    charge(3, 12000, RECENT, livemode=False),
    charge(4, 9900, RECENT, status="failed", paid=False, customer="west"),
]
CUSTOMERS = [{"id": "north", "created": EARLY, "email": "n@example.test", "name": None, "delinquent": False, "livemode": True}]


def write(root: Path) -> None:
    def to_csv(name, rows, columns):
        with open(root / name, "w", newline="") as f:
            writer = csv.DictWriter(f, columns, lineterminator="\n")
            writer.writeheader()
            writer.writerows(rows)

    to_csv("leads.csv", leads(), BRONZE["leads_master"])
    to_csv("touches.csv", touches(), BRONZE["touch_log"])
    to_csv("budget_targets.csv", [dict(zip(SEEDS["budget_targets"], r)) for r in BUDGET], SEEDS["budget_targets"])
    to_csv("security_map.csv", [dict(zip(SEEDS["security_map"], r)) for r in SECURITIES], SEEDS["security_map"])
    to_csv("review_cadence.csv", [dict(zip(SEEDS["review_cadence"], r)) for r in CADENCE], SEEDS["review_cadence"])
    categories = [{"id": i, "name": n, "group": {"name": g, "type": k}} for i, n, g, k in CATEGORIES]
    files = {
        "accounts": accounts(), "categories": categories, "transactions": transactions(), "recurring": RECURRING,
        "networth": NETWORTH, "observations": observations(), "jst": panel(), "shiller": equity_months(),
        "boe": millennium(), "charges": CHARGES, "subscriptions": [], "customers": CUSTOMERS,
    }
    for name, rows in files.items():
        (root / f"{name}.json").write_text(json.dumps(rows))


def landed_lake(spark, root: Path, as_of: date = AS_OF, settings: Settings = SETTINGS) -> Lake:
    """The lake over freshly written files, through the landing readers."""
    write(root)

    def records(name, drop=()):
        return landing.flatten(landing.read_records(spark, f"{root}/{name}.json", RAW[name]), drop)

    def fixed(name, table):
        return landing.read_fixed_records(spark, f"{root}/{name}.json", BRONZE[table])

    raw_accounts = landing.read_records(spark, f"{root}/accounts.json", RAW["accounts"])
    raw_obs = landing.read_fixed_records(
        spark, f"{root}/observations.json", ["series", "series_id", "date", "value"]
    )
    bronze = {
        "leads_master": landing.read_csv_text(spark, f"{root}/leads.csv", BRONZE["leads_master"]),
        "touch_log": landing.read_csv_text(spark, f"{root}/touches.csv", BRONZE["touch_log"]),
        "mm_accounts": landing.flatten(raw_accounts.drop("portfolio")),
        "mm_holdings": landing.all_text(landing.explode_holdings(raw_accounts)),
        "mm_categories": records("categories"),
        "mm_transactions": records("transactions", drop=("tags", "attachments")),
        "mm_recurring": records("recurring"),
        "mm_networth": records("networth"),
        "fred_observations": landing.macro_observations(raw_obs),
        "lh_jst": fixed("jst", "lh_jst"),
        "lh_shiller": fixed("shiller", "lh_shiller"),
        "lh_boe": fixed("boe", "lh_boe"),
        "stripe_charges": fixed("charges", "stripe_charges"),
        "stripe_subscriptions": fixed("subscriptions", "stripe_subscriptions"),
        "stripe_customers": fixed("customers", "stripe_customers"),
    }
    seeds = {name: landing.read_seed(spark, f"{root}/{name}.csv", SEEDS[name]) for name in SEEDS}
    log = spark.sql(
        "select * from values ('finance_dev', timestamp'2026-08-19 06:00:00'),"
        " ('outreach_dev', timestamp'2026-08-18 06:00:00') as t(schema_name, inserted_at)"
    )
    return Lake(spark, bronze, seeds, log, as_of, settings, optional=["stripe_invoices"])
