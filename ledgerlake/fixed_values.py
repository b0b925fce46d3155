"""Series names, thresholds, labels and wording of the gold tables.

Nothing here is logic. The values have to be exactly these for the tables to come out
right, so they are stated once, in natural order, and everything else refers to them.
"""

from __future__ import annotations

from datetime import date

# --- landing -------------------------------------------------------------------------

# Days of history kept per macro series: name -> (source id, days).
MACRO_SERIES = {
    "oil_wti": ("DCOILWTICO", 800),
    "cpi": ("CPIAUCSL", 60000),
    "commodities": ("PPIACO", 800),
    "fed_funds": ("DFF", 800),
    "bond_10y": ("DGS10", 800),
    "yield_curve_10y2y": ("T10Y2Y", 800),
    "industrial_production": ("INDPRO", 800),
    "corp_baa": ("BAA", 800),
    "capacity_utilization": ("TCU", 60000),
    "debt_to_gdp": ("GFDEGDQ188S", 60000),
    "house_prices": ("CSUSHPINSA", 60000),
    "dollar_index": ("DTWEXBGS", 60000),
    "real_rate_10y": ("DFII10", 60000),
    "foreign_treasury": ("FDHBFIN", 60000),
    "policy_uncertainty": ("USEPUINDXD", 60000),
    "global_policy_uncertainty": ("GEPUCURRENT", 60000),
    "financial_stress": ("STLFSI4", 60000),
    "vix": ("VIXCLS", 60000),
    "recession_prob": ("RECPROUSM156N", 60000),
}
TRANSACTION_DAYS = 400

MONTHLY_EQUITY_COLUMNS = {
    "P": "price",
    "D": "dividend",
    "E": "earnings",
    "CPI": "cpi",
    "Rate GS10": "long_rate",
    "CAPE": "cape",
}
COUNTRY_PANEL_COLUMNS = {
    "hpnom": "house_prices_nominal",
    "cpi": "cpi",
    "gdp": "nominal_gdp",
    "debtgdp": "public_debt_to_gdp",
    "tloans": "total_loans",
    "ltrate": "long_rate",
    "stir": "short_rate",
    "eq_tr": "equity_total_return",
    "bond_tr": "bond_total_return",
}
# Position -> (series, text its description must start with).
MILLENNIUM_COLUMNS = {
    22: ("nominal_gdp", "Nominal UK GDP at market prices"),
    27: ("unemployment", "Unemployment rate"),
    40: ("cpi", "Consumer price index"),
    44: ("bank_rate", "Bank Rate"),
    47: ("long_rate", "Consols / long-term government bond yields"),
    51: ("share_prices", "Share prices"),
    56: ("house_prices", "House price index"),
    72: ("public_debt", "UK Public sector debt"),
}
DESCRIPTION_PREFIX = 18

# --- portfolio -----------------------------------------------------------------------

SLEEVE_CAPS = {"conviction": 12, "standard": 7}
US_BAND = (50.0, 55.0)
EVIDENCE_ZONE = (11.0, 55.0)
THIN_COVERAGE_PCT = 6.25
HSA_CASH_FLOOR = 2000.0
BUFFER_MONTHS = 3
INTL_FLOOR_PCT = 45.0
SMALL_ACCOUNT = 15000
MAX_STANDARD_POSITIONS = 7
DEFENSIVE_BAND = (25, 35)
HEDGE_CEILING_PCT = 5
POWDER_CEILING_PCT = 15

WEATHER_BOXES = [
    ("rising_growth_falling_inflation", 1, "Growth up, inflation down", "rising", "falling",
     "Equities, corporate credit"),
    ("rising_growth_rising_inflation", 2, "Growth up, inflation up", "rising", "rising",
     "Broad commodities and energy, inflation-linked bonds, value and cyclical stocks"),
    ("falling_growth_falling_inflation", 3, "Growth down, inflation down", "falling", "falling",
     "Long treasuries, cash"),
    ("falling_growth_rising_inflation", 4, "Growth down, inflation up", "falling", "rising",
     "Gold above all, inflation-linked bonds, cash. Equities do badly here"),
]
BOX_MEMBERS = [
    ("rising_growth_falling_inflation", "equity"),
    ("rising_growth_rising_inflation", "commodity"),
    ("falling_growth_falling_inflation", "bond"),
    ("falling_growth_falling_inflation", "cash"),
    ("falling_growth_rising_inflation", "commodity"),
]
UNCOVERED_BY_DESIGN = "falling_growth_falling_inflation"
BY_DESIGN_REASON = (
    "Uncovered on purpose. Covering this box needs long treasuries; the thesis holds zero "
    "bonds on Cederburg evidence at this horizon."
)

# key -> (severity, area, title, detail, unit)
PORTFOLIO_RULES = {
    "hsa": (1, "HSA", "Invest the HSA",
            "Cash has crossed the $2,000 threshold and the investment account is empty. "
            "Mirror the Roth at 55/45.", "$"),
    "buffer": (1, "Cash", "Rebuild the emergency buffer",
               "Liquid cash is below three months of expenses. "
               "Do not add to Active until this clears.", "$"),
    "us_ceiling": (2, "Geography", "Route contributions to international",
                   "Active US equity is above the 55% ceiling. "
                   "Correct with new contributions, never by selling.", "%"),
    "intl_floor": (2, "Geography", "International below the 45% floor",
                   "Deployment rule 1: while international is under 45% of Active equity, "
                   "100% of new money goes to VXUS or VYMI.", "%"),
    "standard_count": (2, "Positions", "Consolidate standard positions",
                       "Active is under $15K, which caps standard positions at 7. "
                       "Consolidate before adding anything new.", " positions"),
    "over_cap": (2, "Positions", "Trim positions over their cap",
                 "One or more holdings exceed the sleeve cap "
                 "(7% standard, 12% conviction under $15K).", " positions"),
    "defensive": (3, "Sleeves", "Defensive sleeve inside 25-35%",
                  "VYMI is the defensive sleeve. "
                  "Outside the band, rebalance at the quarterly review.", "%"),
    "hedge": (3, "Sleeves", "Inflation hedge inside 0-5%",
              "GLD fills this sleeve and is the only asset covering either inflationary "
              "environment.", "%"),
    "powder": (3, "Sleeves", "Dry powder inside 0-15%",
               "SPAXX. Above 15% is uninvested drag; the thesis says cash loses in the long "
               "run.", "%"),
}

# --- macro ---------------------------------------------------------------------------

GROWTH_FLOOR = 0.5
INFLATION_FLOOR = 2.5

# (order, name, debt/GDP from, up to, description, implication)
DEBT_STAGES = [
    (1, "New world order", 0.0, 60.0,
     "New reserve currency established, low debt, strong currency",
     "Standard allocation, no debasement hedge needed"),
    (2, "Peace and prosperity", 60.0, 80.0,
     "Growth-fueled expansion, debt still manageable", "Standard allocation"),
    (3, "Debt bubble", 80.0, 100.0,
     "Debt accumulating, financial engineering rising", "Monitor, slight gold bias"),
    (4, "Top of cycle", 100.0, 130.0,
     "Peak power, internal conflict rising, rival emerging",
     "Validate gold toward cap, international bias"),
    (5, "Decline", 130.0, 999.0,
     "Debt monetization, currency weakness, reserve status eroding",
     "Max gold within cap, heavy international bias"),
    (6, "New world order (next)", 999.0, 9999.0,
     "Reserve currency transfer complete", "Outside framework scope"),
]
UNDETECTABLE_STAGE = 6
DEBASEMENT_BINS = [(100.0, "low"), (130.0, "medium")]

# (order, criterion, series, explanation, unit)
DECLINE_CRITERIA = [
    (1, "Debt above 130% of GDP", "debt_to_gdp",
     "Dalio puts the decline stage past 130%. Below that, high debt on its own is not decline.",
     "percent of GDP"),
    (2, "Real interest rates negative", "real_rate_10y",
     "The clearest debasement tell. Negative real rates mean lenders are being paid back in "
     "money worth less than they lent.", "percent, 10y TIPS yield"),
    (3, "Foreign investors selling Treasuries", "foreign_treasury",
     "Decline means the world stops funding you. Rising foreign holdings mean the opposite.",
     "$B held by foreign investors"),
    (4, "Dollar in a falling trend", "dollar_index",
     "A sustained slide in the trade-weighted dollar is the price of losing reserve-currency "
     "pull.", "broad trade-weighted index"),
]
DECLINE_DEBT = 130.0

# (series, order, label, explanation)
CLIMATE_LABELS = [
    ("policy_uncertainty", 1, "US policy uncertainty",
     "Counts newspaper articles about economic policy uncertainty. "
     "High means the press is full of it."),
    ("global_policy_uncertainty", 2, "Global policy uncertainty",
     "The same newspaper-count method applied across major economies."),
    ("financial_stress", 3, "Financial stress",
     "St. Louis Fed index of 18 market indicators. "
     "Zero is normal; negative means calmer than average."),
    ("vix", 4, "Equity volatility (VIX)",
     "What options markets charge for protection. "
     "The market pricing its own fear, in real money."),
    ("recession_prob", 5, "Recession probability",
     "Smoothed model probability that the economy is currently in recession."),
]

# (label, order, year, month)
VALUATION_POINTS = [
    ("Dot-com peak", 1, 1999, 12),
    ("Late 2021", 2, 2021, 11),
    ("1929 peak", 3, 1929, 8),
    ("2007 peak", 4, 2007, 5),
    ("1982 low", 5, 1982, 7),
]

CREDIT_TREND_STEP = 10.0
CYCLE_YEARS = 18.0
PHASE_BINS = [
    (7.0, "Recovery"),
    (9.0, "Mid-cycle slowdown"),
    (14.0, "Expansion"),
    (16.0, "Mania / peak"),
    (18.0, "Downturn"),
]
PAST_HORIZON = "Past model horizon (new cycle unconfirmed)"
# Interval histogram: upper end (inclusive), label, sort key.
INTERVAL_BUCKETS = [(11, "6-11", 1), (15, "12-15", 2), (20, "16-20", 3), (25, "21-25", 4)]
INTERVAL_OVERFLOW = ("26+", 5)

# --- revenue and review --------------------------------------------------------------

REVENUE_DEADLINE = date(2027, 2, 10)
CLIENTS_TARGET = (2, 3)
DAYS_PER_MONTH = 30.44
DAYS_PER_YEAR = 365.25
REVENUE_DETAIL = (
    "Miss it and the premium-warm motion is wrong, which triggers a pivot review rather than "
    "more volume."
)
FAST_SERIES = ["fed_funds", "bond_10y", "vix", "dollar_index"]
SLOW_SERIES = ["debt_to_gdp", "foreign_treasury", "capacity_utilization"]
# key -> (order, pipeline, expected lag in days, what it feeds)
FRESHNESS_SOURCES = {
    "transactions": (1, "finance", 3,
                     "Spending, income, categories. Everything on the Budget tab."),
    "macro_fast": (2, "macro", 5, "Regime, equilibriums, rates, the news climate."),
    "macro_slow": (3, "macro", 120,
                   "Debt/GDP and foreign Treasury holdings are quarterly, so they lag by "
                   "design."),
    "valuation": (4, "longhistory", 400,
                  "Valuation percentile over 144 years. Revised roughly annually."),
    "country_panel": (5, "longhistory", 800,
                      "Credit and public debt context, and the 18-year cycle test. "
                      "Dataset ends where it ends."),
    "millennium": (6, "longhistory", 1200, "Reference only. Not currently driving any panel."),
    "revenue": (7, "stripe", 30, "Revenue against the 2027-02-10 venture binary."),
    "leads": (8, "bronze", 30, "Outreach funnel."),
}
TOUCH_CHANNELS = ["call", "email", "linkedin"]
