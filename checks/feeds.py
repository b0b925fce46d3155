"""The driver's star-schema tables read as the lake's landed tables.

Every feed is a Spark plan over the whole parquet tables, so the registered queries grow
with them. Columns keep their natural types (the silver casts are then no-ops and
filters reach the scan); text=True gives the all-text bronze form instead.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import Lake, Settings
from ledgerlake.context import literal_rows
from ledgerlake.schemas import BRONZE, SEEDS
from ledgerlake.sources.landing import all_text

AS_OF = date(2001, 11, 4)

SETTINGS = Settings(
    paycheck_category="NATION_6",
    active_prefix="Active",
    roth_prefix="ROTH",
    hsa_cash_prefix="MACHINERY",
    hsa_invested_prefix="FURNITURE",
    defensive_ticker="Brand#6",
    focus_entity="NATION_1",
    revenue_deadline=date(2002, 2, 10),
    valuation_points=(
        ("Dot-com peak", 1, 1999, 12),
        ("Series start", 2, 1995, 1),
        ("Series end", 3, 2001, 7),
        ("Before the series", 4, 1929, 8),
    ),
)

BUDGET_TARGETS = [
    ("AFRICA core", "fixed", "600000", "1999-01-01", "2001-08-31", "First lease"),
    ("AFRICA core", "fixed", "700000", "2001-09-01", "2001-10-31", "Overlap"),
    ("AFRICA core", "fixed", "650000", "2001-11-01", "2999-12-31", "Second lease"),
    ("AFRICA other", "committed", "900000", "1999-01-01", "", "Still in force"),
    ("ASIA core", "flexible", "500000", "1999-01-01", "2999-12-31", ""),
    ("ASIA other", "flexible", "1100000", "2001-09-01", "2999-12-31", "Recent target"),
    ("EUROPE core", "flexible", "400000", "1999-01-01", "2001-10-31", "Expired"),
    ("EUROPE other", "committed", "bad", "1999-01-01", "2999-12-31", "Unreadable target"),
    ("Uncategorized", "flexible", "100", "1999-01-01", "2999-12-31", "Buffer"),
]
REVIEW_CADENCE = [
    ("Quarterly rebalance", "91", "2001-07-01", "schedule", "Check the bands."),
    ("Monthly budget review", "30", "2001-10-20", "schedule", "Read the month."),
    ("Annual strategy review", "365", "2001-05-07", "schedule", "Stress-test the thesis."),
]
SECURITY_MAP = [
    ("Brand#1", "US", "equity", "passive"),
    ("Brand#2", "Intl", "equity", "passive"),
    ("Brand#3", "US", "equity", "conviction"),
    ("Brand#4", "US", "equity", "standard"),
    ("Brand#5", "Intl", "equity", "standard"),
    ("Brand#6", "Intl", "equity", "defensive"),
    ("Brand#7", "NA", "commodity", "inflation_hedge"),
    ("Brand#8", "NA", "cash", "dry_powder"),
    ("Brand#9", "US", "equity", "standard"),
]
# series -> (order priority, order status; * = all of them)
MACRO_CELLS = [
    ("house_prices", "1-URGENT", "*"),
    ("cpi", "2-HIGH", "*"),
    ("industrial_production", "3-MEDIUM", "*"),
    ("oil_wti", "4-NOT SPECIFIED", "*"),
    ("commodities", "5-LOW", "*"),
    ("capacity_utilization", "1-URGENT", "F"),
    ("debt_to_gdp", "1-URGENT", "O"),
    ("fed_funds", "1-URGENT", "P"),
    ("bond_10y", "2-HIGH", "F"),
    ("corp_baa", "2-HIGH", "O"),
    ("yield_curve_10y2y", "2-HIGH", "P"),
    ("dollar_index", "3-MEDIUM", "F"),
    ("real_rate_10y", "3-MEDIUM", "O"),
    ("foreign_treasury", "3-MEDIUM", "P"),
    ("policy_uncertainty", "4-NOT SPECIFIED", "F"),
    ("global_policy_uncertainty", "4-NOT SPECIFIED", "O"),
    ("financial_stress", "4-NOT SPECIFIED", "P"),
    ("vix", "5-LOW", "F"),
    ("recession_prob", "5-LOW", "O"),
]
STATUSES = ("F", "O", "P")

c = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    """Two-decimal double to whole cents. Whole numbers add up exactly and stay cheap."""
    return F.rint(c(column) * 100).cast("bigint")


def money(cents_column: Column) -> Column:
    return (cents_column.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(22,2)")


def day(column: str) -> Column:
    return c(column).cast("date")


def epoch(date_column: Column) -> Column:
    return F.datediff(date_column, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400


def text(column: str) -> Column:
    return c(column).cast("string")


class Feeds:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.read = cache(partial(table, spark, sf_dir))

    # -- personal finance --

    def mm_transactions(self) -> DataFrame:
        # Price after discount in hundredths of a cent, rounded half up to thousandths.
        fine = cents("l_extendedprice") * (F.lit(100) - cents("l_discount"))
        mills = F.call_function("div", fine + 5, F.lit(10)).cast("decimal(15,0)")
        net = (mills * F.lit("0.001").cast("decimal(3,3)")).cast("decimal(18,3)")
        inflow = (c("n_regionkey") == 1) != (c("l_returnflag") == "R")
        lines = (
            self.read("lineitem")
            .join(self.read("supplier"), c("l_suppkey") == c("s_suppkey"))
            .join(self.read("nation"), c("s_nationkey") == c("n_nationkey"))
        )
        return lines.select(
            F.concat(text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("id"),
            day("l_shipdate").alias("date"),
            F.when(inflow, net).otherwise(-net).alias("amount"),
            text("s_nationkey").alias("category__id"),
            c("n_name").alias("category__name"),
            c("s_name").alias("merchant__name"),
            c("l_linestatus").alias("account__id"),
            F.concat(F.lit("Ledger "), c("l_linestatus")).alias("account__display_name"),
            (c("l_returnflag") == "A").alias("is_recurring"),
            (c("l_linestatus") == "O").alias("pending"),
            (cents("l_tax") == 8).alias("hide_from_reports"),
        )

    def mm_categories(self) -> DataFrame:
        kind = F.when(c("r_name") == "AMERICA", "income").when(
            c("r_name") == "MIDDLE EAST", "transfer"
        )
        half = F.when(c("n_nationkey") < 10, " core").otherwise(" other")
        return (
            self.read("nation")
            .join(self.read("region"), c("n_regionkey") == c("r_regionkey"))
            .where(c("n_name") != "NATION_23")  # one nation stays without a category
            .select(
                text("n_nationkey").alias("id"),
                c("n_name").alias("name"),
                F.concat("r_name", half).alias("group__name"),
                kind.otherwise("expense").alias("group__type"),
            )
        )

    def mm_accounts(self) -> DataFrame:
        segment = c("c_mktsegment")
        kind = (
            F.when(segment.isin("BUILDING", "MACHINERY"), "Cash")
            .when(segment == "AUTOMOBILE", "Investments")
            .when((segment == "HOUSEHOLD") & (c("c_acctbal") < 0), "Loans")
            .when(segment == "HOUSEHOLD", "Credit Cards")
            .otherwise("Vehicle")
        )
        return self.read("customer").select(
            text("c_custkey").alias("id"),
            F.concat("c_mktsegment", F.lit(" "), "c_name").alias("display_name"),
            money(cents("c_acctbal")).alias("current_balance"),
            (c("c_acctbal") >= 0).alias("is_asset"),
            ((segment != "MACHINERY") | (c("c_nationkey") != 3)).alias("include_in_net_worth"),
            kind.alias("type__display"),
            F.concat(F.lit("Bank "), text("c_nationkey")).alias("institution__name"),
            text("c_custkey").alias("order"),
        )

    def mm_recurring(self) -> DataFrame:
        price = cents("o_totalprice")
        amount = money(F.when(c("o_orderstatus") == "P", price).otherwise(-price))
        return self.read("orders").select(
            F.date_add(day("o_orderdate"), 120).alias("date"),
            amount.alias("amount"),
            c("o_orderpriority").alias("stream__frequency"),
            F.concat(F.lit("Payee "), text("o_custkey")).alias("stream__merchant__name"),
            c("o_orderstatus").alias("category__name"),
            F.concat(F.lit("Ledger "), text("o_orderkey")).alias("account__display_name"),
        )

    def mm_networth(self) -> DataFrame:
        return (
            self.read("orders")
            .groupBy(day("o_orderdate").alias("date"))
            .agg(money(F.sum(cents("o_totalprice"))).alias("balance"))
        )

    def mm_holdings(self) -> DataFrame:
        size = c("p_size")
        kind = (
            F.when(c("p_type").isin("LARGE", "MEDIUM"), "equity")
            .when(c("p_type") == "SMALL", "bond")
            .when(c("p_type") == "ECONOMY", "cash")
            .when(c("p_type") == "STANDARD", "commodity")
            .otherwise("etf")
        )
        unmatched = (c("p_type") == "PROMO") & (size == 50)
        account = (
            F.when(size <= 20, "Active Investing").when(size <= 35, "ROTH IRA").otherwise("Joint")
        )
        return self.read("part").select(
            account.alias("account"),
            text("p_size").alias("account_id"),
            F.when(~unmatched, c("p_brand")).alias("ticker"),
            c("p_name").alias("name"),
            kind.alias("security_type"),
            money(cents("p_retailprice") * size).alias("market_value"),
            text("p_size").alias("quantity"),
            money(cents("p_retailprice")).alias("basis"),
            money(cents("p_retailprice") - 95000).alias("change_pct"),
        )

    # -- macro and long history --

    def fred_observations(self) -> DataFrame:
        cells = [
            (name, "ID_" + name.upper(), priority, status)
            for name, priority, wanted in MACRO_CELLS
            for status in (STATUSES if wanted == "*" else (wanted,))
        ]
        cells = literal_rows(
            self.spark, ["series", "series_id", "o_orderpriority", "o_orderstatus"], cells
        )
        daily = (
            self.read("orders")
            .groupBy(day("o_orderdate").alias("obs_date"), "o_orderpriority", "o_orderstatus")
            .agg(F.sum(cents("o_totalprice")).alias("total"))
        )
        scaled = money(F.sum("total")) * F.lit("0.0002").cast("decimal(4,4)")
        return (
            daily.join(F.broadcast(cells), ["o_orderpriority", "o_orderstatus"])
            .groupBy("series", "series_id", "obs_date")
            .agg(scaled.cast("decimal(28,4)").alias("obs_value"))
        )

    def _panel(self, wide: DataFrame, ids: list[str], series: list[str]) -> DataFrame:
        return wide.select(*ids, *[c(s).cast("decimal(28,4)") for s in series]).unpivot(
            ids, series, "series", "value"
        )

    def lh_jst(self) -> DataFrame:
        """Months stand in for years: 80 steps per entity, counted from 1870."""
        step = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") + 1869
        price = cents("o_totalprice")
        placed = (
            self.read("orders")
            .join(self.read("customer").select("c_custkey", "c_nationkey"), c("o_custkey") == c("c_custkey"))
            .groupBy("c_nationkey", step.alias("year"))
            .agg(
                money(F.sum(price)).alias("house_prices_nominal"),
                F.count(F.lit(1)).alias("cpi"),
                money(F.sum(price)).alias("nominal_gdp"),
                money(F.sum(F.when(c("o_orderstatus") != "P", price))).alias("total_loans"),
                F.count_if(c("o_orderpriority") == "1-URGENT").alias("public_debt_to_gdp"),
            )
        )
        named = placed.join(self.read("nation"), c("c_nationkey") == c("n_nationkey")).select(
            c("n_name").alias("entity"),
            "year",
            F.lit(0).alias("period"),
            "house_prices_nominal", "cpi", "nominal_gdp", "total_loans", "public_debt_to_gdp",
        )
        return self._panel(
            named,
            ["entity", "year", "period"],
            ["house_prices_nominal", "cpi", "nominal_gdp", "total_loans", "public_debt_to_gdp"],
        )

    def lh_shiller(self) -> DataFrame:
        price = cents("o_totalprice")
        monthly = (
            self.read("orders")
            .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("period"))
            .agg(money(F.sum(price)).alias("price"), F.count(F.lit(1)).alias("cpi"))
            .select(
                F.lit("USA").alias("entity"),
                "year",
                "period",
                (c("price").cast("double") / c("cpi") / 10000.0).alias("cape"),
                c("price").cast("double").alias("price"),
                c("cpi").cast("double").alias("cpi"),
            )
        )
        return monthly.unpivot(["entity", "year", "period"], ["cape", "price", "cpi"], "series", "value")

    def lh_boe(self) -> DataFrame:
        yearly = (
            self.read("orders")
            .groupBy(F.year("o_orderdate").alias("year"))
            .agg(money(F.sum(cents("o_totalprice"))).alias("public_debt"), F.count(F.lit(1)).alias("bank_rate"))
            .select(F.lit("GBR").alias("entity"), "year", F.lit(0).alias("period"), "public_debt", "bank_rate")
        )
        return self._panel(yearly, ["entity", "year", "period"], ["public_debt", "bank_rate"])

    # -- revenue --

    def stripe_charges(self) -> DataFrame:
        amount = cents("o_totalprice")
        failed = c("o_orderpriority") == "4-NOT SPECIFIED"
        partial_refund = c("o_orderstatus") == "P"
        return self.read("orders").select(
            F.concat(F.lit("ch_"), text("o_orderkey")).alias("id"),
            amount.alias("amount"),
            F.when(partial_refund, F.call_function("div", amount, F.lit(2)))
            .otherwise(F.lit(0).cast("bigint"))
            .alias("amount_refunded"),
            F.lit("usd").alias("currency"),
            epoch(F.date_add(day("o_orderdate"), 60)).alias("created"),
            F.when(failed, "failed").otherwise("succeeded").alias("status"),
            (~failed).alias("paid"),
            partial_refund.alias("refunded"),
            c("o_orderpriority").alias("description"),
            F.concat(F.lit("cus_"), text("o_custkey")).alias("customer"),
            F.when(partial_refund, F.concat(F.lit("in_"), text("o_orderkey"))).alias("invoice"),
            (c("o_orderpriority") != "5-LOW").alias("livemode"),
        )

    def stripe_subscriptions(self) -> DataFrame:
        segment = c("c_mktsegment")
        return self.read("customer").select(
            F.concat(F.lit("sub_"), text("c_custkey")).alias("id"),
            F.when(segment.isin("BUILDING", "AUTOMOBILE"), "active").otherwise("canceled").alias("status"),
            (F.lit(946684800).cast("bigint") + c("c_nationkey") * 86400).alias("created"),
            F.concat(F.lit("cus_"), text("c_custkey")).alias("customer"),
            (c("c_acctbal") < 0).alias("cancel_at_period_end"),
            (segment != "FURNITURE").alias("livemode"),
        )

    def stripe_customers(self) -> DataFrame:
        return self.read("customer").select(
            F.concat(F.lit("cus_"), text("c_custkey")).alias("id"),
            (F.lit(946684800).cast("bigint") + c("c_nationkey") * 86400).alias("created"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.test")).alias("email"),
            F.when(c("c_mktsegment") != "HOUSEHOLD", c("c_name")).alias("name"),
            (c("c_acctbal") < 0).alias("delinquent"),
            (c("c_mktsegment") != "FURNITURE").alias("livemode"),
        )

    # -- outreach --

    def leads_master(self) -> DataFrame:
        segment, nation = c("c_mktsegment"), c("c_nationkey")
        found = F.date_add(F.lit("2001-01-01").cast("date"), nation)
        return self.read("customer").select(
            text("c_custkey").alias("id"),
            c("c_name").alias("name"),
            F.concat("c_mktsegment", F.lit(" practice")).alias("practice_name"),
            segment.alias("specialty"),
            F.concat(F.lit("City "), text("c_nationkey")).alias("city"),
            F.concat(F.lit("S"), text("c_nationkey")).alias("state"),
            F.concat(F.lit("https://"), text("c_custkey"), F.lit(".example")).alias("website"),
            F.concat(F.lit("  Lead."), text("c_custkey"), F.lit("@Example.TEST ")).alias("email"),
            found.cast("string").alias("found_date"),
            F.lit("registry").alias("source"),
            F.lower(segment).alias("status"),
            F.lit("blog, newsletter").alias("content_signals"),
            F.when(segment == "BUILDING", "true")
            .when(segment == "MACHINERY", "No idea")
            .when(segment == "FURNITURE", "FALSE")
            .when(segment == "HOUSEHOLD", "Yes")
            .alias("linkedin_active"),
            F.when(nation < 8, "A").when(nation < 16, "B").when(nation < 22, "C").alias("angle_assigned"),
            F.when(nation == 4, "call back later")
            .otherwise(F.date_add(found, 30).cast("string"))
            .alias("last_touch_date"),
            F.when(nation == 7, "2001-02-30").otherwise(F.date_add(found, 60).cast("string")).alias(
                "next_action_date"
            ),
            F.when(c("c_acctbal") > 0, "Y").otherwise("N").alias("has_team"),
            F.when(nation > 12, "Y").alias("operator_visible"),
            F.when(segment == "BUILDING", "personal").otherwise("N").alias("email_list"),
            F.lit("personal").alias("contact_type"),
            segment.alias("segment"),
            F.concat(F.lit("note, line one\r\nline two for "), "c_name").alias("notes"),
        )

    def touch_log(self) -> DataFrame:
        kind, k = c("event_type"), F.get_json_object("props", "$.k")
        score = k.cast("int")
        channel = (
            F.when(kind.isin("view", "click"), "email").when(kind == "purchase", "call").otherwise("linkedin")
        )
        return self.read("events").select(
            text("event_id").alias("touch_id"),
            text("user_id").alias("lead_id"),
            day("ts").alias("date"),
            channel.alias("channel"),
            k.alias("touch_number"),
            F.when(score < 33, "A").when(score < 66, "B").when(score < 95, "C").alias("angle"),
            F.concat(F.lit("About "), kind).alias("subject_line"),
            F.when(kind == "purchase", "Yes").when(kind == "error", "maybe").otherwise("no").alias("replied"),
            F.when(kind == "purchase", "positive").alias("reply_sentiment"),
            F.when(c("value") > 20, "budget").alias("objection_tag"),
            c("props").alias("notes"),
            F.when(kind.isin("purchase", "click"), "yes").otherwise("NO").alias("opened"),
        )

    def load_log(self) -> DataFrame:
        def loads(name: str, stamp: str, *pipelines: str) -> DataFrame:
            newest = self.read(name).agg(F.max(stamp).alias("inserted_at"))
            names = F.array(*[F.lit(p) for p in pipelines])
            return newest.select(F.explode(names).alias("schema_name"), "inserted_at")

        return (
            loads("orders", "o_orderdate", "macro_daily", "stripe_daily")
            .unionByName(loads("lineitem", "l_shipdate", "finance_daily"))
            .unionByName(loads("events", "ts", "outreach"))
        )


BRONZE_FEEDS = [name for name in vars(Feeds) if name.startswith(("mm_", "fred_", "lh_", "stripe_", "leads_", "touch_"))]


def lake(spark: SparkSession, sf_dir: str, text_bronze: bool = False, settings: Settings = SETTINGS) -> Lake:
    feeds = Feeds(spark, sf_dir)

    def bronze(name: str) -> Callable[[], DataFrame]:
        make = getattr(feeds, name)
        return (lambda: all_text(make())) if text_bronze else make

    def seed(name: str, rows) -> Callable[[], DataFrame]:
        return lambda: literal_rows(spark, SEEDS[name], rows)

    seeds = {
        "budget_targets": seed("budget_targets", BUDGET_TARGETS),
        "review_cadence": seed("review_cadence", REVIEW_CADENCE),
        "security_map": seed("security_map", SECURITY_MAP),
    }
    return Lake(
        spark,
        {name: bronze(name) for name in BRONZE_FEEDS},
        seeds,
        feeds.load_log,
        AS_OF,
        settings,
        optional=BRONZE,
    )
