"""The lake: landed tables, seeds, settings and the as-of date, and the model registry.

A model is a plain function Lake -> DataFrame registered under a name. `lake.ref(name)`
builds it, and with it everything it reads; the result is one lazy logical plan, so
there is nothing to schedule.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import fixed_values as fixed
from ledgerlake import schemas
from ledgerlake.operators.periods import Month
from ledgerlake.session import cut_lineage

Model = Callable[["Lake"], DataFrame]
MODELS: dict[str, tuple[str, Model]] = {}


def model(layer: str) -> Callable[[Model], Model]:
    """Register a function as a named table of a layer (silver, gold, ephemeral)."""

    def register(fn: Model) -> Model:
        MODELS[fn.__name__] = (layer, fn)
        return fn

    return register


@dataclass(frozen=True)
class Settings:
    """What differs between installations: names, prefixes, labels, dates."""

    paycheck_category: str = "Paycheck"
    active_prefix: str = "Active Investing"
    roth_prefix: str = "ROTH"
    hsa_cash_prefix: str = "HSA Cash"
    hsa_invested_prefix: str = "HSA Investment"
    defensive_ticker: str = "VYMI"
    focus_entity: str = "USA"
    revenue_deadline: date = fixed.REVENUE_DEADLINE
    intervals_half: int = 5
    intervals_gap: int = 2
    trough_half: int = 60
    legacy_targets: bool = False
    valuation_points: Sequence[tuple] = tuple(fixed.VALUATION_POINTS)
    # Load-log schema names start with these; the rest counts as `bronze`.
    load_prefixes: Mapping[str, str] = field(
        default_factory=lambda: {
            "macro": "macro",
            "longhistory": "longhistory",
            "finance": "finance",
            "stripe": "stripe",
        }
    )
    source_labels: Mapping[str, str] = field(
        default_factory=lambda: {
            "transactions": "Bank transactions",
            "macro_fast": "FRED macro (fastest series)",
            "macro_slow": "FRED macro (slowest series)",
            "valuation": "Shiller CAPE",
            "country_panel": "JST macrohistory",
            "millennium": "Bank of England millennium",
            "revenue": "Stripe revenue",
            "leads": "Outreach leads",
        }
    )


def table_exists(spark: SparkSession, live: str) -> bool:
    """Whether the table is there, after bringing it back if a swap died between its renames."""
    if spark.catalog.tableExists(live):
        return True
    if spark.catalog.tableExists(f"{live}__old"):
        spark.sql(f"alter table {live}__old rename to {live}")
        return True
    return False


class Lake:
    def __init__(
        self,
        spark: SparkSession,
        bronze: Mapping[str, DataFrame | Callable[[], DataFrame]],
        seeds: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
        load_log: DataFrame | Callable[[], DataFrame] | None = None,
        as_of: date | None = None,
        settings: Settings = Settings(),
        optional: Iterable[str] = (),
    ):
        """Inputs not given by hand are read from the tables that were loaded, bronze.<name>,
        seeds among them, and bronze.load_log. One that is in neither place is an error, unless
        it is `optional`: then it is empty."""
        self.spark = spark
        self.as_of = as_of or spark.sql("select current_date()").head()[0]
        self.settings = settings
        self._bronze = dict(bronze)
        self._seeds = dict(seeds or {})
        self._load_log = load_log
        self._optional = set(optional)
        self._built: dict[str, DataFrame] = {}
        self._settled: set[str] = set()

    # -- inputs --

    def _input(self, name: str, given: Mapping, columns: Sequence[str]) -> DataFrame:
        if name in given:
            found = given[name]() if callable(given[name]) else given[name]
        elif table_exists(self.spark, f"bronze.{name}"):
            found = self.spark.table(f"bronze.{name}")
        elif name in self._optional:
            return self.spark.createDataFrame([], schemas.text_schema(columns))
        else:
            raise LookupError(f"{name} was neither given nor loaded, and is not optional")
        return schemas.with_missing(found, columns)

    def is_given(self, name: str) -> bool:
        """Whether a landed table was handed in instead of being read from where it was loaded."""
        return name in self._bronze

    def source(self, name: str) -> DataFrame:
        """A landed table with all its declared columns."""
        return self._input(name, self._bronze, schemas.BRONZE[name])

    def seed(self, name: str) -> DataFrame:
        return self._input(name, self._seeds, schemas.SEEDS[name])

    def load_log(self) -> DataFrame:
        if self._load_log is not None:
            return self._load_log() if callable(self._load_log) else self._load_log
        if table_exists(self.spark, "bronze.load_log"):
            return self.spark.table("bronze.load_log")
        return self.spark.createDataFrame([], schemas.LOAD_LOG)

    # -- tables --

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = MODELS[name][1](self)
        return self._built[name]

    def settle(self, *names: str) -> None:
        """Compute small tables once, now, and let later refs read the result.

        For one- to few-row tables that several others build on: without this each of
        them would repeat the scan behind it.
        """
        for name in names:
            if name not in self._settled:
                self._built[name] = cut_lineage(self.ref(name))
                self._settled.add(name)

    def settle_rows(self, *names: str) -> None:
        """Like settle, for aggregates of exactly one row each: all of them in one job, kept in the plan itself."""
        wanted = [name for name in names if name not in self._settled]
        if not wanted:
            return
        rows = [self.ref(name).select(F.struct("*").alias(name)) for name in wanted]
        together = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), rows).limit(2).toArrow()
        if together.num_rows != 1:
            raise ValueError(f"{', '.join(wanted)} must have one row each")
        row = self.spark.createDataFrame(together)
        for name in wanted:
            self.use(name, row.select(f"{name}.*"))

    def is_settled(self, name: str) -> bool:
        """Whether the table is read from what was computed or written before."""
        return name in self._settled

    def use(self, name: str, df: DataFrame) -> None:
        """Read a table from where it was written instead of building it again."""
        self._built[name] = df
        self._settled.add(name)

    # -- dates --

    @property
    def today(self):
        return F.lit(self.as_of)

    @property
    def month(self) -> Month:
        return Month(self.as_of)

    def days_ago(self, days: int):
        return F.lit(self.as_of - timedelta(days=days))


def sql_literal(value: Any) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, date):
        return f"date'{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def literal_rows(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[Any]]) -> DataFrame:
    """A small fixed relation: a local scan whose size the planner knows."""
    body = ", ".join("(" + ", ".join(map(sql_literal, row)) + ")" for row in rows)
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"select * from values {body} as fixed({names})")
