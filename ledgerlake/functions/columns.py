"""Column helpers: safe typing, exact rounding, guarded ratios, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,3)"
NULL_WORDS = ("", "nan", "NaN", "None", "NaT")


class Typed:
    """Safe casts for the columns of one frame.

    A column that already has the wanted type is passed through untouched, so typed
    input keeps its filters pushable down to the scan; text goes through a cast that
    gives null on bad input.
    """

    def __init__(self, df: DataFrame):
        self._types = {f.name: f.dataType for f in df.schema.fields}

    def _is_text(self, name: str) -> bool:
        return isinstance(self._types[name], T.StringType)

    def text(self, name: str) -> Column:
        c = F.col(name)
        return c if self._is_text(name) else c.cast("string")

    def number(self, name: str) -> Column:
        return F.col(name).try_cast(MONEY)

    def ratio(self, name: str) -> Column:
        """Index and ratio series: double, with text NaN read as missing."""
        value = F.col(name).try_cast("double")
        return F.nullif(value, F.lit(float("nan"))) if self._is_text(name) else value

    def integer(self, name: str, to: str = "int") -> Column:
        """Whole number, rounding a fraction half away from zero (not truncating)."""
        if not self._is_text(name):
            return F.col(name).try_cast(to)
        return F.round(F.col(name).try_cast("decimal(38,6)"), 0).try_cast(to)

    def date(self, name: str) -> Column:
        """Full calendar dates only: Spark alone would read '2026' as 1 January 2026."""
        c = F.col(name)
        if not self._is_text(name):
            return c.try_cast("date")
        return F.when(c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}(\s*$|[ T])"), F.trim(c).try_cast("date"))

    def flag(self, name: str) -> Column:
        c = F.col(name)
        return c if isinstance(self._types[name], T.BooleanType) else F.lower(c) == "true"

    def epoch_date(self, name: str) -> Column:
        """Epoch seconds to the UTC calendar day."""
        return F.date_add(
            F.lit("1970-01-01").cast("date"),
            F.floor(self.integer(name, "bigint") / 86400).cast("int"),
        )


def tri_flag(col: Column, yes: Sequence[str], no: Sequence[str]) -> Column:
    """Text to true / false / null, ignoring case."""
    low = F.lower(col)
    return F.when(low.isin(*yes), F.lit(True)).when(low.isin(*no), F.lit(False))


def one_zero(flag: Column) -> Column:
    """Additive 1/0 measure; null counts as 0."""
    return F.when(flag, 1).otherwise(0)


def round_to(value: Column, digits: int = 0) -> Column:
    """Round a double half away from zero on its scaled binary value.

    Spark's own round(double, n) goes through the decimal text of the number, which gives
    another answer for values such as 1.005. Scaling first matches warehouses that round
    in binary; like them, a small negative rounds to -0.0.
    """
    scale = float(10**digits)
    number = value.cast("double")
    rounded = F.round(number * scale)
    signed = F.when(number < 0, -F.abs(rounded)).otherwise(rounded)
    return signed / scale if digits else signed


def round_money(value: Column, digits: int = 0) -> Column:
    """Round an exact decimal, then hand it out as double."""
    return F.round(value, digits).cast("double")


def ratio(part: Column, whole: Column, factor: int = 1) -> Column:
    """factor * part / whole in double, null when the denominator is zero."""
    scaled = part * F.lit(factor) if factor != 1 else part
    return scaled.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return round_to(ratio(part, whole, 100), digits)


def change_percent(now: Column, before: Column, digits: int = 1, absolute_base: bool = False) -> Column:
    base = F.abs(before) if absolute_base else before
    return percent(now - before, base, digits)


def direction(now: Column, before: Column) -> Column:
    """up / down / flat; a missing earlier value reads as flat."""
    return F.when(now > before, "up").when(now < before, "down").otherwise("flat")


# Percentile cut-offs shared by every history label.
LEVEL_CUTS = ((0.90, "extreme"), (0.70, "elevated"), (0.30, "normal"))


def history_level(pctile: Column, lowest: str) -> Column:
    return step_label(pctile, LEVEL_CUTS, lowest)


def step_label(value: Column, floors: Sequence[tuple[float, str]], below: str) -> Column:
    """Label of the first floor the value reaches; `floors` run from high to low."""
    (floor, name), *rest = floors
    chain = F.when(value >= floor, name)
    for floor, name in rest:
        chain = chain.when(value >= floor, name)
    return chain.otherwise(below)


def bin_label(value: Column, ceilings: Sequence[tuple[float, str]], above: str, missing: str | None = None) -> Column:
    """Half-open bins: label of the first ceiling the value stays under."""
    chain = F.when(value.isNull(), missing) if missing is not None else None
    for ceiling, name in ceilings:
        test = value < ceiling
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain.otherwise(above)


def in_band(value: Column, low: float, high: float) -> Column:
    return (value >= low) & (value <= high)


def age_days(as_of: Column, newest: Column) -> Column:
    return F.datediff(as_of, newest)


def month_of(date: Column) -> Column:
    return F.trunc(date, "month")


def number_text(value: Column) -> Column:
    """Shortest plain text of a number: 54.0 -> '54.0', 12.5 -> '12.5'."""
    return F.when(value.isNotNull(), F.format_string("%.1f", value.cast("double")))


def whole_text(value: Column) -> Column:
    """Nearest whole number as text, rounding (a plain cast would truncate)."""
    return F.round(value, 0).cast("bigint").cast("string")
