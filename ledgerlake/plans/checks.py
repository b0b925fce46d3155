"""Checks that each model has to pass before a build goes on, and one report of them all."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed_values as fixed
from ledgerlake.operators import quality

Read = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Checks:
    """What must hold for a model: unique and not-null columns, accepted values, parents."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    #: column -> (parent model, parent's column)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)


BOXES = tuple(f"{g}_growth_{i}_inflation" for g in ("rising", "falling") for i in ("rising", "falling"))

DECLARED: dict[str, Checks] = {
    "stg_leads": Checks(unique=("lead_id",), not_null=("lead_id",)),
    "stg_touches": Checks(
        unique=("touch_id",),
        not_null=("touch_id", "lead_id"),
        accepted={"channel": tuple(fixed.TOUCH_CHANNELS)},
        parents={"lead_id": ("stg_leads", "lead_id")},
    ),
    "stg_holdings": Checks(not_null=("ticker",)),
    "mart_all_weather": Checks(unique=("box",), not_null=("box",), accepted={"box": BOXES}),
    "mart_debasement_signals": Checks(unique=("criterion_order",), not_null=("criterion_order",)),
}


def failures(name: str, rows: DataFrame, read: Read) -> DataFrame:
    """model, check, failing_rows of one model: one pass for all columns, one for each key."""
    declared = DECLARED[name]
    parts = [quality.column_report(rows, declared.not_null, declared.accepted)] if declared.not_null or declared.accepted else []
    counted = [(f"unique_{c}", quality.not_unique(rows, [c])) for c in declared.unique]
    counted += [
        (f"relationships_{c}", quality.orphans(rows, c, read(parent), key))
        for c, (parent, key) in declared.parents.items()
    ]
    parts += [bad.agg(F.count("*").alias("failing_rows")).select(F.lit(n).alias("check"), "failing_rows") for n, bad in counted]
    return reduce(DataFrame.unionByName, parts).select(F.lit(name).alias("model"), "check", "failing_rows")


def build_report(read: Read, names: Iterable[str] = DECLARED) -> DataFrame:
    """Every declared check of the models, with its number of failing rows."""
    return reduce(DataFrame.unionAll, [failures(name, read(name), read) for name in names])


def require(name: str, rows: DataFrame, read: Read) -> None:
    """Raises if the model has checks and fails one. A handful of rows reach the driver."""
    if name in DECLARED:
        failed = failures(name, rows, read).where("failing_rows > 0").orderBy("check").collect()
        if failed:
            raise quality.QualityError(f"{name}: " + ", ".join(f"{r.check} ({r.failing_rows} rows)" for r in failed))
