"""Status history (slowly changing dimension, type 2) by the check strategy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def first_history(snapshot: DataFrame, valid_at: Column) -> DataFrame:
    """History of a table seen for the first time: every row open since valid_at."""
    at = valid_at.cast("timestamp")
    return snapshot.withColumns({VALID_FROM: at, VALID_TO: F.lit(None).cast("timestamp")})


def with_columns_of(history: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The history with the columns that are new in the snapshot, null in its rows."""
    added = [f for f in snapshot.schema.fields if f.name not in history.columns]
    return history.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added})


def scd2_step(
    current: DataFrame, snapshot: DataFrame, keys: Sequence[str], check: Sequence[str], valid_at: Column
) -> DataFrame:
    """What becomes of the open rows of a history: rows that stay open, closed ones and new ones.

    A key whose check columns differ (null-safe) closes its open row at valid_at and
    opens a new one; an unchanged key keeps its open row; a key gone from the snapshot
    stays open. Null key parts equal each other.
    """
    at = valid_at.cast("timestamp")
    current = with_columns_of(current, snapshot)
    columns = [c for c in current.columns if c not in (VALID_FROM, VALID_TO)]
    gone = [f for f in current.schema.fields if f.name in columns and f.name not in snapshot.columns]
    snapshot = snapshot.withColumns({f.name: F.lit(None).cast(f.dataType) for f in gone})
    held = current.withColumn("__old", F.lit(True)).alias("o")
    incoming = snapshot.select(*columns).withColumn("__new", F.lit(True)).alias("n")

    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
    same = F.lit(True)
    for c in check:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    paired = held.join(incoming, on, "full_outer")

    has_old, has_new = F.col("o.__old").isNotNull(), F.col("n.__new").isNotNull()
    changed = has_old & has_new & ~same
    old_row = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in columns],
        F.col(f"o.{VALID_FROM}").alias(VALID_FROM),
        F.when(changed, at).alias(VALID_TO),
    )
    new_row = F.struct(
        *[F.col(f"n.{c}").alias(c) for c in columns],
        at.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
    )
    rows = F.filter(
        F.array(F.when(has_old, old_row), F.when(has_new & (changed | ~has_old), new_row)),
        lambda r: r.isNotNull(),
    )
    return paired.select(F.explode(rows).alias("row")).select("row.*")


def scd2_merge(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    check: Sequence[str],
    valid_at: Column,
) -> DataFrame:
    """New history after seeing `snapshot`.

    Only open rows take part in the join: closed ones are passed through, so the shuffle grows
    with the table, not with its history. Columns that are new in the snapshot are taken on,
    null in earlier rows; such that it no longer has stay, null in new rows.
    """
    history = with_columns_of(history, snapshot)
    merged = scd2_step(history.where(F.col(VALID_TO).isNull()), snapshot, keys, check, valid_at)
    return history.where(F.col(VALID_TO).isNotNull()).select(*merged.columns).unionByName(merged)


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col(VALID_TO).isNull())


def status_counts(history: DataFrame, column: str = "status", top: int = 10) -> DataFrame:
    """Open rows per status, largest first (top-k report)."""
    return (
        current_rows(history)
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("leads"))
        .orderBy(F.desc("leads"), F.col(column).asc_nulls_last())
        .limit(top)
    )
