"""Data-quality checks; each returns the failing rows (none = pass)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A table failed its checks."""


def not_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row; null keys are left to not_null."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return (
        df.where(present)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null reference is absent from the parent."""
    known = parent.select(F.col(parent_column).alias("__known"))
    child = df.where(F.col(column).isNotNull())
    return child.join(known, child[column] == F.col("__known"), "left_anti")


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their row counts."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def column_report(
    df: DataFrame, required: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """All null and accepted-value checks of a table in one pass: check, failing_rows."""
    counts = {f"not_null_{c}": F.count_if(F.col(c).isNull()) for c in required}
    for c, values in (accepted or {}).items():
        counts[f"accepted_values_{c}"] = F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values))
    wide = df.agg(*[expr.alias(name) for name, expr in counts.items()])
    return wide.unpivot([], list(counts), "check", "failing_rows")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gate before a keyed write: raises when a key repeats or is null. One pass."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where((F.col("n_records") > 1) | missing)
    if not bad.isEmpty():
        raise QualityError(f"key {list(keys)} is repeated or null")
    return df
