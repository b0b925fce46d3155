"""Upkeep by change: loads appended by month, and monthly sums recomputed for touched months only.

A landed table that grows by loads lies in folders by month and load. Sums per month are kept in
folders by month beside a list of the (month, load) folders they contain. What is in the catalog and
not in that list names the months to recompute; they are recomputed whole, from all their loads, so
doing it twice gives the same. All other months are neither read nor written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.context import Lake, table_exists
from ledgerlake.functions.columns import Typed
from ledgerlake.plans.cashflow import month_parts
from ledgerlake.sinks.tables import ensure_layer, log_load, new_rows, one_per_key, overwrite_parts, replace_table, table_name, widen

#: Folders of a landed table that grows by loads.
MONTH, LOAD = "load_month", "load_run"
#: The month of rows without a readable date.
UNDATED = "undated"


def month_folder(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))


def append_load(batch: DataFrame, layer: str, name: str, keys: Sequence[str], day: Column) -> None:
    """Adds the rows of a load whose key is not stored yet, in folders of their own.

    Only the months of the batch are read to find its keys, so the day of a key must never change
    its month. A null in a key equals a null. Columns that one side lacks are null there. A load that
    died has added no folder to the catalog; running it again adds all of it, running a finished one
    again adds nothing and touches no month.
    """
    spark = batch.sparkSession
    ensure_layer(spark, layer)
    live = table_name(layer, name)
    dated = batch.withColumns({MONTH: month_folder(day), LOAD: F.lit(uuid.uuid4().hex)})
    if not table_exists(spark, live):
        rows = one_per_key(dated, keys).hint("rebalance", MONTH)
        rows.write.format("parquet").partitionBy(MONTH, LOAD).saveAsTable(live)
        return
    months = [r[0] for r in dated.select(MONTH).distinct().collect()]  # as many as the calendar has
    stored = spark.table(live).where(F.col(MONTH).isin(months))
    rows = new_rows(stored, dated, keys).hint("rebalance", MONTH)
    widen(live, rows).write.mode("append").insertInto(live)


def folders(spark: SparkSession, live: str) -> DataFrame:
    """(month, load) folders of a landed table, by the catalog alone."""
    found = spark.sql(f"show partitions {live}")
    return found.select(*[F.regexp_extract("partition", f"{n}=([^/]*)", 1).alias(n) for n in (MONTH, LOAD)])


def refresh_months(
    spark: SparkSession, source: str, layer: str, name: str, sums: Callable[[DataFrame], DataFrame], month: Column
) -> list[str]:
    """Recomputes the sums of the months that loads have touched since the last time; returns these.

    `sums` turns rows of the source into sums in which no row's sum crosses months, `month` gives the
    month of a sum and has to agree with the folder its rows lie in. Sums are replaced before their
    loads are listed: a run that dies in between recomputes the same months next time.
    """
    live, listed = table_name(layer, name), table_name(layer, f"{name}__loads")
    whole = not (table_exists(spark, live) and table_exists(spark, listed))
    due = folders(spark, source)
    if not whole:
        due = due.join(spark.table(listed), [MONTH, LOAD], "left_anti")
    new = [tuple(r) for r in due.collect()]  # folder names of new loads
    months = sorted({m for m, _ in new})
    loads = spark.createDataFrame(new, f"{MONTH} string, {LOAD} string").coalesce(1)
    if whole:
        rows = sums(spark.table(source)).withColumn(MONTH, month_folder(month)).hint("rebalance", MONTH)
        replace_table(rows, layer, name, [MONTH])
        replace_table(loads, layer, f"{name}__loads")
    elif months:
        touched = spark.table(source).where(F.col(MONTH).isin(months))
        rows = sums(touched).withColumn(MONTH, month_folder(month)).hint("rebalance", MONTH)
        overwrite_parts(rows.select(*spark.table(live).columns), live)
        loads.write.format("parquet").mode("append").saveAsTable(listed)
    return months


TRANSACTIONS, PARTS = "mm_transactions", "int_monthly_parts"


def load_transactions(batch: DataFrame, pipeline: str) -> None:
    """Adds a load to the landed transactions and records it."""
    append_load(batch, "bronze", TRANSACTIONS, ["id"], Typed(batch).date("date"))
    log_load(batch.sparkSession, pipeline)


def grows_by_loads(lake: Lake) -> bool:
    """Whether the lake's transactions are a stored table in folders by month and load."""
    live = table_name("bronze", TRANSACTIONS)
    return (
        not lake.is_given(TRANSACTIONS)
        and table_exists(lake.spark, live)
        and {MONTH, LOAD} <= set(lake.spark.table(live).columns)
    )


def refresh_monthly_parts(lake: Lake) -> list[str]:
    """Brings the stored monthly parts up to the landed loads and lets the lake read them."""

    def sums(rows: DataFrame) -> DataFrame:
        return month_parts(Lake(lake.spark, {TRANSACTIONS: rows}, as_of=lake.as_of, settings=lake.settings))

    months = refresh_months(lake.spark, table_name("bronze", TRANSACTIONS), "gold", PARTS, sums, F.col("month"))
    lake.use(PARTS, lake.spark.table(table_name("gold", PARTS)).drop(MONTH))
    return months
