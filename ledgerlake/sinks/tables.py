"""Writes: full refresh, keyed append, daily snapshot, status history, load log.

Tables live in the session catalog, one schema per layer. Built gold tables are views over
versions. A landed table, or one that is computed from itself, is written beside the old one and
swapped in by rename: between the two renames a reader finds nothing under its name, and whoever
comes next through this module finds the old version.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.context import MODELS, Lake, table_exists
from ledgerlake.operators.history import first_history, scd2_step, status_counts
from ledgerlake.operators.keyfilter import likely_in
from ledgerlake.operators.quality import require_unique
from ledgerlake.plans import checks
from ledgerlake.schemas import LOAD_LOG


def table_name(layer: str, name: str) -> str:
    """Layer names are used literally as schemas (gold, not silver_gold)."""
    return f"{layer}.{name}"


def ensure_layer(spark: SparkSession, layer: str) -> None:
    spark.sql(f"create schema if not exists {layer}")


def replace_table(
    df: DataFrame,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    accept: Callable[[DataFrame], None] | None = None,
) -> None:
    """Full refresh through a second table and a rename.

    `accept` sees what was written before it takes the old table's place, and stops the swap
    by raising.
    """
    spark = df.sparkSession
    ensure_layer(spark, layer)
    live = table_name(layer, name)
    fresh, old = f"{live}__next", f"{live}__old"
    spark.sql(f"drop table if exists {fresh}")
    df.write.format("parquet").partitionBy(*partition_by).saveAsTable(fresh)
    if accept is not None:
        accept(spark.table(fresh))
    if table_exists(spark, live):
        spark.sql(f"drop table if exists {old}")
        spark.sql(f"alter table {live} rename to {old}")
    spark.sql(f"alter table {fresh} rename to {live}")
    if partition_by:  # not every catalog moves the places of partitions along
        spark.sql(f"msck repair table {live} sync partitions")
    spark.sql(f"drop table if exists {old}")


#: Versions of a published table that stay besides the newest, for readers that still use them.
KEPT_VERSIONS = 2


def _versions(spark: SparkSession, layer: str, name: str) -> list[str]:
    """Stored versions of a published table, oldest first."""
    mark = f"{name}__version_"
    return sorted(table_name(layer, t.name) for t in spark.catalog.listTables(layer) if t.name.startswith(mark))


def publish_table(
    df: DataFrame,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    accept: Callable[[DataFrame], None] | None = None,
) -> None:
    """Full refresh as a new version, to which a view is then turned by one change in the catalog.

    Readers use the view and find the old or the new version at any time; nothing is renamed or
    moved. A job that dies leaves the view on the old version. Versions before the last few go;
    one that a dead job left counts among these. `accept` sees the version before the view does.
    A table that earlier releases stored under the view's name is moved aside once.
    """
    spark = df.sparkSession
    ensure_layer(spark, layer)
    live = table_name(layer, name)
    version = f"{live}__version_{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    dealt = df.hint("rebalance", *partition_by) if partition_by else df  # few files a folder, large folders split
    dealt.write.format("parquet").partitionBy(*partition_by).saveAsTable(version)
    if accept is not None:
        accept(spark.table(version))
    there = table_exists(spark, live)
    if there and spark.catalog.getTable(live).tableType == "VIEW":
        # Not `create or replace`, which drops the view first.
        spark.sql(f"alter view {live} as select * from {version}")
    else:
        if there:
            spark.sql(f"drop table if exists {live}__old")
            spark.sql(f"alter table {live} rename to {live}__old")
        spark.sql(f"create view {live} as select * from {version}")
        spark.sql(f"drop table if exists {live}__old")
    for old in [v for v in _versions(spark, layer, name) if v != version][:-KEPT_VERSIONS]:
        spark.sql(f"drop table if exists {old}")


def load_table(
    df: DataFrame,
    name: str,
    pipeline: str,
    layer: str = "bronze",
    keys: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Replace a landed table and record the load; keyed tables are checked first."""
    replace_table(require_unique(df, keys) if keys else df, layer, name, partition_by)
    log_load(df.sparkSession, pipeline)


def log_load(spark: SparkSession, pipeline: str) -> None:
    ensure_layer(spark, "bronze")
    row = spark.range(1).select(
        F.lit(pipeline).alias("schema_name"), F.current_timestamp().alias("inserted_at")
    )
    row.write.format("parquet").mode("append").saveAsTable(table_name("bronze", "load_log"))


def read_load_log(spark: SparkSession) -> DataFrame:
    name = table_name("bronze", "load_log")
    if not table_exists(spark, name):
        return spark.createDataFrame([], LOAD_LOG)
    return spark.table(name)


def one_per_key(batch: DataFrame, keys: Sequence[str], cursor: str | None = None) -> DataFrame:
    """One row of the batch for each key: the newest by cursor, then the least by a hash of the row."""
    newest = [F.desc_nulls_last(cursor)] if cursor else []
    w = Window.partitionBy(*keys).orderBy(*newest, F.xxhash64(*batch.columns))
    return batch.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def new_rows(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], cursor: str | None = None
) -> DataFrame:
    """Rows of the batch whose key is not there yet; re-running a batch adds nothing.

    The cursor of a key must never change. It serves to read less of the existing table:
    only rows from the batch's own smallest cursor on, and those without one, can hold a key
    of the batch. Every batch row is looked at, late ones and such without a cursor too. A null
    in a key equals a null: rows without a key are one key, which is stored once. Stored keys go
    through a bitmap of the batch's keys first, so that about as many are shuffled as the batch has.
    """
    seen = existing
    oldest = F.min(cursor) if cursor else F.lit(None)
    count, oldest = batch.agg(F.count(F.lit(1)), oldest).head()
    if cursor:
        recent = F.col(cursor).isNull() if oldest is None else F.col(cursor).isNull() | (F.col(cursor) >= F.lit(oldest))
        seen = existing.where(recent)
    kept = likely_in(seen.select(*keys), keys, batch, keys, count).select(*[F.col(k).alias(f"__seen_{k}") for k in keys])
    known = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__seen_{k}")) for k in keys])
    return one_per_key(batch, keys, cursor).join(kept, known, "left_anti")


def append_new(
    batch: DataFrame, layer: str, name: str, keys: Sequence[str], cursor: str | None = None
) -> None:
    spark = batch.sparkSession
    ensure_layer(spark, layer)
    live = table_name(layer, name)
    if not table_exists(spark, live):
        one_per_key(batch, keys, cursor).write.format("parquet").saveAsTable(live)
        return
    fresh = new_rows(spark.table(live), batch, keys, cursor)
    fresh.write.format("parquet").mode("append").saveAsTable(live)


def append_snapshot(row: DataFrame, name: str, key: str = "snapshot_date", replace: bool = False) -> None:
    """Add today's row unless the date is there; replace=True lets the newest run win."""
    spark = row.sparkSession
    live = table_name("gold", name)
    if replace and table_exists(spark, live):
        others = spark.table(live).join(row.select(key), key, "left_anti")
        replace_table(others.unionByName(row), "gold", name)
    else:
        append_new(row, "gold", name, [key])


#: Where a row of a stored history lies: `open`, or the month in which it was closed and the run that did it.
PART, RUN, OPEN = "history_part", "history_run", "open"


def _pending(spark: SparkSession, layer: str, name: str) -> list[str]:
    """Steps of a history that were computed whole and may not have been put in place, oldest first."""
    if not spark.catalog.databaseExists(layer):
        return []
    mark = f"{name}__step_"
    found = [t.name for t in spark.catalog.listTables(layer) if not t.isTemporary]
    return sorted(table_name(layer, t) for t in found if t.startswith(mark))


def overwrite_parts(rows: DataFrame, live: str) -> None:
    """Replaces the partitions of a table that `rows` has rows of, and leaves the others alone."""
    conf, mode = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(live)
    finally:
        conf.set(mode, before)


def widen(live: str, rows: DataFrame) -> DataFrame:
    """Adds columns to a table that only `rows` has; gives `rows` with the table's columns, in order."""
    spark = rows.sparkSession
    columns = spark.table(live).columns
    missing = [f for f in rows.schema.fields if f.name not in columns]
    if missing:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"alter table {live} add columns ({added})")
    types = dict(spark.table(live).dtypes)
    return rows.select(*[F.col(f"`{n}`") if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in types.items()])


def _put_in_place(spark: SparkSession, step: str, live: str) -> None:
    """Replaces the parts that a step holds; doing it again gives the same table."""
    overwrite_parts(widen(live, spark.table(step)), live)
    spark.sql(f"drop table if exists {step}")


def _in_parts(rows: DataFrame, run: str) -> DataFrame:
    closed = F.col("valid_to").isNotNull()
    return rows.withColumns(
        {
            PART: F.when(closed, F.date_format("valid_to", "yyyy-MM")).otherwise(OPEN),
            RUN: F.when(closed, F.lit(run)).otherwise(F.lit(OPEN)),
        }
    )


def _stored_history(spark: SparkSession, layer: str, name: str) -> DataFrame | None:
    """The table of a history with its parts, after finishing what a dead run had begun."""
    live = table_name(layer, name)
    if not table_exists(spark, live):
        return None
    for step in _pending(spark, layer, name):
        _put_in_place(spark, step, live)
    stored = spark.table(live)
    if PART not in stored.columns:  # stored in one piece by earlier versions
        replace_table(_in_parts(stored, "earlier"), layer, name, [PART, RUN])
    return spark.table(live)


def read_history(spark: SparkSession, name: str, layer: str = "silver") -> DataFrame | None:
    """A stored history, open and closed rows; None before its first run."""
    stored = _stored_history(spark, layer, name)
    return None if stored is None else stored.drop(PART, RUN)


def update_history(
    snapshot: DataFrame,
    name: str,
    keys: Sequence[str],
    check: Sequence[str],
    valid_at: Column,
    layer: str = "silver",
) -> None:
    """Type-2 history of a keyed table; duplicate keys in the input are refused.

    The history is stored in parts: the open rows, and the closed ones by the month of closing
    and the run that closed them. A run reads and rewrites the open part and adds what it has
    closed; files of closed rows are not read and never touched again. Its step is written whole
    to a table of its own first and then put in place, part by part: a job that dies in between
    leaves the step, and whoever comes next, reader or writer, puts it in place again.
    """
    spark = snapshot.sparkSession
    require_unique(snapshot, keys)
    stored = _stored_history(spark, layer, name)
    if stored is None:
        replace_table(_in_parts(first_history(snapshot, valid_at), OPEN), layer, name, [PART, RUN])
        return
    run = uuid.uuid4().hex
    current = stored.where(F.col(PART) == OPEN).drop(PART, RUN)
    step = table_name(layer, f"{name}__step_{run}")
    _in_parts(scd2_step(current, snapshot, keys, check, valid_at), run).write.format("parquet").saveAsTable(step)
    _put_in_place(spark, step, table_name(layer, name))


LEAD_HISTORY = "scd_leads"
#: Columns by which the build stores a gold table in folders.
PARTITIONED = {"int_monthly_totals": ["month"]}


def materialise(lake: Lake, name: str) -> None:
    """Silver models become temp views, gold models tables; ephemeral ones neither.

    The model's declared checks come first: a silver model that fails stops the build, a gold
    one does so before it replaces the stored table. A written gold table is what later
    models of the same lake read.
    """
    layer = MODELS[name][0]
    if layer == "silver":
        checks.require(name, lake.ref(name), lake.ref)
        lake.ref(name).createOrReplaceTempView(name)
    elif layer == "gold":
        df = lake.ref(name)
        if name == "mart_review_snapshot":
            append_snapshot(df, name)
        else:
            folders = PARTITIONED.get(name, ())
            publish_table(df, "gold", name, folders, accept=lambda written: checks.require(name, written, lake.ref))
            lake.use(name, lake.spark.table(table_name("gold", name)))


def build_all(lake: Lake) -> None:
    """Every model once, in registration order (which follows the dependencies), and the leads'
    status history. Where transactions land in loads, monthly sums are brought up by touched months."""
    from ledgerlake.sinks import upkeep

    if upkeep.grows_by_loads(lake):
        upkeep.refresh_monthly_parts(lake)
    for name in MODELS:
        materialise(lake, name)
        if name == "stg_leads" and not lake.ref(name).isEmpty():
            update_history(lake.ref(name), LEAD_HISTORY, ["lead_id"], ["status"], lake.today)


def lead_history(lake: Lake) -> DataFrame:
    """The stored status history of the leads; before the first build, the leads as they are."""
    stored = read_history(lake.spark, LEAD_HISTORY)
    return first_history(lake.ref("stg_leads"), lake.today) if stored is None else stored


def open_status_counts(lake: Lake, top: int = 10) -> DataFrame:
    """Leads per status by the open rows of the stored history."""
    return status_counts(lead_history(lake), "status", top)
