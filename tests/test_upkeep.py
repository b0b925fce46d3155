"""Loads by month, sums brought up by touched months, and versions behind a view."""

from __future__ import annotations

import os
import threading
from datetime import date
from urllib.parse import unquote

import pytest

from checks import queries
from ledgerlake import Lake
from ledgerlake.schemas import BRONZE
from ledgerlake.sinks import tables, upkeep
from tests.test_registered import SF_DIR, needs_data

COLUMNS = ["id", "date", "amount", "category__id", "category__name", "hide_from_reports"]
FIRST = [
    ("1", "2026-01-05", "-10", "food", "Food", "False"),
    ("2", "2026-01-06", "-5.25", "food", "Food", "False"),
    ("3", "2026-02-01", "100", "pay", "Paycheck", "False"),
    ("4", "2026-03-01", "-7", "food", "Food", "False"),
    ("5", None, "-1", None, None, "False"),
    ("6", "2026-03-02", "-3", "food", "Food", "True"),
]
LATE = [("7", "2026-02-03", "-2.5", "food", "Food", "False"), ("3", "2026-02-01", "100", "pay", "Paycheck", "False")]


def batch(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in COLUMNS))


def files(spark, name):
    found = [unquote(f).removeprefix("file://") for f in spark.table(name).inputFiles()]
    return {f: os.stat(f).st_mtime_ns for f in found}


def parts(df):
    names = ("month", "category_id", "category", "outflow", "total")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.fixture
def clean(spark):
    def drop():
        for t in ("bronze.mm_transactions", "gold.int_monthly_parts", "gold.int_monthly_parts__loads"):
            spark.sql(f"drop table if exists {t}")

    for layer in ("bronze", "gold"):
        tables.ensure_layer(spark, layer)
    drop()
    yield
    drop()


def whole(spark, rows):
    full = batch(spark, rows).dropDuplicates(["id"])
    return parts(Lake(spark, {"mm_transactions": full}, as_of=date(2026, 4, 1)).ref("int_monthly_parts"))


def refreshed(spark):
    lake = Lake(spark, {}, as_of=date(2026, 4, 1), optional=BRONZE)
    assert upkeep.grows_by_loads(lake)
    return upkeep.refresh_monthly_parts(lake), parts(lake.ref("int_monthly_parts"))


def test_a_late_load_touches_its_month_only(spark, clean):
    upkeep.load_transactions(batch(spark, FIRST), "finance")
    assert refreshed(spark) == (["2026-01", "2026-02", "2026-03", "undated"], whole(spark, FIRST))
    before = files(spark, "gold.int_monthly_parts")
    upkeep.load_transactions(batch(spark, LATE), "finance")
    assert refreshed(spark) == (["2026-02"], whole(spark, FIRST + LATE))
    after = files(spark, "gold.int_monthly_parts")
    others = {f: t for f, t in before.items() if "load_month=2026-02" not in f}
    assert len(others) >= 3 and {f: after.get(f) for f in others} == others
    assert not {f for f in before if "load_month=2026-02" in f} & set(after)
    upkeep.load_transactions(batch(spark, FIRST + LATE), "finance")  # nothing new in it
    assert refreshed(spark) == ([], whole(spark, FIRST + LATE))
    assert spark.table("bronze.mm_transactions").count() == 7


def test_only_touched_months_are_read(spark, clean):
    upkeep.load_transactions(batch(spark, FIRST), "finance")
    refreshed(spark)
    upkeep.load_transactions(batch(spark, LATE), "finance")
    seen = []

    def sums(rows):
        seen.extend(unquote(f) for f in rows.inputFiles())
        return upkeep.month_parts(Lake(spark, {"mm_transactions": rows}, as_of=date(2026, 4, 1)))

    month = upkeep.F.col("month")
    assert upkeep.refresh_months(spark, "bronze.mm_transactions", "gold", "int_monthly_parts", sums, month) == ["2026-02"]
    assert seen and all("load_month=2026-02" in f for f in seen)


@pytest.mark.parametrize("after", ["sums", "nothing"])
def test_a_dead_refresh_is_done_again(spark, clean, monkeypatch, after):
    upkeep.load_transactions(batch(spark, FIRST), "finance")
    refreshed(spark)
    upkeep.load_transactions(batch(spark, LATE), "finance")
    over = upkeep.overwrite_parts

    def dies(rows, live):
        if after == "sums":
            over(rows, live)
        raise RuntimeError("gone")

    monkeypatch.setattr(upkeep, "overwrite_parts", dies)
    with pytest.raises(RuntimeError):
        refreshed(spark)
    monkeypatch.setattr(upkeep, "overwrite_parts", over)
    assert refreshed(spark) == (["2026-02"], whole(spark, FIRST + LATE))


def test_loads_differ_in_columns_and_repeat_keys(spark, clean):
    upkeep.load_transactions(batch(spark, FIRST).drop("hide_from_reports"), "finance")
    wider = batch(spark, LATE + LATE + [(None, "2026-02-09", "-4", "food", "Food", "False")] * 2)
    upkeep.load_transactions(wider.withColumn("note", upkeep.F.lit("x")), "finance")
    stored = spark.table("bronze.mm_transactions")
    assert sorted((r.id or "-", r.note) for r in stored.where("load_month = '2026-02'").collect()) == [
        ("-", "x"), ("3", None), ("7", "x"),
    ]
    assert stored.where("id = '7'").head().hide_from_reports == "False"


def test_an_empty_load(spark, clean):
    upkeep.load_transactions(batch(spark, []), "finance")
    assert refreshed(spark) == ([], [])
    upkeep.load_transactions(batch(spark, FIRST), "finance")
    upkeep.load_transactions(batch(spark, []), "finance")
    assert refreshed(spark)[1] == whole(spark, FIRST)


def numbers(spark, n):
    return spark.range(n).selectExpr("id", f"{n} as version")


def drop_published(spark, name):
    spark.sql(f"drop view if exists gold.{name}")
    for v in tables._versions(spark, "gold", name):
        spark.sql(f"drop table {v}")


def test_readers_never_meet_a_gap(spark):
    """A reader that loops through refreshes always finds one whole version."""
    tables.publish_table(numbers(spark, 1), "gold", "looped")
    stop, seen, failed = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                rows = spark.table("gold.looped").collect()
                seen.append((len(rows), {r.version for r in rows}))
            except Exception as e:  # noqa: BLE001
                failed.append(e)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 9):
        tables.publish_table(numbers(spark, n), "gold", "looped")
    stop.set()
    reader.join()
    assert not failed and seen
    assert all(versions == {n} for n, versions in seen)
    assert len(tables._versions(spark, "gold", "looped")) == tables.KEPT_VERSIONS + 1
    drop_published(spark, "looped")


def test_a_refused_version_is_not_published(spark):
    tables.publish_table(numbers(spark, 2), "gold", "refused")

    def refuse(written):
        raise ValueError("no")

    with pytest.raises(ValueError):
        tables.publish_table(numbers(spark, 3), "gold", "refused", accept=refuse)
    assert spark.table("gold.refused").count() == 2
    tables.publish_table(numbers(spark, 4).withColumn("more", upkeep.F.lit(1)), "gold", "refused", ["version"])
    assert spark.table("gold.refused").where("version = 4 and more = 1").count() == 4
    drop_published(spark, "refused")


def test_a_table_of_earlier_releases_becomes_a_view(spark):
    tables.replace_table(numbers(spark, 2), "gold", "was_table")
    tables.publish_table(spark.table("gold.was_table").unionAll(numbers(spark, 1)), "gold", "was_table")
    assert spark.table("gold.was_table").count() == 3
    tables.publish_table(spark.table("gold.was_table").limit(1), "gold", "was_table")
    assert spark.table("gold.was_table").count() == 1
    assert not spark.catalog.tableExists("gold.was_table__old")
    drop_published(spark, "was_table")


def test_a_published_folder_has_one_file_while_it_is_small(spark):
    rows = spark.range(0, 4000, numPartitions=4).selectExpr("id", "cast(id % 5 as int) as month")
    tables.publish_table(rows, "gold", "dealt", ["month"])
    (version,) = tables._versions(spark, "gold", "dealt")
    assert len(spark.table(version).inputFiles()) == 5
    assert spark.table("gold.dealt").where("month = 3").count() == 800
    drop_published(spark, "dealt")


@needs_data
def test_the_second_load_is_computed_once(spark, monkeypatch):
    """Its batch no longer reads the tables, and its copies have the numbers of a count over all rows."""
    loads = []

    def kept(load, *more):
        loads.append((load.select("id", "date", "amount", "copy").collect(), load.inputFiles()))
        append(load, *more)

    append = queries.append_load
    monkeypatch.setattr(queries, "append_load", kept)
    queries.QUERIES["monthly_totals_by_change"](spark, SF_DIR)
    (first, _), (second, files_read) = loads
    assert first and second and not files_read
    copies = {}
    for r in {tuple(r) for r in first + second}:
        copies.setdefault(r[0], []).append(r[3])
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in copies.values())
    assert len({(r.id, r.copy) for r in first + second}) == queries.table(spark, SF_DIR, "lineitem").count()
