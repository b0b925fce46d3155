from __future__ import annotations

from datetime import date
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from ledgerlake import MODELS
from ledgerlake.operators.quality import QualityError
from ledgerlake.sinks import tables
from ledgerlake.streaming import incremental
from tests import fixtures


def frame(spark, rows, schema="id int, d date, v string"):
    return spark.createDataFrame(rows, schema)


def test_replace_reads_its_own_table(spark):
    tables.replace_table(frame(spark, [(1, date(2026, 1, 1), "a")]), "bronze", "self_read")
    doubled = spark.table("bronze.self_read").unionAll(frame(spark, [(2, date(2026, 1, 2), "b")]))
    tables.replace_table(doubled, "bronze", "self_read")
    assert sorted(r.id for r in spark.table("bronze.self_read").collect()) == [1, 2]
    left = [t.name for t in spark.catalog.listTables("bronze") if t.name.startswith("self_read")]
    assert left == ["self_read"]


def test_a_swap_that_died_between_renames_is_mended(spark):
    tables.replace_table(frame(spark, [(1, None, "a")]), "bronze", "broken")
    spark.sql("alter table bronze.broken rename to bronze.broken__old")
    tables.append_new(frame(spark, [(1, None, "a"), (2, None, "b")]), "bronze", "broken", ["id"])
    assert sorted(r.id for r in spark.table("bronze.broken").collect()) == [1, 2]
    assert not spark.catalog.tableExists("bronze.broken__old")


def test_keyed_load_refuses_repeats_and_logs(spark):
    good = frame(spark, [(1, None, "a"), (2, None, "b")])
    tables.load_table(good, "keyed", "finance_dev", keys=["id"])
    assert "finance_dev" in {r.schema_name for r in tables.read_load_log(spark).collect()}
    for bad in ([(1, None, "a"), (1, None, "b")], [(None, None, "a")]):
        with pytest.raises(QualityError):
            tables.load_table(frame(spark, bad), "keyed", "finance_dev", keys=["id"])
    assert spark.table("bronze.keyed").count() == 2


@pytest.mark.parametrize("cursor", [None, "d"])
def test_append_is_idempotent(spark, cursor):
    name = f"touches_{cursor}"
    first = frame(spark, [(1, date(2026, 1, 1), "a"), (2, date(2026, 1, 2), "b")])
    second = first.unionAll(frame(spark, [(3, date(2026, 1, 2), "c"), (4, date(2026, 1, 3), "d"), (4, date(2026, 1, 3), "d")]))
    for batch in (first, first, second, second):
        tables.append_new(batch, "bronze", name, ["id"], cursor)
    assert sorted(r.id for r in spark.table(f"bronze.{name}").collect()) == [1, 2, 3, 4]


def test_snapshot_first_write_wins_unless_replaced(spark):
    def row(day, v):
        return frame(spark, [(day, v)], "snapshot_date date, v int")

    for day, v in ((date(2026, 1, 1), 1), (date(2026, 1, 1), 2), (date(2026, 1, 3), 3)):
        tables.append_snapshot(row(day, v), "snaps")
    assert sorted(tuple(r) for r in spark.table("gold.snaps").collect()) == [(date(2026, 1, 1), 1), (date(2026, 1, 3), 3)]
    tables.append_snapshot(row(date(2026, 1, 1), 9), "snaps", replace=True)
    assert sorted(tuple(r) for r in spark.table("gold.snaps").collect()) == [(date(2026, 1, 1), 9), (date(2026, 1, 3), 3)]


def test_history_table(spark):
    def snapshot(status):
        return spark.createDataFrame([(1, status)], "lead_id int, status string")

    for day, status in (("2026-01-01", "warm"), ("2026-02-01", "sent"), ("2026-03-01", "sent")):
        tables.update_history(snapshot(status), "scd_leads", ["lead_id"], ["status"], F.lit(day))
    got = [(r.status, r.valid_to is None) for r in spark.table("silver.scd_leads").orderBy("valid_from").collect()]
    assert got == [("warm", False), ("sent", True)]
    with pytest.raises(QualityError):
        tables.update_history(snapshot("a").unionAll(snapshot("b")), "scd_leads", ["lead_id"], ["status"], F.lit("2026-04-01"))


def test_build_all_writes_gold_and_reads_it_back(spark, tmp_path):
    lake = fixtures.landed_lake(spark, tmp_path)
    tables.build_all(lake)
    gold = {name for name, (layer, _) in MODELS.items() if layer == "gold"}
    assert gold <= {t.name for t in spark.catalog.listTables("gold")}
    assert spark.table("gold.mart_big_cycle").count() == 6
    assert spark.table("stg_leads").count() == len(fixtures.LEADS)  # temp view
    again = fixtures.landed_lake(spark, tmp_path)
    tables.materialise(again, "mart_review_snapshot")
    assert spark.table("gold.mart_review_snapshot").count() == 1


def test_stream_appends_once(spark, tmp_path):
    schema = "touch_id string, at timestamp, angle string, is_open int, is_reply int"
    rows = spark.sql(
        "select * from values ('1', timestamp'2026-01-01 01:00:00', 'A', 1, 0), ('2', timestamp'2026-01-01 02:00:00', 'B', 0, 0),"
        " ('1', timestamp'2026-01-01 01:00:00', 'A', 1, 0) as t(touch_id, at, angle, is_open, is_reply)"
    )
    landing_dir, checkpoint = f"{tmp_path}/in", f"{tmp_path}/cp"
    struct = rows.schema
    assert struct.names == [c.split()[0] for c in schema.split(", ")]
    for _ in range(2):  # the second drop repeats every key in a new file
        rows.write.mode("append").parquet(landing_dir)
        stream = incremental.deduplicated(incremental.stream_files(spark, landing_dir, struct), ["touch_id"], "at")
        incremental.append_available(stream, "bronze", "streamed", ["touch_id"], checkpoint)
    assert sorted(r.touch_id for r in spark.table("bronze.streamed").collect()) == ["1", "2"]


def test_stream_funnel_windows(spark, tmp_path):
    rows = spark.sql("select timestamp'2026-01-01 01:00:00' as at, 'A' as angle, 1 as is_open, 0 as is_reply")
    rows.write.parquet(f"{tmp_path}/in")
    stream = incremental.funnel_by_window(incremental.stream_files(spark, f"{tmp_path}/in", rows.schema), "at")
    query = (
        stream.writeStream.outputMode("complete").format("memory").queryName("funnel_windows").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    (row,) = spark.table("funnel_windows").collect()
    assert (row.angle, row.total_touches, row.opens, row.replies) == ("A", 1, 1, 0)


def test_late_rows_and_rows_without_cursor_arrive(spark):
    stored = frame(spark, [(1, date(2026, 1, 5), "a"), (2, date(2026, 1, 9), "b"), (7, None, "n")])
    batch = frame(
        spark,
        [(2, date(2026, 1, 9), "b"), (3, date(2026, 1, 10), "c"), (4, date(2026, 1, 6), "late"), (5, None, "none"),
         (7, None, "n"), (8, date(2026, 1, 1), "old"), (8, date(2026, 1, 2), "newer")],
    )
    fresh = {r.id: r.v for r in tables.new_rows(stored, batch, ["id"], "d").collect()}
    assert fresh == {3: "c", 4: "late", 5: "none", 8: "newer"}


def test_history_takes_on_new_columns(spark):
    from ledgerlake.operators.history import first_history, scd2_merge

    old = first_history(spark.createDataFrame([(1, "a"), (2, "a")], "id int, status string"), F.lit("2026-01-01"))
    new = spark.createDataFrame([(1, "b", "x"), (2, "a", "y")], "id int, status string, note string")
    merged = scd2_merge(old, new, ["id"], ["status"], F.lit("2026-02-01"))
    assert sorted((r.id, r.status, r.note, r.valid_to is None) for r in merged.collect()) == [
        (1, "a", None, False), (1, "b", "x", True), (2, "a", None, True),
    ]


def test_a_failed_check_stops_the_build(spark, tmp_path):
    lake = fixtures.landed_lake(spark, tmp_path)
    lake._bronze["leads_master"] = lake.source("leads_master").unionAll(lake.source("leads_master").limit(1))
    with pytest.raises(QualityError, match="unique_lead_id"):
        tables.materialise(lake, "stg_leads")


def test_sources_come_from_loaded_tables(spark):
    from ledgerlake import Lake
    from ledgerlake.schemas import BRONZE

    rows = spark.createDataFrame([("2026-01-31", "10")], BRONZE["mm_networth"])
    tables.load_table(rows, "mm_networth", "finance_dev")
    try:
        assert Lake(spark, {}, as_of=date(2026, 2, 1)).ref("stg_networth").count() == 1
    finally:
        spark.sql("drop table bronze.mm_networth")


def test_the_build_keeps_the_leads_history(spark, tmp_path):
    """A second build on a later day closes the row of a lead whose status has changed."""
    spark.sql("drop table if exists silver.scd_leads")
    for day, status in ((date(2026, 7, 1), "warm"), (date(2026, 8, 1), "won")):
        lake = fixtures.landed_lake(spark, tmp_path, as_of=day)
        changed = F.when(F.col("id") == 31, status).otherwise(F.col("status"))
        lake._bronze["leads_master"] = lake.source("leads_master").withColumn("status", changed)
        tables.update_history(lake.ref("stg_leads"), tables.LEAD_HISTORY, ["lead_id"], ["status"], lake.today)
    history = tables.lead_history(lake)
    assert history.count() == len(fixtures.LEADS) + 1
    assert [r.status for r in history.where("lead_id = 31").orderBy("valid_from").collect()] == ["warm", "won"]
    assert sum(r.leads for r in tables.open_status_counts(lake).collect()) == len(fixtures.LEADS)


def _files(spark, name: str) -> dict[str, float]:
    """Paths and times of the files of a table."""
    import os

    files = [unquote(f).removeprefix("file://") for f in spark.table(name).inputFiles()]
    return {f: os.path.getmtime(f) for f in files}


def _leads(spark, leads: dict) -> object:
    return spark.createDataFrame(list(leads.items()), "lead_id int, status string")


def _rows(history) -> list[tuple]:
    return sorted((r.lead_id, r.status, str(r.valid_from.date()), r.valid_to and str(r.valid_to.date())) for r in history.collect())


RUNS = [
    ("2026-01-01", {1: "a", 2: "a", 3: "a"}),
    ("2026-01-20", {1: "b", 2: "a", 3: "a"}),
    ("2026-02-10", {1: "b", 2: "c", 3: "a", 4: "n"}),
    ("2026-02-20", {1: "a", 2: "c", 3: "d", 4: "n"}),
]


def test_closed_history_is_never_touched_again(spark):
    from ledgerlake.operators.history import first_history, scd2_merge

    expected = None
    for day, leads in RUNS:
        before = _files(spark, "silver.hist_parts") if expected is not None else {}
        tables.update_history(_leads(spark, leads), "hist_parts", ["lead_id"], ["status"], F.lit(day))
        after = _files(spark, "silver.hist_parts")
        closed = {f: t for f, t in before.items() if f"{tables.PART}=open" not in f}
        assert {f: after.get(f) for f in closed} == closed
        at = F.lit(day)
        expected = first_history(_leads(spark, leads), at) if expected is None else scd2_merge(expected, _leads(spark, leads), ["lead_id"], ["status"], at)
        assert _rows(tables.read_history(spark, "hist_parts")) == _rows(expected)
    parts = {r[tables.PART] for r in spark.table("silver.hist_parts").select(tables.PART).distinct().collect()}
    assert parts == {"open", "2026-01", "2026-02"}
    # A run reads the open part alone.
    current = spark.table("silver.hist_parts").where(F.col(tables.PART) == "open")
    assert all(f"{tables.PART}=open" in unquote(f) for f in current.inputFiles())
    spark.sql("drop table silver.hist_parts")


@pytest.mark.parametrize("died", ["before", "between"])
def test_a_step_of_a_dead_run_is_put_in_place(spark, monkeypatch, died):
    name = f"hist_{died}"
    for day, leads in RUNS[:2]:
        tables.update_history(_leads(spark, leads), name, ["lead_id"], ["status"], F.lit(day))
    put = tables._put_in_place

    def dies(spark, step, live):
        if died == "between":  # what was closed is there, the open part is still the old one
            rows = spark.table(step).where(F.col(tables.PART) != "open")
            tables.overwrite_parts(rows, live)
        raise RuntimeError("gone")

    monkeypatch.setattr(tables, "_put_in_place", dies)
    day, leads = RUNS[2]
    with pytest.raises(RuntimeError):
        tables.update_history(_leads(spark, leads), name, ["lead_id"], ["status"], F.lit(day))
    monkeypatch.setattr(tables, "_put_in_place", put)
    # The next run comes later and finds the dead one's state, with its dates.
    day, leads = RUNS[3]
    tables.update_history(_leads(spark, leads), name, ["lead_id"], ["status"], F.lit(day))
    whole = f"{name}_whole"
    for day, leads in RUNS:
        tables.update_history(_leads(spark, leads), whole, ["lead_id"], ["status"], F.lit(day))
    assert _rows(tables.read_history(spark, name)) == _rows(tables.read_history(spark, whole))
    assert not tables._pending(spark, "silver", name)
    for t in (name, whole):
        spark.sql(f"drop table silver.{t}")


def test_a_history_in_parts_takes_on_columns_and_old_tables(spark):
    from ledgerlake.operators.history import first_history

    tables.replace_table(first_history(_leads(spark, {1: "a", 2: "a"}), F.lit("2026-01-01")), "silver", "hist_old")
    wider = _leads(spark, {1: "b", 2: "a"}).withColumn("note", F.lit("x"))
    tables.update_history(wider, "hist_old", ["lead_id"], ["status"], F.lit("2026-02-01"))
    rows = sorted((r.lead_id, r.status, r.note) for r in tables.read_history(spark, "hist_old").collect())
    assert rows == [(1, "a", None), (1, "b", "x"), (2, "a", None)]
    tables.update_history(_leads(spark, {}), "hist_old", ["lead_id"], ["status"], F.lit("2026-03-01"))
    assert tables.read_history(spark, "hist_old").count() == 3  # nothing seen closes nothing
    spark.sql("drop table silver.hist_old")


def test_null_keys_are_one_key(spark):
    stored = spark.createDataFrame([(None, 1)], "id int, v int")
    batch = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "id int, v int")
    assert [(r.id, r.v) for r in tables.new_rows(stored, batch, ["id"]).collect()] == [(1, 3)]
    for _ in range(3):
        tables.append_new(batch, "bronze", "null_keys", ["id"])
        assert sorted(spark.table("bronze.null_keys").collect(), key=repr) == sorted(
            tables.one_per_key(batch, ["id"]).collect(), key=repr
        )
    spark.sql("drop table bronze.null_keys")


def test_inputs_survive_a_dead_swap(spark):
    """A table between its two renames is found by the lake, also where it is optional."""
    from ledgerlake import Lake
    from ledgerlake.schemas import BRONZE

    rows = spark.createDataFrame([("2026-01-31", "10")], BRONZE["mm_networth"])
    tables.load_table(rows, "mm_networth", "finance_dev")
    spark.sql("alter table bronze.mm_networth rename to bronze.mm_networth__old")
    lake = Lake(spark, {}, as_of=date(2026, 2, 1), optional=["mm_networth"])
    assert lake.source("mm_networth").count() == 1
    spark.sql("drop table bronze.mm_networth")
