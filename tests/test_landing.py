from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlake.schemas import BRONZE
from ledgerlake.sources import landing


def test_csv_keeps_breaks_quotes_and_text(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        b'id,note,date\n1,"line one\r\nline ""two"", still",2026-01-01\n002,,not a date\n'
    )
    df = landing.read_csv_text(spark, f"{tmp_path}/a.csv", ["id", "date", "note", "absent"])
    rows = {r.id: r for r in df.collect()}
    assert df.columns == ["id", "date", "note", "absent"] and set(dict(df.dtypes).values()) == {"string"}
    assert rows["1"].note == 'line one\r\nline "two", still'
    assert rows["002"].note is None and rows["002"].date == "not a date" and rows["002"].absent is None


def test_csv_with_windows_line_ends(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b"id,b\r\n1,x\r\n2,y\r\n")
    df = landing.read_csv_text(spark, f"{tmp_path}/w.csv", ["id", "b"])
    assert sorted((r.id, r.b) for r in df.collect()) == [("1", "x"), ("2", "y")]


def test_flatten(spark, tmp_path):
    records = [
        {"displayName": "A", "type": {"display": "Cash", "deep": {"innerKey": 1}}, "tags": [{"a": 1}], "isAsset": True, "x": "nan"},
        {"displayName": "B", "type": None, "tags": [], "isAsset": False, "x": ""},
    ]
    (tmp_path / "r.json").write_text(json.dumps(records))
    df = landing.flatten(landing.read_records(spark, f"{tmp_path}/r.json"), ["x2"], null_words=("nan", ""))
    rows = {r.display_name: r.asDict() for r in df.collect()}
    assert rows["A"] == {
        "display_name": "A", "is_asset": "true", "tags": '[{"a":1}]', "type__deep__inner_key": "1",
        "type__display": "Cash", "x": None,
    }
    assert rows["B"]["type__display"] is None and rows["B"]["x"] is None
    assert "tags" not in landing.flatten(landing.read_records(spark, f"{tmp_path}/r.json"), drop=["tags"]).columns


def test_declared_schema_keeps_the_text(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"id": 7, "amount": -12.50, "tags": [{"a": 1}], "on": true, "extra": 1}]')
    df = landing.read_records(spark, f"{tmp_path}/t.json", "id string, amount string, tags string, on string")
    assert df.head().asDict() == {"id": "7", "amount": "-12.50", "tags": '[{"a": 1}]', "on": "true"}


def test_json_lines(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"id": 1}\n{"id": 2}\n')
    assert landing.read_records(spark, f"{tmp_path}/l.json", "id string", json_lines=True).count() == 2


def test_empty_and_missing_inputs(spark, tmp_path):
    (tmp_path / "empty.json").write_text("[]")
    df = landing.read_fixed_records(spark, f"{tmp_path}/empty.json", BRONZE["stripe_subscriptions"])
    assert df.isEmpty() and df.columns == BRONZE["stripe_subscriptions"]
    columns = BRONZE["lh_boe"]
    assert landing.read_if_present(spark, f"{tmp_path}/none.json", landing.read_fixed_records, columns) is None
    assert landing.read_if_present(spark, f"{tmp_path}/empty.json", landing.read_fixed_records, columns).isEmpty()


def test_whitelist_never_parses_other_fields(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"id": "a", "amount": 5, "livemode": True, "card": "4242"}]))
    row = landing.read_fixed_records(spark, f"{tmp_path}/c.json", ["id", "amount", "livemode", "invoice"]).head()
    assert row.asDict() == {"id": "a", "amount": "5", "livemode": "true", "invoice": None}


def test_lineage_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    row = landing.with_lineage(spark.read.option("header", True).csv(f"{tmp_path}/a.csv"), "load-1").head()
    assert row["_load_id"] == "load-1" and row["_source_file"].endswith("a.csv") and row["_loaded_at"]


def test_observations_and_lookback(spark):
    raw = spark.createDataFrame(
        [("cpi", "C", "1900-01-01", "1"), ("oil_wti", "O", "2020-01-01", "2"), ("oil_wti", "O", "2026-01-01", "."),
         ("oil_wti", "O", "2026-02-01", "3"), ("other", "X", "2026-02-01", "4")],
        "series string, series_id string, date string, value string",
    )
    obs = landing.macro_observations(raw)
    assert obs.columns == ["series", "series_id", "obs_date", "obs_value"] and obs.count() == 4
    kept = landing.within_lookback(obs, F.lit(date(2026, 8, 20)))
    assert sorted(r.obs_value for r in kept.collect()) == ["1", "3"]


def test_transaction_window(spark):
    df = spark.createDataFrame([("2025-07-16",), ("2025-07-15",), ("2026-08-21",), ("x",)], "date string")
    kept = landing.recent_transactions_window(df, F.lit(date(2026, 8, 20)))
    assert [r.date for r in kept.collect()] == ["2025-07-16"]


def test_monthly_sheet_decodes_october(spark):
    df = spark.createDataFrame(
        [("1871.01", "4.4", "10"), ("1871.1", "4.5", "NA"), ("1871.12", "4.6", None), ("1871.13", "9", "9"), ("Note", "x", "x")],
        "Date string, P string, CAPE string",
    )
    got = sorted((r.series, r.year, r.period, r.value) for r in landing.monthly_equity_history(df).collect())
    assert got == [("cape", 1871, 1, 10.0), ("price", 1871, 1, 4.4), ("price", 1871, 10, 4.5), ("price", 1871, 12, 4.6)]


def test_country_panel(spark):
    df = spark.createDataFrame([("USA", 1870, 1.0, None), ("UK", 1870, 2.0, 3.0)], "country string, year int, gdp double, cpi double")
    got = sorted((r.entity, r.series, r.period, r.value) for r in landing.country_panel(df).collect())
    assert got == [("UK", "cpi", 0, 3.0), ("UK", "nominal_gdp", 0, 2.0), ("USA", "nominal_gdp", 0, 1.0)]


def test_positional_sheet_refuses_shifted_columns(spark, tmp_path):
    lines = ["title,,", ",,", ",,", "Year,Consumer price index (CPI),Unemployment rate", ",%,%", ",,", ",,", "1700,1.5,7", "1701,,8"]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    sheet = spark.read.csv(f"{tmp_path}/s.csv")
    columns = {1: ("cpi", "Consumer price index"), 2: ("bank_rate", "Bank Rate"), 9: ("x", "Absent")}
    got = [(r.entity, r.year, r.series, r.value) for r in landing.positional_history(sheet, 3, columns).collect()]
    assert got == [("GBR", 1700, "cpi", 1.5)]


def test_headings_come_from_the_named_file(spark, tmp_path):
    """Data files that sort, and are read, before the one with the headings."""
    folder = tmp_path / "sheet"
    folder.mkdir()
    (folder / "b.csv").write_text('title,,\nYear,"Consumer price\nindex (CPI)",Unemployment rate\n1700,1.5,7\n')
    for k in range(6):
        (folder / f"c{k}.csv").write_text("".join(f"{1800 + 10 * k + n},{n},1\n" for n in range(10)))
    (folder / "_a.csv").write_text("hidden,,\n")
    columns = {1: ("cpi", "Consumer price"), 2: ("bank_rate", "Bank Rate")}
    sheet = spark.read.option("multiLine", True).schema("y string, a string, b string").csv(str(folder)).orderBy(F.desc("y"))
    for named in (folder, folder / "b.csv"):
        headings = landing.sheet_headings(spark, str(named), 2)
        got = {(r.year, r.series, r.value) for r in landing.positional_history(sheet, 1, columns, headings=headings).collect()}
        assert got == {(1700, "cpi", 1.5), *[(1800 + 10 * k + n, "cpi", float(n)) for k in range(6) for n in range(10)]}
    with pytest.raises(ValueError, match="descriptions"):
        landing.positional_history(sheet, 3, columns, headings=headings)


def test_words_stay_unless_asked_for(spark):
    df = spark.createDataFrame([("None", ""), ("nan", "x")], "merchant string, note string")
    assert sorted(map(tuple, landing.all_text(df).collect())) == [("None", ""), ("nan", "x")]
    assert sorted(map(tuple, landing.all_text(df, ("None",)).collect()), key=repr) == [("nan", "x"), (None, "")]


def test_a_header_in_another_order_is_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,name\n1,ann\n")
    (tmp_path / "in" / "b.csv").write_text("name,id\nbob,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.read_csv_text(spark, f"{tmp_path}/in", ["id", "name"]).collect()


def test_a_cut_file_is_an_error(spark, tmp_path):
    (tmp_path / "cut.json").write_text('[{"id": 1, "amount": 5}, {"id": 2, "amo')
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_fixed_records(spark, f"{tmp_path}/cut.json", ["id", "amount"]).collect()
