"""Readers and reshapers between raw files and the bronze tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import fixed_values as fixed
from ledgerlake.context import literal_rows
from ledgerlake.schemas import conform, text_schema

# -- files ------------------------------------------------------------------------------


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV, every column text; quoted line breaks and carriage returns survive.

    Quoted line breaks keep one file in one task, so large logs should land as many
    files. A file of the folder whose header names other columns, or in another order,
    is an error: its rows are never placed by position.
    """
    df = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("lineSep", "\n")
        .csv(path)
    )
    # With a fixed line separator a CRLF file keeps "\r" at the end of its last column.
    last = df.columns[-1]
    if last.endswith("\r"):
        df = df.withColumnRenamed(last, last[:-1]).withColumn(
            last[:-1], F.regexp_replace(last[:-1], "\r$", "")
        )
    return conform(df, columns) if columns else df


def read_records(
    spark: SparkSession, path: str, schema: str | None = None, json_lines: bool = False
) -> DataFrame:
    """A file holding one JSON array of objects (or one object per line).

    Give a schema (schemas.RAW) for anything large: inference reads the data once more,
    and an array file is read by one task, so big landings should be JSON lines.
    """
    reader = spark.read.option("multiLine", not json_lines).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader.option("prefersDecimal", True)).json(path)


def read_fixed_records(
    spark: SparkSession, path: str, columns: Sequence[str], json_lines: bool = False
) -> DataFrame:
    """Only the listed fields, as text; an empty array still has all columns.

    The schema doubles as a whitelist: fields not listed are never parsed or stored. A file
    that is cut off or no JSON is an error.
    """
    reader = spark.read.schema(text_schema(list(columns))).option("multiLine", not json_lines)
    return reader.option("mode", "FAILFAST").json(path)


def csv_lines(lines: DataFrame, columns: Sequence[str], line: str = "value") -> DataFrame:
    """The fields of lines of CSV text, as text. For lines that arrive as rows of a table.

    A line with more or fewer fields than columns is an error.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {"mode": "FAILFAST", "quote": '"', "escape": '"'}
    return lines.select(F.from_csv(line, schema, options).alias("row")).select("row.*")


def json_records(lines: DataFrame, schema: str, line: str = "value") -> DataFrame:
    """The objects of lines of JSON text; a line that is no object of the schema is an error."""
    return lines.select(F.from_json(line, schema, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def fixed_records(lines: DataFrame, columns: Sequence[str], line: str = "value") -> DataFrame:
    """Only the listed fields of lines of JSON text, as text; no lines give no rows of all columns."""
    return json_records(lines, ", ".join(f"`{c}` string" for c in columns), line)


def read_seed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return read_csv_text(spark, path, columns)


def read_if_present(spark: SparkSession, path: str, read, columns: Sequence[str]) -> DataFrame | None:
    """read(spark, path, columns), or None for a file that is not there: its load is skipped."""
    return read(spark, path, columns) if path_exists(spark, path) else None


# -- flattening -------------------------------------------------------------------------


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def _leaves(fields: Iterable[T.StructField], path: str, name: str) -> list[tuple[str, str, T.DataType]]:
    out = []
    for f in fields:
        at = f"{path}.`{f.name}`" if path else f"`{f.name}`"
        called = f"{name}__{snake_case(f.name)}" if name else snake_case(f.name)
        if isinstance(f.dataType, T.StructType):
            out += _leaves(f.dataType.fields, at, called)
        else:
            out.append((at, called, f.dataType))
    return out


def flatten(df: DataFrame, drop: Sequence[str] = (), null_words: Sequence[str] = ()) -> DataFrame:
    """Nested objects to `parent__child` columns; lists stay as JSON text; all text.

    Texts among `null_words` become null: for files written by a tool that spells its nulls
    (columns.NULL_WORDS). Otherwise text stays as it is, a merchant called "None" included.
    """
    dropped = {snake_case(d) for d in drop}
    columns = []
    for path, name, kind in _leaves(df.schema.fields, "", ""):
        if name in dropped:
            continue
        nested = isinstance(kind, (T.ArrayType, T.MapType))
        text = F.to_json(F.col(path)) if nested else F.col(path).cast("string")
        columns.append(worded_to_null(text, null_words).alias(name))
    return df.select(*columns)


def worded_to_null(text: Column, null_words: Sequence[str]) -> Column:
    return F.when(~text.isin(*null_words), text) if null_words else text


def all_text(df: DataFrame, null_words: Sequence[str] = ()) -> DataFrame:
    """Every column as text; `null_words` as in flatten."""
    return df.select(
        *[worded_to_null(F.col(f"`{c}`").cast("string"), null_words).alias(c) for c in df.columns]
    )


def with_lineage(df: DataFrame, load_id: str) -> DataFrame:
    """Adds when, from which file and by which load each row came. For file-backed frames."""
    return df.withColumns(
        {
            "_loaded_at": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_path"),
            "_load_id": F.lit(load_id),
        }
    )


# -- macro observations -----------------------------------------------------------------


def macro_observations(raw: DataFrame) -> DataFrame:
    """Landing names to bronze names; missing-value marks are dropped."""
    return (
        raw.where(~F.col("value").isin(".", ""))
        .withColumnsRenamed({"date": "obs_date", "value": "obs_value"})
        .select("series", "series_id", "obs_date", "obs_value")
    )


def within_lookback(
    df: DataFrame, as_of: Column, days: Mapping[str, int] | None = None, date: str = "obs_date"
) -> DataFrame:
    """Each series keeps its own days of history; unlisted series are dropped."""
    windows = days or {name: kept for name, (_, kept) in fixed.MACRO_SERIES.items()}
    config = literal_rows(df.sparkSession, ["series", "keep_days"], list(windows.items()))
    return (
        df.join(F.broadcast(config), "series")  # one row per configured series
        .where(F.col(date).try_cast("date") >= F.date_sub(as_of, F.col("keep_days")))
        .drop("keep_days")
    )


def recent_transactions_window(df: DataFrame, as_of: Column, date: str = "date") -> DataFrame:
    day = F.col(date).try_cast("date")
    return df.where((day >= F.date_sub(as_of, fixed.TRANSACTION_DAYS)) & (day <= as_of))


# -- holdings ---------------------------------------------------------------------------


def explode_holdings(accounts: DataFrame) -> DataFrame:
    """One row per holding of the investment accounts.

    Expects accounts(id, displayName, type.display, portfolio.aggregateHoldings.edges[]).
    Ticker, name and type fall back from the security to its first position: an
    unmatched security has no ticker of its own, and a null one would miss the map.
    """
    node = F.col("edge.node")
    security, position = node["security"], F.get(node["holdings"], F.lit(0))

    def filled(*options: Column) -> Column:
        return F.coalesce(*[F.nullif(o, F.lit("")) for o in options])

    return (
        accounts.where(F.col("type.display") == "Investments")
        .select(
            F.col("displayName").alias("account"),
            F.col("id").alias("account_id"),
            F.explode(F.col("portfolio.aggregateHoldings.edges")).alias("edge"),
        )
        .select(
            "account",
            "account_id",
            filled(security["ticker"], position["ticker"]).alias("ticker"),
            filled(security["name"], position["name"]).alias("name"),
            filled(security["type"], security["typeDisplay"], position["type"]).alias("security_type"),
            node["totalValue"].alias("market_value"),
            node["quantity"].alias("quantity"),
            node["basis"].alias("basis"),
            node["securityPriceChangePercent"].alias("change_pct"),
        )
    )


# -- long history -----------------------------------------------------------------------


def unpivot_named(
    df: DataFrame, ids: Mapping[str, Column], columns: Mapping[str, str], value_type: str = "double"
) -> DataFrame:
    """Wide columns to (ids, series, value); absent columns are skipped, nulls dropped."""
    present = {src: name for src, name in columns.items() if src in df.columns}
    wide = df.select(
        *[expr.alias(name) for name, expr in ids.items()],
        *[F.col(f"`{src}`").try_cast(value_type).alias(name) for src, name in present.items()],
    )
    long = wide.unpivot(list(ids), list(present.values()), "series", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def monthly_equity_history(df: DataFrame, entity: str = "USA") -> DataFrame:
    """Sheet with YYYY.MM dates: 1871.1 is October, 1871.01 is January."""
    stamp = F.col("Date").try_cast("decimal(12,4)")
    month = (F.round(stamp * 100, 0) % 100).cast("int")
    ids = {
        "entity": F.lit(entity),
        "year": F.floor(stamp).cast("int"),
        "period": month,
    }
    dated = df.where(stamp.isNotNull() & month.between(1, 12))
    return unpivot_named(dated, ids, fixed.MONTHLY_EQUITY_COLUMNS)


def country_panel(df: DataFrame) -> DataFrame:
    ids = {
        "entity": F.col("country").cast("string"),
        "year": F.col("year").try_cast("int"),
        "period": F.lit(0),
    }
    return unpivot_named(df, ids, fixed.COUNTRY_PANEL_COLUMNS)


def checked_positions(
    descriptions: Sequence[str | None], columns: Mapping[int, tuple[str, str]]
) -> dict[int, str]:
    """Positions whose description starts as expected; a shifted column is refused."""
    kept = {}
    for position, (series, expected) in columns.items():
        found = (descriptions[position] if position < len(descriptions) else None) or ""
        if found.lower().startswith(expected.lower()[: fixed.DESCRIPTION_PREFIX]):
            kept[position] = series
    return kept


def sheet_headings(spark: SparkSession, path: str, rows: int) -> list[Row]:
    """The first `rows` rows of one file: `path`, or of the folder's files the first by name.

    That file is read unsplit and from its start only, so these are its headings, in whichever
    order Spark reads the other files.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(where).isDirectory():
        listed = [s.getPath() for s in files.listStatus(where) if s.isFile()]
        shown = [p for p in listed if not p.getName().startswith(("_", "."))]
        where = min(shown, key=lambda p: p.getName())
    return spark.read.option("multiLine", True).option("escape", '"').csv(where.toString()).take(rows)


def positional_history(
    sheet: DataFrame,
    description_row: int = 3,
    columns: Mapping[int, tuple[str, str]] = fixed.MILLENNIUM_COLUMNS,
    entity: str = "GBR",
    headings: Sequence[Sequence[str | None]] | None = None,
) -> DataFrame:
    """Header-less sheet of text columns, read by position after checking descriptions.

    `headings` are its first rows (sheet_headings); without them `sheet` has to be one unsplit
    file, or sorted, as they are taken from its start. Data rows are those with a numeric year
    in the first column.
    """
    first = sheet.take(description_row + 1) if headings is None else headings
    if len(first) <= description_row:
        raise ValueError(f"a sheet of {len(first)} heading rows has no row {description_row} of descriptions")
    kept = checked_positions(list(first[description_row]), columns)
    names = sheet.columns
    year = F.col(names[0]).try_cast("double")
    ids = {"entity": F.lit(entity), "year": year.cast("int"), "period": F.lit(0)}
    data = sheet.where(year.isNotNull())
    return unpivot_named(data, ids, {names[p]: series for p, series in kept.items()})
