"""Small tables of odd rows that every operator on documents is run over."""

from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

LONG = "long text of many words " * 4000

#: doc_id, text: nulls, blanks, one-word, repeated, tied and very long texts, a null id.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "word"),
    (5, "one two three four five six seven eight nine ten"),
    (6, "one two three four five six seven eight nine ten"),
    (6, "one two three four five six seven eight nine ten"),
    (7, LONG),
    (8, "日本語の文章 \U0001f600 ÄÖÜ ß"),
    (None, "a text without an id"),
    (9, "x" * 50_000),
]


def odd_docs(spark: SparkSession) -> DataFrame:
    """The odd rows, with columns more whose names clash with results."""
    rows = [(i, t, "en" if k % 2 else None, "src", len(t or ""), 0.5, 7) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, rank int"
    )


def no_docs(spark: SparkSession) -> DataFrame:
    return odd_docs(spark).where(F.lit(False))


def write_tables(folder: str, **tables: pa.Table) -> str:
    for name, table in tables.items():
        pq.write_table(table, os.path.join(folder, f"{name}.parquet"))
    return folder


def rows_of(frame: DataFrame) -> list[str]:
    """Rows as sorted JSON, for comparing results whole."""
    return sorted(json.dumps(r.asDict(True), default=str) for r in frame.collect())
