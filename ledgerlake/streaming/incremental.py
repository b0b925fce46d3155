"""Streaming twin of the keyed append: an addition beside the batch loads.

New landing files are read once each (file source + checkpoint), repeated keys are
dropped within the watermark, and the sink anti-joins the table, so a replayed
micro-batch adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sinks.tables import append_new


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, late: str = "1 day") -> DataFrame:
    """State is bounded by the watermark, not by the number of keys ever seen."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(keys))


def append_available(
    stream: DataFrame, layer: str, name: str, keys: Sequence[str], checkpoint: str, cursor: str | None = None
) -> None:
    """Consume everything that has landed, then stop.

    With a cursor (see sinks.tables.new_rows) a micro-batch is matched only with the stored
    rows from its own smallest cursor on.
    """

    def write(batch: DataFrame, _: int) -> None:
        append_new(batch, layer, name, keys, cursor)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def funnel_by_window(stream: DataFrame, event_time: str, width: str = "1 day") -> DataFrame:
    """Touches, opens and replies per event-time window and angle."""
    return (
        stream.withWatermark(event_time, width)
        .groupBy(F.window(event_time, width).alias("window"), "angle")
        .agg(
            F.count(F.lit(1)).alias("total_touches"),
            F.sum("is_open").alias("opens"),
            F.sum("is_reply").alias("replies"),
        )
    )
