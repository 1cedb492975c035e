"""Near-real-time movement totals: event-time windows with a watermark and removal of repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stocklens.schemas import message_schema
from stocklens.streaming.landing import _started

EVENT_KEY = "event_id"


def numbered_movements(messages: DataFrame) -> DataFrame:
    """Movement messages that carry an event number, as typed rows; broken ones are left out."""
    schema = message_schema("inventory_topic").add(EVENT_KEY, T.LongType())
    rows = messages.select(F.from_json("value", schema, {"timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}).alias("m"))
    whole = F.col(f"m.{EVENT_KEY}").isNotNull() & F.col("m.event_time").isNotNull() & F.col("m.qty_change").isNotNull()
    return rows.filter(whole).select(*[F.col(f"m.{n}").alias(n) for n in schema.fieldNames()])


def movement_rollup(
    rows: DataFrame, delay: str = "2 days", every: str = "1 day", key: Sequence[str] = (EVENT_KEY,)
) -> DataFrame:
    """Count and net quantity per window, warehouse and SKU.

    On a stream, an event counts once however often it is delivered within ``delay``; events older than the
    watermark are left out, and a window is given once, when the watermark has passed its end. State
    holds the keys of ``delay`` and the open windows, not the history. On a batch the same rows
    are summed without a watermark.
    """
    if rows.isStreaming:
        once = rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(key))
    else:
        once = rows.dropDuplicates(list(key))
    totals = once.groupBy(F.window("event_time", every).alias("w"), "warehouse_id", "sku_id").agg(
        F.count(F.lit(1)).alias("movement_count"),
        F.sum("qty_change").cast("bigint").alias("net_qty_change"),
    )
    return totals.select(
        F.col("w.start").alias("window_start"), "warehouse_id", "sku_id", "movement_count", "net_qty_change"
    )


ROLLUP = "window_start timestamp, warehouse_id string, sku_id string, movement_count bigint, net_qty_change bigint"


def start_rollup(
    messages: DataFrame, table: str, checkpoint: str, delay: str = "2 days", every: str = "1 day",
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Append closed windows to a table. The checkpoint holds offsets, watermark and state, so a restart
    goes on where the last committed batch ended; the sink's log makes a repeated batch harmless."""
    rows = movement_rollup(numbered_movements(messages), delay, every)
    writer = rows.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", table).option("checkpointLocation", checkpoint)
    return _started(writer, every_seconds)
