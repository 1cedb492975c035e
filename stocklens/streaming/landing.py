"""Continuous landing of topics and continuous refresh of the mart."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stocklens.plans.layout import swap_overwrite, with_month
from stocklens.sources.topics import land, rejects

# Topic -> date column that the raw table is partitioned by month of.
MONTH_OF = {
    "inventory_topic": "event_time",
    "po_lines_topic": "created_at",
    "sales_lines_topic": "created_at",
    "snapshot_topic": "snapshot_date",
    "stock_counts_topic": "count_date",
}


def _started(writer, seconds: int | None) -> StreamingQuery:
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def start_landing(
    messages: DataFrame,
    topic: str,
    table: str,
    checkpoint: str,
    now: datetime | None = None,
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Append the rows of a topic to its raw table.

    The projection has no state, so the checkpoint holds offsets only, and a restart continues
    after the last committed batch. Without a period the stream ends when the topic is read.
    """
    rows = land(messages, topic, now)
    date_col = MONTH_OF.get(topic)
    if date_col:
        rows = with_month(rows, date_col)
    writer = rows.writeStream.format("parquet").outputMode("append")
    if date_col:
        writer = writer.partitionBy("month")
    writer = writer.option("path", table).option("checkpointLocation", checkpoint)
    return _started(writer, every_seconds)


def start_rejects(
    messages: DataFrame, topic: str, table: str, checkpoint: str, every_seconds: int | None = None
) -> StreamingQuery:
    """Append the broken messages of a topic to a side table."""
    writer = rejects(messages, topic).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", table).option("checkpointLocation", checkpoint)
    return _started(writer, every_seconds)


def stream_append(
    raw_stream: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    date_col: str,
    every_seconds: int | None = 5,
) -> StreamingQuery:
    """Append every batch to a fact whose rows each come from one raw row.

    Gives the rows a full refresh gives and costs the new rows only, so it is the one to use
    when the raw table is large. The sink's log makes a repeated batch harmless.
    """
    rows = with_month(clean(raw_stream), date_col)
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy("month")
    writer = writer.option("path", table).option("checkpointLocation", checkpoint)
    return _started(writer, every_seconds)


def stream_refresh(
    raw_stream: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    every_seconds: int | None = 5,
    date_col: str | None = None,
) -> StreamingQuery:
    """Rebuild a mart table after every batch of raw rows and swap it in.

    ``build`` gets the batch and returns the whole table, as a full refresh does, so a batch that
    runs twice publishes the same rows again.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        swap_overwrite(build(batch), path, date_col)

    writer = raw_stream.writeStream.foreachBatch(refresh)
    return _started(writer.option("checkpointLocation", checkpoint), every_seconds)
