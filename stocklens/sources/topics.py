"""JSON topics: publish rows, read them back typed, and land them in raw tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.functions import kept_if, money, parse_time, timestamp_lit
from stocklens.operators.derive import fill_days
from stocklens.schemas import message_schema
from stocklens.sources.extract import day_text, text_around_day

BROKEN = "_broken"
JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BROKEN,
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
}
KAFKA_READ = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000000"}
KAFKA_WRITE = {"kafka.acks": "1", "kafka.compression.type": "gzip"}


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON message per row."""
    options = {"timestampFormat": JSON_OPTIONS["timestampFormat"]}
    return df.select(F.to_json(F.struct("*"), options).alias("value"))


def run_messages(wired: DataFrame, first: date, last: date, day: str = "snapshot_date") -> DataFrame:
    """``to_messages`` of the days of wire-shaped runs (``extract.wire_runs``). The text of a message around its
    day is written once per run. ``first`` and ``last``: see ``extract.day_text``.
    """
    options = {"timestampFormat": JSON_OPTIONS["timestampFormat"]}
    head, tail = text_around_day(wired.columns, day, options)
    days = fill_days(wired.select("valid_from", "valid_to", head.alias("head"), tail.alias("tail")), day)
    return days.select(F.concat("head", day_text(day, first, last), "tail").alias("value"))


def write_topic(df: DataFrame, topic: str, servers: str | None = None, folder: str | None = None):
    """Publish rows to a topic of a broker, or as line files in a folder named after it."""
    messages = to_messages(df)
    if servers:
        writer = messages.write.format("kafka").options(**KAFKA_WRITE)
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    else:
        messages.write.mode("append").text(f"{folder}/{topic}")


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    folder: str | None = None,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """The messages of a topic as a stream with a text column ``value``."""
    if servers:
        reader = spark.readStream.format("kafka").options(**KAFKA_READ)
        raw = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
        return raw.select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(f"{folder}/{topic}")


def _decoded(messages: DataFrame, topic: str) -> DataFrame:
    schema = message_schema(topic).add(BROKEN, T.StringType())
    return messages.select("value", F.from_json("value", schema, JSON_OPTIONS).alias("m"))


def _is_broken() -> Column:
    return F.col("m").isNull() | F.col(f"m.{BROKEN}").isNotNull()


def typed(messages: DataFrame, topic: str) -> DataFrame:
    """Messages of a topic as typed rows; broken messages are left out."""
    names = message_schema(topic).fieldNames()
    rows = kept_if(_decoded(messages, topic), ~_is_broken())
    return rows.select(*[F.col(f"m.{n}").alias(n) for n in names])


def rejects(messages: DataFrame, topic: str) -> DataFrame:
    """The broken messages of a topic, for a side table."""
    broken = kept_if(_decoded(messages, topic), _is_broken())
    return broken.select(F.lit(topic).alias("topic"), F.col("value").alias("message"))


def _stamped(df: DataFrame, now: datetime | None) -> DataFrame:
    landed = timestamp_lit(now) if now else F.current_timestamp()
    return df.withColumn("ingestion_time", landed)


def _dated(df: DataFrame, day: str | None = None) -> DataFrame:
    """Parse the text dates of a fact; rows with a date that does not parse are left out."""
    times = {"created_at": parse_time("created_at")}
    if day:
        times[day] = F.to_date(parse_time(day))
    known = F.lit(True)
    for name in times:
        known = known & F.col(name).isNotNull()
    return kept_if(df.withColumns(times), known)


def _priced(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: money(n) for n in names})


def land_transactions(df: DataFrame, now: datetime | None = None) -> DataFrame:
    rows = df.select("warehouse_id", "sku_id", "qty_change", "event_time")
    return _stamped(rows, now)


def land_po_lines(df: DataFrame, now: datetime | None = None) -> DataFrame:
    return _stamped(_priced(_dated(df), "unit_cost"), now)


def land_sales_lines(df: DataFrame, now: datetime | None = None) -> DataFrame:
    return _stamped(_priced(_dated(df), "unit_price"), now)


def land_snapshot(df: DataFrame, now: datetime | None = None) -> DataFrame:
    return _stamped(_priced(_dated(df, "snapshot_date"), "unit_cost", "inventory_value"), now)


def land_stock_counts(df: DataFrame, now: datetime | None = None) -> DataFrame:
    return _stamped(_dated(df, "count_date"), now)


def land_dim(df: DataFrame, now: datetime | None = None) -> DataFrame:
    """Dimensions land as they come; their date stays text until staging."""
    return _stamped(df, now)


LANDINGS = {
    "inventory_topic": land_transactions,
    "po_lines_topic": land_po_lines,
    "sales_lines_topic": land_sales_lines,
    "snapshot_topic": land_snapshot,
    "stock_counts_topic": land_stock_counts,
    "dim_skus_topic": land_dim,
    "dim_warehouses_topic": land_dim,
    "dim_suppliers_topic": land_dim,
    "dim_customers_topic": land_dim,
}


def land(messages: DataFrame, topic: str, now: datetime | None = None) -> DataFrame:
    """From messages to raw rows, for a batch or a stream alike."""
    return LANDINGS[topic](typed(messages, topic), now)
