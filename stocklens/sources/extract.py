"""Incremental extract from the operational database, and the shape of rows on the wire."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions import timestamp_lit
from stocklens.operators.derive import clipped, fill_days, is_runs
from stocklens.plans.layout import read_current, swap_overwrite

# Source table -> tracking column and topic.
INPUTS: dict[str, tuple[str, str]] = {
    "inventory_transactions": ("stream_seq", "inventory_topic"),
    "purchase_order_lines": ("created_at", "po_lines_topic"),
    "sales_order_lines": ("created_at", "sales_lines_topic"),
    "inventory_snapshot_daily": ("created_at", "snapshot_topic"),
    "stock_counts": ("created_at", "stock_counts_topic"),
    "skus": ("created_at", "dim_skus_topic"),
    "warehouses": ("created_at", "dim_warehouses_topic"),
    "suppliers": ("created_at", "dim_suppliers_topic"),
    "customers": ("created_at", "dim_customers_topic"),
}

# Quantity columns that travel as integers.
QUANTITIES = [
    "qty_change", "qty_ordered", "qty_received", "qty", "system_qty", "counted_qty",
    "variance_qty", "on_hand_qty", "reserved_qty", "damaged_qty", "in_transit_qty",
    "available_qty",
]

FETCH_ROWS = 5000
DAY_FORMAT = "yyyy-MM-dd"


def _mark_lit(value: int | datetime) -> Column:
    return timestamp_lit(value) if isinstance(value, datetime) else F.lit(value)


def incremental_read(
    df: DataFrame, column: str, last: int | datetime, overlap_seconds: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Rows beyond the high-water mark, and the new mark as a one-row frame.

    The comparison is strict, as the poll statement is. ``overlap_seconds`` reads the last
    seconds before a time mark again, to catch rows that were committed late with the same
    second; the copies this brings are removed by an upsert with ``with_row_key``, or by the source's key.
    Rows come unsorted: the order of a poll has no meaning once rows are spread over tasks. Of runs of days
    (``derive.stock_runs``) the newer days are read.
    """
    floor = last
    if overlap_seconds and isinstance(last, datetime):
        floor = last - timedelta(seconds=overlap_seconds)
    if is_runs(df) and isinstance(floor, datetime):  # a day begins at midnight, so it is newer from the next one on
        newer, column = clipped(df, first=floor.date() + timedelta(days=1)), "valid_to"
    else:
        newer = df.filter(F.col(column) > _mark_lit(floor))
    mark = newer.agg(F.greatest(F.max(column), _mark_lit(last)).alias("mark"))
    return newer, mark


ROW_KEY = ["row_key", "copy"]


def with_row_key(df: DataFrame, landed: str = "ingestion_time") -> DataFrame:
    """Rows of a source without a key, each with one: a digest of its values, landing time left out, and
    its number among equal rows. Reading a row again, by an overlapping poll, gives the same key. The digest is
    the first 128 bits of SHA-256, as bytes: hex text of all of it was most of what a poll shuffled.

    Equal rows are counted on the map side before they are numbered, so very many of them are one row a
    task. The newest landing time stands for all of them.
    """
    own = [c for c in df.columns if c != landed]
    newest = [F.max(landed).alias(landed)] if landed in df.columns else []
    counted = df.groupBy(*own).agg(F.count(F.lit(1)).alias("n"), *newest)
    text = F.to_json(F.struct(*own), WITH_NULLS)
    numbered = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    return numbered.select(*df.columns, _digest(text).alias("row_key"), "copy")


WITH_NULLS = {"ignoreNullFields": "false"}


def _digest(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def runs_with_row_text(runs: DataFrame, day: str = "snapshot_date", landed: str = "ingestion_time") -> DataFrame:
    """Runs of days, numbered as by ``with_row_key``, with what their days get keys from
    (``days_with_row_key``): the text of a row around its day. Runs of a key must be equal or apart, as for
    ``staging.stg_snapshot``: then rows of a day are equal where their runs are."""
    own = [c for c in runs.columns if c != landed]
    newest = [F.max(landed).alias(landed)] if landed in runs.columns else []
    counted = runs.groupBy(*own).agg(F.count(F.lit(1)).alias("n"), *newest)
    head, tail = text_around_day(own, day, WITH_NULLS)
    numbered = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    return numbered.select(*runs.columns, head.alias("head"), tail.alias("tail"), "copy")


def days_with_row_key(days: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """``with_row_key`` of the days of ``runs_with_row_text``."""
    text = F.concat("head", F.col(day).cast("string"), "tail")
    columns = [c for c in days.columns if c not in ("head", "tail", "copy")]
    return days.select(*columns, _digest(text).alias("row_key"), "copy")


def text_around_day(names: Sequence[str], day: str, options: dict[str, str]) -> tuple[Column, Column]:
    """JSON of the days of runs, as the text before and after that of the day, which stands for ``valid_from``."""
    at = list(names).index("valid_from")

    def fields(part: Sequence[str]) -> Column:
        """The fields of an object without its braces; empty if there are none."""
        part = [c for c in part if c not in ("valid_from", "valid_to")]
        if not part:
            return F.lit("")
        text = F.to_json(F.struct(*part), options)
        return F.substring(text, F.lit(2), F.length(text) - 2)

    before, after = fields(names[:at]), fields(names[at:])
    head = F.concat(F.lit("{"), before, F.when(before != "", ",").otherwise(""), F.lit(f'"{day}":"'))
    tail = F.concat(F.lit('"'), F.when(after != "", ",").otherwise(""), after, F.lit("}"))
    return head, tail


def jdbc_options(
    url: str,
    table: str,
    column: str,
    last: int | datetime,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Reader options of one poll: the mark is tested by the database, the key range is split."""
    literal = f"'{last:%Y-%m-%d %H:%M:%S}'" if isinstance(last, datetime) else str(last)
    options = {
        "url": url,
        "dbtable": f"(SELECT * FROM {table} WHERE {column} > {literal}) poll",
        "fetchsize": str(FETCH_ROWS),
    }
    if partition_column and bounds:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def save_mark(mark: DataFrame, path: str) -> None:
    """Keep a mark for the next poll; it is replaced in one step."""
    swap_overwrite(mark, path)


def load_mark(spark: SparkSession, path: str):
    return read_current(spark, path).first()["mark"]


def extract_snapshot(snapshot: DataFrame, skus: DataFrame) -> DataFrame:
    """Snapshot rows with the unit cost of their SKU; NULL for an unknown SKU."""
    cost = skus.select("sku_id", "unit_cost")
    return snapshot.drop("unit_cost").join(cost, "sku_id", "left")


def to_wire(df: DataFrame, keep_time: Sequence[str] = ()) -> DataFrame:
    """Rows as they are published: lower-case names, dates as text, money as double.

    The tracking column of movements is not published.
    """
    out = []
    for field in df.schema.fields:
        name, kind = field.name.lower(), field.dataType.typeName()
        c = F.col(f"`{field.name}`")
        if name == "stream_seq":
            continue
        if name in QUANTITIES:
            c = c.cast("int")
        elif kind == "date" and name not in keep_time:
            c = F.date_format(c, DAY_FORMAT)
        elif kind in ("timestamp", "timestamp_ntz") and name not in keep_time:
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "decimal":
            c = c.cast("double")
        out.append(c.alias(name))
    return df.select(*out)


def day_text(day: str, first: date, last: date) -> Column:
    """The text of a day. Those from ``first`` to ``last`` are written once and looked up by number; any other
    day is formatted.
    """
    texts = [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]
    known = F.get(F.array(*map(F.lit, texts)), F.datediff(day, F.lit(first)))
    return F.coalesce(known, F.date_format(day, DAY_FORMAT))


def wire_runs(runs: DataFrame) -> DataFrame:
    """``to_wire`` of snapshot runs; their ends stay dates until the days are filled in."""
    return to_wire(runs, keep_time=("valid_from", "valid_to"))


def wire_snapshot(runs: DataFrame, first: date, last: date) -> DataFrame:
    """``to_wire`` of the days of snapshot runs. All values but the day are shaped once per run, before the
    days are filled in.
    """
    return fill_days(wire_runs(runs)).withColumn("snapshot_date", day_text("snapshot_date", first, last))
