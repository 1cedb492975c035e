"""Clean and conform raw tables into staging."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions import (
    landed_once,
    latest_per_key,
    money,
    normalise_keys,
    not_below_zero,
    parse_time,
)

DAYS_BEFORE = 800
DAYS_AFTER = 60


def movement_columns(qty: str = "qty_change") -> dict[str, Column]:
    """Direction and unsigned quantities of a signed movement."""
    q = F.col(qty)
    return {
        "event_type": F.when(q > 0, "inbound").when(q < 0, "outbound").otherwise("adjustment"),
        "qty_in": F.when(q > 0, q).otherwise(0).cast("int"),
        "qty_out": F.when(q < 0, -q).otherwise(0).cast("int"),
    }


def _once(raw: DataFrame, keys: list[str], dedupe: bool) -> DataFrame:
    """One row of each key, if the source has the key's columns at all."""
    return landed_once(raw, keys) if dedupe and set(keys) <= set(raw.columns) else raw


def stg_transactions(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    """Movements have no key of their own; a source with ``stream_seq`` is staged once by it."""
    raw = _once(raw, ["stream_seq"], dedupe)
    return (
        normalise_keys(raw, ["warehouse_id", "sku_id"])
        .withColumn("event_date", F.to_date("event_time"))
        .withColumns(movement_columns())
        .select(
            "event_date", "event_time", "warehouse_id", "sku_id", "qty_change",
            "event_type", "qty_in", "qty_out", "ingestion_time",
        )
    )


def stg_snapshot(raw: DataFrame, dedupe: bool = True, clamp: bool = True) -> DataFrame:
    """``clamp=False`` keeps negative stock: the mart's monitors have to see it.

    Rows of days, or runs of days (``derive.stock_runs``), which are staged once by both ends and stay runs.
    The runs of a key must be equal or apart, as those of one landing are, also if it comes twice.
    """
    floor = not_below_zero if clamp else F.col
    money_floor = not_below_zero if clamp else (lambda c: c)
    quantities = ["on_hand_qty", "reserved_qty", "damaged_qty", "in_transit_qty", "available_qty"]
    days = ["valid_from", "valid_to"] if "valid_from" in raw.columns else ["snapshot_date"]
    conformed = normalise_keys(raw, ["warehouse_id", "sku_id"])
    return (
        _once(conformed, [*days, "warehouse_id", "sku_id"], dedupe)
        .withColumns({c: floor(c).cast("int") for c in quantities})
        .withColumns({c: money(money_floor(money(c))) for c in ["inventory_value", "unit_cost"]})
        .select(
            *days, "warehouse_id", "sku_id", *quantities,
            "inventory_value", "unit_cost", "created_at", "ingestion_time",
        )
    )


def stg_po_lines(raw: DataFrame, dedupe: bool = False) -> DataFrame:
    """``dedupe`` is for sources whose line ids are unique; others would lose lines by it."""
    raw = _once(raw, ["po_line_id"], dedupe)
    status = F.trim("line_status")
    return (
        normalise_keys(raw, ["sku_id"])
        # Clamp first; the open quantity is taken from the clamped values.
        .withColumns({c: not_below_zero(c).cast("int") for c in ["qty_ordered", "qty_received"]})
        .withColumns(
            {
                "created_date": F.to_date("created_at"),
                "qty_open": not_below_zero(F.col("qty_ordered") - F.col("qty_received")).cast("int"),
                "unit_cost": money(not_below_zero(money("unit_cost"))),
                "line_status": F.when(status == "", "unknown").otherwise(status),
            }
        )
        .select(
            "created_date", "po_id", "po_line_id", "line_no", "sku_id", "qty_ordered",
            "qty_received", "qty_open", "unit_cost", "line_status", "created_at", "ingestion_time",
        )
    )


def stg_sales_lines(raw: DataFrame, dedupe: bool = False) -> DataFrame:
    """``dedupe``: as for purchase lines."""
    raw = _once(raw, ["so_line_id"], dedupe)
    return (
        normalise_keys(raw, ["sku_id"])
        .withColumns(
            {
                "created_date": F.to_date("created_at"),
                "qty": not_below_zero("qty").cast("int"),
                "unit_price": money(not_below_zero(money("unit_price"))),
            }
        )
        .withColumn("sales_amount", money(F.col("qty") * F.col("unit_price")))
        .select(
            "created_date", "order_id", "so_line_id", "line_no", "sku_id", "qty",
            "unit_price", "sales_amount", "created_at", "ingestion_time",
        )
    )


def stg_stock_counts(raw: DataFrame, dedupe: bool = False) -> DataFrame:
    """``dedupe`` is for sources whose count ids are unique."""
    raw = _once(raw, ["count_id"], dedupe)
    return (
        normalise_keys(raw, ["warehouse_id", "sku_id"])
        # The landed variance is not trusted.
        .withColumn("variance_qty", (F.col("counted_qty") - F.col("system_qty")).cast("int"))
        .select(
            "count_date", "warehouse_id", "sku_id", "system_qty", "counted_qty",
            "variance_qty", "created_at", "ingestion_time",
        )
    )


def _latest(raw: DataFrame, key: str, shaped: dict[str, Column], dedupe: bool) -> DataFrame:
    """Conform one dimension and keep its newest version per key."""
    version = F.coalesce(parse_time("created_at"), F.timestamp_seconds(F.lit(0)))
    out = normalise_keys(raw, [key]).select(
        key, *[c.alias(name) for name, c in shaped.items()], version.alias("created_at")
    )
    return latest_per_key(out, [key], "created_at") if dedupe else out


def _texts(*names: str) -> dict[str, Column]:
    return {n: F.trim(n) for n in names}


def _counts(*names: str) -> dict[str, Column]:
    return {n: not_below_zero(n).cast("int") for n in names}


def stg_product(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    prices = {n: money(not_below_zero(money(n))) for n in ["unit_cost", "selling_price"]}
    shaped = {
        **_texts("sku_name", "category", "subcategory", "brand", "uom"),
        **prices,
        **_texts("status"),
        **_counts("reorder_point", "safety_stock", "max_stock", "shelf_life_days"),
        **_texts("abc_class"),
    }
    return _latest(raw, "sku_id", shaped, dedupe)


def stg_warehouse(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    return _latest(raw, "warehouse_id", _texts("warehouse_name", "city", "region"), dedupe)


def stg_supplier(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    rating = not_below_zero(F.col("rating").cast("decimal(4,2)")).cast("decimal(4,2)")
    shaped = {
        **_texts("supplier_name", "country"),
        **_counts("lead_time_days"),
        "rating": rating,
        **_counts("payment_terms_days"),
    }
    return _latest(raw, "supplier_id", shaped, dedupe)


def stg_customer(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    shaped = _texts("customer_name", "segment", "city", "region")
    return _latest(raw, "customer_id", shaped, dedupe)


def days_from(spark: SparkSession, start: date, days: int) -> DataFrame:
    day = F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date")
    return spark.range(days).select(day)


def days_around(facts: DataFrame, date_col: str) -> DataFrame:
    """The days of the date dimension around the newest day of a fact."""
    newest = facts.agg(F.max(F.to_date(date_col)).alias("d"))
    span = F.sequence(F.date_sub("d", DAYS_BEFORE), F.date_add("d", DAYS_AFTER))
    return newest.select(F.explode(span).alias("full_date"))


def calendar(days: DataFrame, full_day_names: bool = False) -> DataFrame:
    """Calendar attributes of days; weekday 1 is Monday."""
    weekday = F.weekday("full_date") + 1
    return days.select(
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year("full_date").alias("calendar_year"),
        F.quarter("full_date").alias("calendar_quarter"),
        F.month("full_date").alias("calendar_month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofmonth("full_date").alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format("full_date", "EEEE" if full_day_names else "E").alias("day_name"),
        F.when(weekday >= 6, 1).otherwise(0).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, as_of: date) -> DataFrame:
    start = as_of - timedelta(days=DAYS_BEFORE)
    return calendar(days_from(spark, start, DAYS_BEFORE + DAYS_AFTER + 1))


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of every table."""
    counted = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        counted = one if counted is None else counted.unionAll(one)
    columns = [F.max(F.when(F.col("tbl") == n, F.col("n"))).alias(n) for n in tables]
    return counted.agg(*columns)
