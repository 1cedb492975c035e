"""Data reliability and SKU drill-down panels."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.functions import count_where, sum_long, sum_money, timestamp_lit
from stocklens.operators.filters import NO_FILTERS, Filters, in_range, rolled_up, with_dims
from stocklens.operators.mart import Tables, one_row

ALL = "WRCBK"


def negative_stock_rows(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    rows = with_dims(t.latest_snapshot(), t, f, ALL)
    return rows.agg(count_where(F.col("available_qty") < 0).alias("negative_stock_rows"))


def snapshot_lag_hours(t: Tables, f: Filters, now: datetime) -> DataFrame:
    """Whole hours since the newest landed snapshot row; NULL without rows."""
    if f == NO_FILTERS:
        newest = one_row(t, t.newest_landing("snapshot").alias("newest"))
    else:
        landed = F.max("ingestion_time").alias("newest")
        newest = rolled_up(t.snapshot, t, f, ALL, [], [landed]).agg(F.max("newest").alias("newest"))
    seconds = F.unix_timestamp(timestamp_lit(now)) - F.unix_timestamp("newest")
    return newest.select(F.floor(seconds / 3600).cast("bigint").alias("snapshot_lag_hours"))


def last_ingestion_millis(t: Tables) -> DataFrame:
    """Newest landing time of the five facts."""
    facts = ["snapshot", "movement", "po_lines", "sales_lines", "stock_counts"]
    newest = F.greatest(*[t.newest_landing(field) for field in facts])
    return one_row(t, F.unix_millis(newest).alias("last_mart_ingestion_time"))


def data_quality_summary(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    rows = with_dims(t.latest_snapshot(), t, f, ALL, ["category", "brand"])

    def missing(name: str):
        return count_where(F.col(name).isNull() | (F.col(name) == ""))

    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        missing("category").alias("missing_category_rows"),
        missing("brand").alias("missing_brand_rows"),
        count_where(F.col("available_qty") < 0).alias("negative_available_rows"),
    )


def sku_stock_trend(t: Tables, f: Filters, as_of: date) -> DataFrame:
    rows = with_dims(in_range(t.snapshot, "snapshot_date", f, as_of), t, f, "WK")
    return (
        rows.groupBy(F.col("snapshot_date").cast("timestamp").alias("time"))
        .agg(sum_long("available_qty").alias("available_qty"),
             sum_long("on_hand_qty").alias("on_hand_qty"))
        .orderBy("time")
    )


def sku_sales_trend(t: Tables, f: Filters, as_of: date) -> DataFrame:
    rows = with_dims(in_range(t.sales_lines, "created_date", f, as_of), t, f, "K")
    return (
        rows.groupBy(F.col("created_date").cast("timestamp").alias("time"))
        .agg(sum_long("qty").alias("sold_qty"), sum_money("sales_amount").alias("sales_amount"))
        .orderBy("time")
    )


def sku_detail(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    order = [F.desc("inventory_value"), F.asc("warehouse_id"), F.asc("sku_id")]
    top = with_dims(t.latest_snapshot(), t, f, "WK").orderBy(*order).limit(50)
    need = ["sku_name", "category", "brand", "reorder_point", "max_stock"]
    return with_dims(top, t, NO_FILTERS, "", need).orderBy(*order).select(
        "warehouse_id", "sku_id", "sku_name", "category", "brand", "on_hand_qty",
        "available_qty", "reorder_point", "max_stock", "inventory_value",
    )
