"""Stock exception panels."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions import count_where, sum_long
from stocklens.operators.filters import (
    HEALTHY, LOW, NO_FILTERS, OVERSTOCK, STOCKOUT, Filters, chosen, or_key, or_unknown, with_dims,
)
from stocklens.operators.mart import Tables
from stocklens.operators.reports import above_max, below_reorder
from stocklens.plans.layout import since

ALL = "WRCBK"


def status_of_row() -> Column:
    """Status by precedence: stockout, low stock, overstock, healthy."""
    return (
        F.when(F.col("available_qty") <= 0, STOCKOUT)
        .when(below_reorder(), LOW)
        .when(above_max(), OVERSTOCK)
        .otherwise(HEALTHY)
    )


def stock_status(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    """Latest stock with names, policy and status; the base of the panels below."""
    need = ["warehouse_name", "sku_name", "category", "brand", "reorder_point", "max_stock"]
    return with_dims(t.latest_snapshot(), t, f, ALL, need).select(
        "warehouse_id", "sku_id",
        or_key("warehouse_name", "warehouse_id").alias("warehouse"),
        or_key("sku_name", "sku_id").alias("sku_name"),
        or_unknown("category").alias("category"),
        or_unknown("brand").alias("brand"),
        "on_hand_qty", "available_qty", "reserved_qty", "reorder_point", "max_stock",
        "inventory_value", status_of_row().alias("stock_status"),
    )


def status_distribution(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return (
        stock_status(t, f)
        .filter(chosen("stock_status", f.stock_status))
        .groupBy("stock_status")
        .agg(F.count(F.lit(1)).alias("sku_count"))
        .orderBy(F.desc("sku_count"), "stock_status")
    )


def low_stock_by_warehouse(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    """Rows under their reorder point per warehouse, stockouts included.

    Starts from the warehouses, so one without stock stays listed with zero, unless a chosen
    category, brand or SKU removes it. Stock is counted per warehouse before the join.
    """
    stock = with_dims(t.latest_snapshot(), t, f, "CBK", ["reorder_point"])
    shown = f.stock_status is None or LOW in f.stock_status
    per_site = stock.groupBy("warehouse_id").agg(
        count_where(F.lit(shown) & below_reorder()).alias("low")
    )
    narrowed = any(v is not None for v in (f.category, f.brand, f.sku))
    sites = t.warehouse.filter(chosen("warehouse_id", f.warehouse) & chosen("region", f.region))
    return (
        sites.join(per_site, "warehouse_id", "inner" if narrowed else "left")
        .groupBy(or_key("warehouse_name", "warehouse_id").alias("warehouse"))
        .agg(sum_long("low").alias("low_stock_items"))
        .orderBy(F.desc("low_stock_items"), "warehouse")
    )


def below_reorder_count(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    rows = stock_status(t, f).filter(chosen("stock_status", f.stock_status))
    return rows.agg(count_where(below_reorder()).alias("value"))


def negative_available_count(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return stock_status(t, f).agg(count_where(F.col("available_qty") < 0).alias("value"))


def exception_matrix(t: Tables, f: Filters = NO_FILTERS, limit: int = 200) -> DataFrame:
    status = F.col("stock_status")
    rank = F.when(status == STOCKOUT, 0).when(status == LOW, 1).otherwise(2)
    return (
        stock_status(t, f)
        .filter(chosen("stock_status", f.stock_status) & (status != HEALTHY))
        .orderBy(rank, F.desc("inventory_value"), "warehouse_id", "sku_id")
        .limit(limit)
        .select(
            "warehouse", "sku_id", "sku_name", "category", "brand", "on_hand_qty",
            "available_qty", "reserved_qty", "reorder_point", "max_stock", "stock_status",
            "inventory_value",
        )
    )


def zero_stock_with_demand(t: Tables, f: Filters, as_of: date) -> DataFrame:
    """Rows without stock whose SKU sold in the last 30 days, anywhere."""
    demand = (
        since(t.sales_lines, "created_date", as_of - timedelta(days=30))
        .groupBy("sku_id")
        .agg(sum_long("qty").alias("sold_qty_30d"))
    )
    return (
        stock_status(t, f)
        .filter(F.col("available_qty") <= 0)
        .join(demand, "sku_id")
        .orderBy(F.desc("sold_qty_30d"), "sku_id", "warehouse_id")
        .limit(30)
        .select("warehouse", "sku_id", "sku_name", "category", "available_qty", "sold_qty_30d")
    )


def largest_overstock(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    excess = F.col("available_qty") - F.col("max_stock")
    return (
        stock_status(t, f)
        .filter(F.col("stock_status") == OVERSTOCK)
        .withColumn("excess_qty", excess)
        .orderBy(F.desc("excess_qty"), F.desc("inventory_value"), "warehouse_id", "sku_id")
        .limit(30)
        .select(
            "warehouse", "sku_id", "sku_name", "category", "available_qty", "max_stock",
            "excess_qty", "inventory_value",
        )
    )
