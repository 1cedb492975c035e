"""Executive summary panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions import count_where, epoch_millis, sum_long, sum_money
from stocklens.operators.filters import (
    NO_FILTERS, Filters, or_key, or_unknown, rolled_up, with_dims,
)
from stocklens.operators.mart import Tables, one_row
from stocklens.operators.reports import above_max, below_reorder

ALL = "WRCBK"


def latest_kpi(t: Tables, f: Filters, value: Column, need: tuple[str, ...] = ()) -> DataFrame:
    """One number over the latest snapshot."""
    return with_dims(t.latest_snapshot(), t, f, ALL, need).agg(value.alias("value"))


def latest_snapshot_millis(t: Tables) -> DataFrame:
    return one_row(t, epoch_millis(t.newest_day()).alias("value"))


def on_hand_total(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return latest_kpi(t, f, sum_long("on_hand_qty"))


def available_total(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return latest_kpi(t, f, sum_long("available_qty"))


def value_total(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return latest_kpi(t, f, sum_money("inventory_value"))


def low_stock_count(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return latest_kpi(t, f, count_where(below_reorder()), ("reorder_point",))


def overstock_count(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return latest_kpi(t, f, count_where(above_max()), ("max_stock",))


def value_over_time(t: Tables) -> DataFrame:
    value = sum_money("inventory_value").alias("inventory_value")
    return t.snapshot.groupBy(F.col("snapshot_date").alias("time")).agg(value).orderBy("time")


def value_by_warehouse(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    value = sum_money("inventory_value").alias("inventory_value")
    sums = rolled_up(
        t.latest_snapshot(), t, f, ALL, ["warehouse_id"], [value], ["warehouse_name"]
    )
    return (
        sums.groupBy(or_key("warehouse_name", "warehouse_id").alias("warehouse"))
        .agg(sum_money("inventory_value").alias("inventory_value"))
        .orderBy(F.desc("inventory_value"), "warehouse")
    )


def value_by_category(t: Tables) -> DataFrame:
    value = sum_money("inventory_value").alias("inventory_value")
    sums = rolled_up(t.latest_snapshot(), t, NO_FILTERS, "", ["sku_id"], [value], ["category"])
    return (
        sums.groupBy(or_unknown("category").alias("category"))
        .agg(sum_money("inventory_value").alias("inventory_value"))
        .orderBy(F.desc("inventory_value"), "category")
    )


def _named_rows(t: Tables, policy: str) -> DataFrame:
    need = ["warehouse_name", "sku_name", "category", policy]
    return with_dims(t.latest_snapshot(), t, NO_FILTERS, "", need)


def _ranked(rows: DataFrame, policy: str, gap: Column, name: str) -> DataFrame:
    return (
        rows.withColumn(name, gap)
        .orderBy(F.desc(name), F.desc("inventory_value"), "warehouse_id", "sku_id")
        .limit(10)
        .select(
            or_key("warehouse_name", "warehouse_id").alias("warehouse"), "sku_id",
            or_key("sku_name", "sku_id").alias("sku_name"),
            or_unknown("category").alias("category"),
            "available_qty", policy, name, "inventory_value",
        )
    )


def top_low_stock(t: Tables) -> DataFrame:
    rows = _named_rows(t, "reorder_point").filter(below_reorder())
    gap = F.col("reorder_point") - F.col("available_qty")
    return _ranked(rows, "reorder_point", gap, "gap_qty")


def top_overstock(t: Tables) -> DataFrame:
    rows = _named_rows(t, "max_stock").filter(above_max())
    excess = F.col("available_qty") - F.col("max_stock")
    return _ranked(rows, "max_stock", excess, "excess_qty")
