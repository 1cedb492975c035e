"""Replenishment panels."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.functions import count_where, not_below_zero, ratio, sum_long
from stocklens.functions.core import ratio_units
from stocklens.operators.filters import (
    NO_FILTERS, Filters, chosen, in_range, or_key, or_unknown, rolled_up, with_dims,
)
from stocklens.operators.mart import Tables
from stocklens.operators.reports import below_reorder
from stocklens.plans.layout import since

ALL = "WRCBK"
NO_DEMAND_COVER = 9999.0  # Fixed value: days of cover of a SKU that does not sell.


def _open_lines(t: Tables, f: Filters) -> DataFrame:
    rows = t.po_lines.filter(F.col("qty_open") > 0)
    measures = [sum_long("qty_open").alias("qty_open"), F.count(F.lit(1)).alias("lines")]
    return rolled_up(rows, t, f, "CBK", [], measures)


def open_po_qty(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return _open_lines(t, f).agg(sum_long("qty_open").alias("value"))


def open_po_lines(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return _open_lines(t, f).agg(sum_long("lines").alias("value"))


def avg_lead_time(t: Tables) -> DataFrame:
    days = t.supplier.agg(
        F.sum("lead_time_days").alias("days"), F.count("lead_time_days").alias("n")
    )
    return days.select(ratio(F.col("days"), F.col("n")).alias("value"))


def suggested_reorder_qty(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    rows = with_dims(t.latest_snapshot(), t, f, ALL, ["reorder_point", "max_stock"])
    gap = not_below_zero(F.col("max_stock") - F.col("available_qty"))
    return rows.filter(below_reorder()).agg(sum_long(gap).alias("value"))


def supplier_sla(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    """Share of suppliers whose lead time is a week or less; zero without suppliers."""
    counts = t.supplier.filter(chosen("supplier_name", f.supplier)).agg(
        count_where(F.col("lead_time_days") <= 7).alias("fast"), F.count(F.lit(1)).alias("n")
    )
    rate = F.coalesce(ratio(F.col("fast"), F.col("n"), 4), F.lit(0.0))
    return counts.select(rate.alias("supplier_on_time_sla_rate"))


def _stock_and_demand(t: Tables, f: Filters, as_of: date) -> DataFrame:
    """Stock, policy and 30-day demand per SKU.

    Stock follows every variable; demand has no warehouse and follows category, brand and SKU.
    The inner key set is the stock's, so its product filters cover the demand as well.
    """
    stock = (
        with_dims(t.latest_snapshot(), t, f, ALL)
        .groupBy("sku_id")
        .agg(sum_long("available_qty").alias("available_qty"))
    )
    sold = (
        since(t.sales_lines, "created_date", as_of - timedelta(days=30))
        .groupBy("sku_id")
        .agg(sum_long("qty").alias("sold"))
    )
    need = ["sku_name", "category", "reorder_point", "max_stock"]
    rows = with_dims(stock, t, NO_FILTERS, "", need).join(sold, "sku_id", "left")
    # Demand per day in hundredths keeps the division below exact.
    hundredths = F.coalesce(ratio_units(F.col("sold"), F.lit(30)), F.lit(0))
    return rows.withColumn("demand_units", hundredths).withColumns(
        {
            "avg_daily_demand": F.col("demand_units") / F.lit(100),
            "recommended_reorder_qty": not_below_zero(
                F.col("max_stock") - F.col("available_qty")
            ).cast("bigint"),
        }
    )


def replenishment_plan(t: Tables, f: Filters, as_of: date) -> DataFrame:
    units = F.col("demand_units")
    cover = F.when(units > 0, ratio(F.col("available_qty") * 100, units))
    urgent = below_reorder()
    return (
        _stock_and_demand(t, f, as_of)
        .filter((F.col("reorder_point") > 0) | (F.col("max_stock") > 0))
        .orderBy(
            F.when(urgent, 0).otherwise(1), F.desc("recommended_reorder_qty"),
            F.desc("demand_units"), "sku_id",
        )
        .limit(50)
        .select(
            "sku_id", or_key("sku_name", "sku_id").alias("sku_name"),
            or_unknown("category").alias("category"), "available_qty", "reorder_point",
            "max_stock", "avg_daily_demand", "recommended_reorder_qty",
            F.when(urgent, "Urgent").otherwise("Watch").alias("recommendation_priority"),
            F.coalesce(cover, F.lit(NO_DEMAND_COVER)).alias("days_of_cover"),
        )
    )


def stock_cover(t: Tables, f: Filters, as_of: date) -> DataFrame:
    """Days that the stock of every SKU lasts at its 30-day demand; null without demand."""
    units = F.col("demand_units")
    return _stock_and_demand(t, f, as_of).select(
        "sku_id", or_key("sku_name", "sku_id").alias("sku_name"), or_unknown("category").alias("category"),
        "available_qty", "avg_daily_demand",
        F.when(units > 0, ratio(F.col("available_qty") * 100, units)).alias("days_of_cover"),
    )


def urgent_replenishment(t: Tables, as_of: date) -> DataFrame:
    return (
        _stock_and_demand(t, NO_FILTERS, as_of)
        .filter(below_reorder())
        .orderBy(F.desc("recommended_reorder_qty"), F.desc("demand_units"), "sku_id")
        .limit(50)
        .select(
            "sku_id", or_key("sku_name", "sku_id").alias("sku_name"),
            or_unknown("category").alias("category"), "available_qty", "reorder_point",
            "max_stock", "avg_daily_demand", "recommended_reorder_qty",
        )
    )


def po_trend(t: Tables, f: Filters, as_of: date) -> DataFrame:
    rows = in_range(t.po_lines, "created_date", f, as_of)
    measures = [
        sum_long("qty_open").alias("open_qty"), sum_long("qty_received").alias("received_qty"),
    ]
    return (
        rolled_up(rows, t, f, "CBK", ["created_date"], measures)
        .groupBy(F.col("created_date").cast("timestamp").alias("time"))
        .agg(sum_long("open_qty").alias("open_qty"), sum_long("received_qty").alias("received_qty"))
        .orderBy("time")
    )
