"""Movement flow panels."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.functions import ratio, sum_long, sum_money
from stocklens.operators.dashboards.executive import latest_kpi
from stocklens.operators.filters import (
    NO_FILTERS, Filters, chosen, or_key, or_unknown, rolled_up, with_dims,
)
from stocklens.operators.mart import Tables
from stocklens.plans.layout import since

ALL = "WRCBK"
PAIR = ["warehouse_id", "sku_id"]


def avg_daily_sold(t: Tables, f: Filters, as_of: date) -> DataFrame:
    rows = since(t.sales_lines, "created_date", as_of - timedelta(days=30))
    sums = rolled_up(rows, t, f, "CBK", [], [sum_long("qty").alias("qty")])
    sold = sums.agg(sum_long("qty").alias("sold"))
    return sold.select(ratio(F.col("sold"), F.lit(30)).alias("value"))


def damaged_total(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return latest_kpi(t, f, sum_long("damaged_qty"))


def in_transit_total(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    return latest_kpi(t, f, sum_long("in_transit_qty"))


def _moved(
    t: Tables, f: Filters, as_of: date, days: int, keys: list[str], need: tuple[str, ...] = ()
) -> DataFrame:
    rows = since(t.movement, "event_date", as_of - timedelta(days=days))
    measures = [
        sum_long("qty_in").alias("qty_in"),
        sum_long("qty_out").alias("qty_out"),
        sum_long(F.abs("qty_change")).alias("volume"),
    ]
    return rolled_up(rows, t, f, ALL, keys, measures, need)


def inbound_outbound(t: Tables, f: Filters, as_of: date) -> DataFrame:
    return (
        _moved(t, f, as_of, 90, ["event_date"])
        .groupBy(F.col("event_date").alias("time"))
        .agg(sum_long("qty_in").alias("inbound_qty"), sum_long("qty_out").alias("outbound_qty"))
        .orderBy("time")
    )


def receiving_dispatch(t: Tables, f: Filters, as_of: date) -> DataFrame:
    return (
        _moved(t, f, as_of, 30, ["warehouse_id"], ("warehouse_name",))
        .groupBy(or_key("warehouse_name", "warehouse_id").alias("warehouse"))
        .agg(sum_long("qty_in").alias("received_qty"), sum_long("qty_out").alias("dispatched_qty"))
        .orderBy(F.desc("received_qty"), "warehouse")
    )


def top_movers(t: Tables, f: Filters, as_of: date) -> DataFrame:
    return (
        _moved(t, f, as_of, 30, ["sku_id"], ("sku_name", "category", "unit_cost"))
        .groupBy(
            "sku_id", or_key("sku_name", "sku_id").alias("sku_name"),
            or_unknown("category").alias("category"),
        )
        .agg(
            sum_long("qty_in").alias("qty_in"),
            sum_long("qty_out").alias("qty_out"),
            sum_long("volume").alias("movement_volume"),
            sum_money(F.col("volume") * F.col("unit_cost")).alias("movement_value_proxy"),
        )
        .orderBy(F.desc("movement_volume"), "sku_id")
        .limit(20)
    )


def slow_movers(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    """Stocked pairs by days since their last movement; it ranks, it does not filter.

    A pair that never moved counts zero days.
    """
    moves = t.last_moves().filter(chosen("warehouse_id", f.warehouse) & chosen("sku_id", f.sku))
    per_pair = with_dims(t.latest_snapshot(), t, f, ALL).groupBy("snapshot_date", *PAIR).agg(
        sum_long("available_qty").alias("available_qty"),
        sum_money("inventory_value").alias("inventory_value"),
    )
    days = F.datediff("snapshot_date", F.coalesce("last_event_date", "snapshot_date"))
    idle = F.col("days_since_last_movement") >= 30
    ranks = [
        F.when(idle, 0).otherwise(1), F.desc("days_since_last_movement"),
        F.desc("inventory_value"), F.col("warehouse_id"), F.col("sku_id"),
    ]
    top = (
        per_pair.filter(F.col("available_qty") > 0)
        .join(moves, PAIR, "left")
        .withColumn("days_since_last_movement", days)
        .orderBy(*ranks).limit(20)
    )
    return (
        with_dims(top, t, NO_FILTERS, "", ["sku_name", "category"])
        .orderBy(*ranks)
        .select(
            "warehouse_id", "sku_id", or_key("sku_name", "sku_id").alias("sku_name"),
            or_unknown("category").alias("category"), "available_qty", "inventory_value",
            "last_event_date", "days_since_last_movement",
            F.when(idle, "No movement >=30d").otherwise("Slowest recent movers")
            .alias("movement_flag"),
        )
    )


def idle_skus(t: Tables, as_of: date) -> DataFrame:
    """Stocked SKUs that never moved, or not in the last 30 days."""
    stock = t.latest_snapshot().groupBy("sku_id").agg(
        sum_long("available_qty").alias("available_qty"),
        sum_money("inventory_value").alias("inventory_value"),
    )
    last = F.col("last_event_date")
    moves = t.last_moves().groupBy("sku_id").agg(F.max(last).alias("last_event_date"))
    top = (
        stock.filter(F.col("available_qty") > 0)
        .join(moves, "sku_id", "left")
        .filter(last.isNull() | (last < F.lit(as_of - timedelta(days=30))))
        .orderBy(F.desc("inventory_value"), F.desc("available_qty"), "sku_id")
        .limit(20)
    )
    return (
        with_dims(top, t, NO_FILTERS, "", ["sku_name", "category"])
        .select(
            "sku_id", or_key("sku_name", "sku_id").alias("sku_name"),
            or_unknown("category").alias("category"), "available_qty", "inventory_value",
            "last_event_date",
        )
        .orderBy(F.desc("inventory_value"), F.desc("available_qty"), "sku_id")
    )
