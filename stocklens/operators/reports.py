"""Business reports over the latest stock, recent movements and open purchases."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions import count_where, not_below_zero, ratio, sum_long, sum_money
from stocklens.functions import timestamp_lit
from stocklens.operators.filters import NO_FILTERS, or_key, with_dims
from stocklens.operators.mart import Tables, one_row
from stocklens.plans.layout import since

MAX_SQL_ROWS = 200
MAX_SAMPLE_ROWS = 20

# How a read-only statement may start, and the words it may not contain.
READ_STARTS = ("select", "with", "show", "describe", "explain")
WRITE_WORDS = (
    "insert", "update", "delete", "drop", "alter", "create", "truncate", "optimize",
    "grant", "revoke", "system", "kill", "attach", "detach", "rename",
)


def clamp(limit: int, most: int) -> int:
    return max(1, min(limit, most))


def below_reorder(available: str = "available_qty") -> Column:
    """Has a reorder point and is under it; false without one."""
    point = F.coalesce("reorder_point", F.lit(0))
    return (point > 0) & (F.col(available) < point)


def above_max(available: str = "available_qty") -> Column:
    top = F.coalesce("max_stock", F.lit(0))
    return (top > 0) & (F.col(available) > top)


def latest_snapshot_date(t: Tables) -> DataFrame:
    return one_row(t, t.newest_day().alias("snapshot_date"))


def product_dim(t: Tables) -> DataFrame:
    return t.product.select(
        "sku_id", "sku_name", "category", "subcategory", "brand", "reorder_point",
        "safety_stock", "max_stock", "unit_cost", "selling_price", "status", "abc_class",
    )


def warehouse_dim(t: Tables) -> DataFrame:
    return t.warehouse.select("warehouse_id", "warehouse_name", "city", "region")


def inventory_overview(t: Tables) -> DataFrame:
    """One row of totals for the latest snapshot; no row without a snapshot."""

    latest = t.latest_snapshot()
    quantities = ["on_hand_qty", "available_qty", "damaged_qty", "in_transit_qty"]
    per_sku = (
        with_dims(latest, t, NO_FILTERS, "", ["reorder_point", "max_stock"])
        .groupBy("snapshot_date", "sku_id")
        .agg(
            *[sum_long(q).alias(q) for q in quantities],
            sum_money("inventory_value").alias("inventory_value"),
            count_where(below_reorder()).alias("low"),
            count_where(above_max()).alias("over"),
        )
    )
    warehouses = latest.agg(F.count_distinct("warehouse_id")).scalar()
    return (
        per_sku.groupBy("snapshot_date")
        .agg(
            *[sum_long(q).alias(f"total_{q}") for q in quantities],
            sum_money("inventory_value").alias("total_inventory_value"),
            F.count(F.lit(1)).alias("sku_count"),
            sum_long("low").alias("low_stock_sku_count"),
            sum_long("over").alias("overstock_sku_count"),
        )
        .select(
            "snapshot_date", *[f"total_{q}" for q in quantities], "total_inventory_value",
            warehouses.alias("warehouse_count"), "sku_count", "low_stock_sku_count",
            "overstock_sku_count",
        )
    )


def warehouse_summary(t: Tables, limit: int = 5) -> DataFrame:
    rows = with_dims(t.latest_snapshot(), t, NO_FILTERS, "", ["reorder_point"])
    totals = rows.groupBy("warehouse_id").agg(
        sum_long("on_hand_qty").alias("on_hand_qty"),
        sum_long("available_qty").alias("available_qty"),
        sum_money("inventory_value").alias("inventory_value"),
        sum_long("damaged_qty").alias("damaged_qty"),
        sum_long("in_transit_qty").alias("in_transit_qty"),
        count_where(below_reorder()).alias("low_stock_sku_count"),
    )
    return (
        totals.join(warehouse_dim(t), "warehouse_id", "left")
        .select(
            "warehouse_id", or_key("warehouse_name", "warehouse_id").alias("warehouse_name"),
            "city", "region", "on_hand_qty", "available_qty", "inventory_value", "damaged_qty",
            "in_transit_qty", "low_stock_sku_count",
        )
        .orderBy(F.desc("inventory_value"), F.desc("available_qty"), "warehouse_id")
        .limit(clamp(limit, 20))
    )


def _alert_rows(t: Tables, policy: list[str]) -> DataFrame:
    need = ["sku_name", "category", "brand", "warehouse_name", *policy]
    return with_dims(t.latest_snapshot(), t, NO_FILTERS, "", need)


def low_stock_alerts(t: Tables, limit: int = 10) -> DataFrame:
    gap = F.col("reorder_point") - F.col("available_qty")
    return (
        _alert_rows(t, ["reorder_point", "safety_stock"])
        .filter(below_reorder())
        .orderBy(gap.desc(), F.desc("inventory_value"), "warehouse_id", "sku_id")
        .limit(clamp(limit, 30))
        .select(
            "warehouse_id", or_key("warehouse_name", "warehouse_id").alias("warehouse_name"),
            "sku_id", or_key("sku_name", "sku_id").alias("sku_name"), "category", "brand",
            "available_qty", "reorder_point", "safety_stock",
            ratio(F.col("available_qty"), F.col("reorder_point")).alias("coverage_ratio"),
            "inventory_value",
        )
    )


def overstock_alerts(t: Tables, limit: int = 10) -> DataFrame:
    excess = F.col("available_qty") - F.col("max_stock")
    return (
        _alert_rows(t, ["max_stock"])
        .filter(above_max())
        .orderBy(excess.desc(), F.desc("inventory_value"), "warehouse_id", "sku_id")
        .limit(clamp(limit, 30))
        .select(
            "warehouse_id", or_key("warehouse_name", "warehouse_id").alias("warehouse_name"),
            "sku_id", or_key("sku_name", "sku_id").alias("sku_name"), "category", "brand",
            "available_qty", "max_stock",
            ratio(F.col("available_qty"), F.col("max_stock")).alias("stock_ratio"),
            "inventory_value",
        )
    )


def recent_movements(
    t: Tables,
    now: datetime,
    days: int = 7,
    warehouse_id: str | None = None,
    sku_id: str | None = None,
    limit: int = 20,
) -> DataFrame:
    first = now - timedelta(days=clamp(days, 90))
    rows = since(t.movement, "event_date", first.date())
    rows = rows.filter(F.col("event_time") >= timestamp_lit(first))
    if warehouse_id:
        rows = rows.filter(F.col("warehouse_id") == warehouse_id.upper())
    if sku_id:
        rows = rows.filter(F.col("sku_id") == sku_id.upper())
    return (
        rows.groupBy("event_date", "warehouse_id", "sku_id")
        .agg(
            F.count(F.lit(1)).alias("movement_count"),
            sum_long("qty_in").alias("qty_in"),
            sum_long("qty_out").alias("qty_out"),
            sum_long("qty_change").alias("net_qty_change"),
            F.min("event_time").alias("first_event_time"),
            F.max("event_time").alias("last_event_time"),
        )
        .orderBy(
            F.desc("event_date"), F.abs("net_qty_change").desc(), F.desc("movement_count"),
            "warehouse_id", "sku_id",
        )
        .limit(clamp(limit, 50))
    )


def purchase_replenishment(t: Tables, limit: int = 10) -> DataFrame:
    """SKUs with open purchase lines. Names are joined after the roll-up to one row per SKU."""
    open_qty = not_below_zero(F.col("qty_ordered") - F.col("qty_received"))
    totals = (
        t.po_lines.withColumn("open_qty", open_qty)
        .filter(F.col("open_qty") > 0)
        .groupBy("sku_id")
        .agg(
            sum_long("qty_ordered").alias("qty_ordered"),
            sum_long("qty_received").alias("qty_received"),
            sum_long("open_qty").alias("qty_open"),
            sum_money(F.col("open_qty") * F.col("unit_cost")).alias("open_value"),
            F.count_distinct("po_id").alias("open_po_count"),
            F.min("created_at").alias("oldest_open_created_at"),
        )
        .orderBy(F.desc("qty_open"), F.desc("open_value"), "sku_id")
        .limit(clamp(limit, 30))
    )
    return (
        with_dims(totals, t, NO_FILTERS, "", ["sku_name", "category", "brand"])
        .select(
            "sku_id", or_key("sku_name", "sku_id").alias("sku_name"), "category", "brand",
            "qty_ordered", "qty_received", "qty_open", "open_value", "open_po_count",
            "oldest_open_created_at",
        )
        .orderBy(F.desc("qty_open"), F.desc("open_value"), "sku_id")
    )


def dashboard_summary(t: Tables) -> dict[str, DataFrame]:
    return {
        "summary": inventory_overview(t),
        "warehouse_summary": warehouse_summary(t, 5),
        "low_stock_alerts": low_stock_alerts(t, 5),
        "overstock_alerts": overstock_alerts(t, 5),
        "replenishment": purchase_replenishment(t, 5),
    }


def health(t: Tables) -> DataFrame:
    """Latest snapshot date and row counts, one row."""
    return one_row(
        t, F.lit(True).alias("ok"), t.newest_day().alias("latest_snapshot_date"),
        t.row_count("snapshot").alias("snapshot_rows"),
        t.row_count("movement").alias("movement_rows"),
    )


def sample_rows(df: DataFrame, limit: int = 5) -> DataFrame:
    """Any first rows of a table, at most twenty."""
    return df.limit(clamp(limit, MAX_SAMPLE_ROWS))


def check_readonly(sql: str) -> str:
    """The one statement to run, or ValueError when it is not a single read-only statement."""
    text = (sql or "").strip()
    statement = text.rstrip(";").strip()
    if not statement:
        raise ValueError("a statement is required")
    if ";" in text.rstrip(";"):
        raise ValueError("only one statement is allowed")
    if re.search(rf"\b({'|'.join(WRITE_WORDS)})\b", text, re.IGNORECASE):
        raise ValueError("only read-only statements are allowed")
    if not statement.lower().startswith(READ_STARTS):
        raise ValueError(f"a statement starts with one of {', '.join(READ_STARTS)}")
    return statement


def _below(plan) -> Iterator:
    """A logical plan's nodes, those of subqueries and common table expressions included."""
    yield plan
    for nodes in (plan.children(), plan.innerChildren()):
        for i in range(nodes.size()):
            yield from _below(nodes.apply(i))


def _words(names) -> list[str]:
    return [names.apply(i) for i in range(names.size())]


def check_relations(spark: SparkSession, statement: str, views: Iterable[str]) -> None:
    """ValueError unless a statement reads the given views alone.

    The statement is parsed, not run, and every relation that its plan names is compared: other
    tables, files by path and table functions (but ``range``, which reads nothing) are refused, and
    so are functions that call into the process.
    """
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    named: set[str] = set()
    used: list[list[str]] = []
    for node in _below(plan):
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedWith":
            ctes = node.cteRelations()
            named |= {ctes.apply(i)._1().lower() for i in range(ctes.size())}
        elif kind in ("UnresolvedRelation", "UnresolvedTableOrView", "UnresolvedTable", "UnresolvedView"):
            used.append(_words(node.multipartIdentifier()))
        elif kind == "UnresolvedTableValuedFunction":
            if [w.lower() for w in _words(node.name())] != ["range"]:
                raise ValueError("table functions are not allowed")
    # A name of a common table expression also resolves outside of it, so it must not be a table's.
    if hidden := [n for n in named if spark.catalog.tableExists(n)]:
        raise ValueError(f"name in use: {', '.join(sorted(hidden))}")
    allowed = {v.lower() for v in views} | named
    for parts in used:
        if len(parts) != 1 or parts[0].lower() not in allowed:
            raise ValueError(f"not a view of this layer: {'.'.join(parts)}")
    if re.search(r"\b(try_)?(reflect|java_method)\b", statement, re.IGNORECASE):
        raise ValueError("only read-only statements are allowed")


def readonly_sql(
    spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Run one read-only statement over the layer views; at most 200 rows come back.

    The views exist while the statement is analysed and leave no trace in the session.
    """
    statement = check_readonly(sql)
    views = views or {}
    check_relations(spark, statement, views)
    held = {n: spark.table(n) for n in views if any(t.isTemporary and t.name == n.lower() for t in spark.catalog.listTables())}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return spark.sql(statement).limit(MAX_SQL_ROWS)
    finally:
        for name in views:
            if name in held:
                held[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)
