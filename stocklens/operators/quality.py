"""Counts, reconciliation, readiness, constraint checks and alert states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions import count_where

# KPI, threshold, state below it, state from it on.
ALERT_RULES: list[tuple[str, float, str, str]] = [
    ("low_stock_count", 1.0, "ok", "alert"),
    ("overstock_count", 1.0, "ok", "alert"),
    ("below_reorder_count", 1.0, "ok", "alert"),
    ("negative_available_count", 1.0, "ok", "alert"),
    ("damaged_total", 1.0, "ok", "alert"),
    ("in_transit_total", 1.0, "ok", "alert"),
    ("avg_lead_time", 7.0, "ok", "alert"),
    ("suggested_reorder_qty", 1.0, "ok", "alert"),
    ("supplier_sla", 0.95, "alert", "ok"),
    ("count_accuracy", 80.0, "alert", "ok"),
    ("avg_abs_variance", 1.0, "ok", "alert"),
    ("dead_stock_value", 1.0, "ok", "alert"),
    ("slow_moving_value", 1.0, "ok", "alert"),
    ("negative_stock_rows", 1.0, "ok", "alert"),
    ("snapshot_lag_hours", 24.0, "ok", "alert"),
]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union in halves: a chain would be analysed again with every frame that is added."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return union_all(frames[:half]).unionAll(union_all(frames[half:]))


def source_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, by name. Each table is counted before the union."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
        for name, df in tables.items()
    ]
    return union_all(counted).orderBy("tbl")


def population(tables: dict[str, DataFrame]) -> DataFrame:
    return source_counts(tables).withColumn("populated", F.col("cnt") > 0)


def assert_populated(tables: dict[str, DataFrame]) -> DataFrame:
    """Counts of all tables; raises when one of them is empty."""
    counts = population(tables)
    found = counts.collect()  # one row for each table
    empty = [r.tbl for r in found if not r.populated]
    if empty:
        raise ValueError(f"empty tables: {', '.join(empty)}")
    return counts.sparkSession.createDataFrame(found, counts.schema)


def reconcile_counts(
    source: dict[str, DataFrame], raw: dict[str, DataFrame], mart: dict[str, DataFrame]
) -> DataFrame:
    """Row counts of the same table in three layers; the difference is source less mart."""
    sides = []
    for layer, tables in (("source_rows", source), ("raw_rows", raw), ("mart_rows", mart)):
        sides.append(source_counts(tables).select("tbl", F.lit(layer).alias("layer"), "cnt"))
    layers = {
        name: F.max(F.when(F.col("layer") == name, F.col("cnt")))
        for name in ("source_rows", "raw_rows", "mart_rows")
    }
    return (
        union_all(sides)
        .groupBy(F.col("tbl").alias("table"))
        .agg(*[c.alias(name) for name, c in layers.items()])
        .withColumn("difference", F.col("source_rows") - F.col("mart_rows"))
        .orderBy("table")
    )


def kpi_rows(kpis: dict[str, DataFrame]) -> DataFrame:
    """One row per KPI from one-row, one-column panels."""
    return union_all(
        [
            df.select(F.lit(name).alias("kpi"), F.col(df.columns[0]).cast("double").alias("value"))
            for name, df in kpis.items()
        ]
    )


def rules_table(spark: SparkSession, rules: Sequence[tuple] = ALERT_RULES) -> DataFrame:
    return spark.createDataFrame(
        list(rules), "kpi string, threshold double, below string, from_here string"
    )


def alerts(kpis: DataFrame, rules: DataFrame) -> DataFrame:
    """State of every KPI that has a rule; ``no data`` when its value is NULL."""
    state = (
        F.when(F.col("value").isNull(), "no data")
        .when(F.col("value") >= F.col("threshold"), F.col("from_here"))
        .otherwise(F.col("below"))
    )
    return (
        kpis.join(rules, "kpi")
        .select("kpi", "value", "threshold", state.alias("state"))
        .orderBy("kpi")
    )


def table_violations(
    df: DataFrame, table: str, rules: dict[str, Column], parents: Sequence[tuple[str, DataFrame, str, str]]
) -> DataFrame:
    """Rows of a table that break each rule, and rows whose key has no parent, in one scan.

    Rows are summed by their foreign keys on the map side; only these sums meet the parents (key, parent,
    parent's key, rule), each once.
    """
    keys = [key for key, *_ in parents]
    broken = [F.when(~F.coalesce(c, F.lit(False)), 1).otherwise(0).alias(f"r{i}") for i, c in enumerate(rules.values())]
    sums = df.select(*keys, *broken).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"r{i}").alias(f"r{i}") for i in range(len(rules))]
    )
    for i, (key, parent, parent_key, _) in enumerate(parents):
        known = parent.select(F.col(parent_key).alias(key)).distinct().withColumn(f"p{i}", F.lit(True))
        sums = sums.join(known, key, "left")
    columns = [F.col(f"r{i}") for i in range(len(rules))]
    columns += [F.when(F.col(f"p{i}").isNull(), F.col("n")) for i in range(len(parents))]
    names = [*rules, *[rule for *_, rule in parents]]
    totals = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"v{i}") for i, c in enumerate(columns)])
    found = [F.struct(F.lit(n).alias("rule"), F.col(f"v{i}").alias("violations")) for i, n in enumerate(names)]
    rows = totals.select(F.explode(F.array(*found)).alias("p"))
    return rows.select(F.lit(table).alias("table"), "p.rule", "p.violations")


def row_violations(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule; all rules of a table in one pass."""
    return table_violations(df, table, rules, [])


def missing_parents(
    df: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str, rule: str
) -> DataFrame:
    """Rows whose key has no parent."""
    return table_violations(df, table, {}, [(key, parent, parent_key, rule)])


def repeated_keys(df: DataFrame, table: str, keys: Sequence[str], rule: str) -> DataFrame:
    """Keys that occur more than once."""
    again = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return again.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(rule).alias("rule"), "violations"
    )


def constraint_violations(landed: dict[str, DataFrame]) -> DataFrame:
    """The constraints of the operational tables, tested on landed rows with conformed keys.

    ``landed`` maps table names to frames: inventory_transactions, inventory_snapshot_daily,
    purchase_order_lines, sales_order_lines, sales_orders, purchase_orders, suppliers,
    inventory_transfers, inventory_transfer_lines, skus, warehouses, customers, stock_counts,
    daily_movements, calendar.
    """
    c = F.col
    t = landed
    row_rules: dict[str, dict[str, Column]] = {
        "inventory_transactions": {
            "quantity is not zero": c("qty_change") != 0,
            "type is known": c("event_type").isin("RECEIPT", "SHIPMENT", "RETURN", "ADJUSTMENT"),
        },
        "inventory_snapshot_daily": {
            "quantities are not negative": F.least(
                "on_hand_qty", "reserved_qty", "damaged_qty", "in_transit_qty", "available_qty"
            ) >= 0,
        },
        "purchase_order_lines": {
            "ordered quantity is positive": c("qty_ordered") > 0,
            "received is between zero and ordered": c("qty_received").between(0, c("qty_ordered")),
            "line status is known": c("line_status").isin("OPEN", "PARTIAL", "CLOSED", "CANCELLED"),
        },
        "sales_order_lines": {"quantity is positive": c("qty") > 0},
        "sales_orders": {"status is known": c("status").isin("OPEN", "SHIPPED", "CANCELLED")},
        "suppliers": {
            "lead time is not negative": c("lead_time_days") >= 0,
            "rating is between 0 and 5": c("rating").between(0, 5),
        },
        "inventory_transfers": {
            "warehouses differ": c("from_warehouse_id") != c("to_warehouse_id"),
            "status is known": c("status").isin(
                "REQUESTED", "PICKING", "IN_TRANSIT", "RECEIVED", "CANCELLED"
            ),
        },
        "purchase_orders": {
            "status is known": c("status").isin(
                "DRAFT", "OPEN", "PARTIAL", "RECEIVED", "CLOSED", "CANCELLED"
            ),
        },
        "inventory_transfer_lines": {"quantity is positive": c("qty") > 0},
    }
    parents = [
        ("inventory_transactions", "warehouse_id", "warehouses", "warehouse_id", "warehouse exists"),
        ("inventory_transactions", "sku_id", "skus", "sku_id", "sku exists"),
        ("inventory_snapshot_daily", "sku_id", "skus", "sku_id", "sku exists"),
        ("inventory_snapshot_daily", "warehouse_id", "warehouses", "warehouse_id",
         "warehouse exists"),
        ("stock_counts", "sku_id", "skus", "sku_id", "sku exists"),
        ("stock_counts", "warehouse_id", "warehouses", "warehouse_id", "warehouse exists"),
        ("daily_movements", "sku_id", "skus", "sku_id", "sku exists"),
        ("daily_movements", "warehouse_id", "warehouses", "warehouse_id", "warehouse exists"),
        ("purchase_order_lines", "po_id", "purchase_orders", "po_id", "order exists"),
        ("purchase_order_lines", "sku_id", "skus", "sku_id", "sku exists"),
        ("sales_order_lines", "order_id", "sales_orders", "order_id", "order exists"),
        ("sales_order_lines", "sku_id", "skus", "sku_id", "sku exists"),
        ("sales_orders", "customer_id", "customers", "customer_id", "customer exists"),
        ("sales_orders", "warehouse_id", "warehouses", "warehouse_id", "warehouse exists"),
        ("purchase_orders", "supplier_id", "suppliers", "supplier_id", "supplier exists"),
        ("purchase_orders", "warehouse_id", "warehouses", "warehouse_id", "warehouse exists"),
        ("inventory_transfers", "from_warehouse_id", "warehouses", "warehouse_id",
         "source warehouse exists"),
        ("inventory_transfers", "to_warehouse_id", "warehouses", "warehouse_id",
         "target warehouse exists"),
        ("inventory_transfer_lines", "transfer_id", "inventory_transfers", "transfer_id",
         "transfer exists"),
        ("inventory_transfer_lines", "sku_id", "skus", "sku_id", "sku exists"),
    ]
    unique = [
        ("sales_order_lines", ["order_id", "line_no"], "order and line are unique"),
        ("purchase_order_lines", ["po_id", "line_no"], "order and line are unique"),
        ("inventory_snapshot_daily", ["snapshot_date", "warehouse_id", "sku_id"], "key is unique"),
        ("sales_orders", ["order_number"], "number is unique"),
        ("purchase_orders", ["po_number"], "number is unique"),
        ("inventory_transfers", ["transfer_ref"], "reference is unique"),
        ("skus", ["sku_id"], "key is unique"),
        ("suppliers", ["supplier_id"], "key is unique"),
        ("daily_movements", ["movement_date", "warehouse_id", "sku_id"], "key is unique"),
        ("calendar", ["full_date"], "day is unique"),
    ]
    tables = dict.fromkeys([*row_rules, *[child for child, *_ in parents]])
    checks = [
        table_violations(
            t[name], name, row_rules.get(name, {}),
            [(key, t[parent], own, rule) for child, key, parent, own, rule in parents if child == name],
        )
        for name in tables
    ]
    checks += [repeated_keys(t[name], name, keys, rule) for name, keys, rule in unique]
    return union_all(checks).orderBy("table", "rule")
