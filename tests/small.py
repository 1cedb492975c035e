"""A small hand-made mart for edge cases."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import SparkSession

from stocklens.operators.mart import Tables
from stocklens.operators.staging import dim_date
from stocklens.schemas import MART

TODAY = date(2001, 8, 1)
LANDED = datetime(2001, 8, 1, 6)
T0 = datetime(2001, 1, 1)


def days_ago(n: int) -> date:
    return TODAY - timedelta(days=n)


def make(
    spark: SparkSession,
    stock: list[tuple] = (),
    moves: list[tuple] = (),
    products: list[tuple] = (),
    sites: list[tuple] = (("WH01", "North"), ("WH02", "South")),
    sales: list[tuple] = (),
    purchases: list[tuple] = (),
    counts: list[tuple] = (),
    suppliers: list[tuple] = (),
) -> Tables:
    """Tables from short rows.

    stock: date, warehouse, sku, available, value; moves: date, warehouse, sku, quantity;
    products: sku, category, brand, reorder point, max stock; sites: warehouse, region;
    sales: date, sku, quantity; purchases: date, sku, ordered, received;
    counts: date, warehouse, sku, variance; suppliers: id, lead time.
    """

    def df(table, rows):
        return spark.createDataFrame(rows, MART[table])

    midnight = datetime.min.time()
    return Tables(
        movement=df("fact_inventory_movement", [
            (d, datetime.combine(d, midnight), w, s,
             "inbound" if q > 0 else "outbound", q, max(q, 0), max(-q, 0), LANDED)
            for d, w, s, q in moves]),
        snapshot=df("fact_inventory_snapshot_daily", [
            (d, w, s, max(a, 0), 0, 0, 0, a, Decimal(v), Decimal("1.00"), LANDED, LANDED)
            for d, w, s, a, v in stock]),
        po_lines=df("fact_purchase_order_lines", [
            (d, i, i, 1, s, o, r, max(o - r, 0), Decimal("2.00"), "OPEN", T0, LANDED)
            for i, (d, s, o, r) in enumerate(purchases)]),
        sales_lines=df("fact_sales_order_lines", [
            (d, i, i, 1, s, q, Decimal("3.00"), Decimal(3 * q), T0, LANDED)
            for i, (d, s, q) in enumerate(sales)]),
        stock_counts=df("fact_stock_counts", [
            (d, w, s, 10, 10 + v, v, T0, LANDED) for d, w, s, v in counts]),
        product=df("dim_product", [
            (s, f"name {s}", c, "sub", b, "EA", Decimal("5.00"), Decimal("6.00"), "ACTIVE",
             r, 1, m, 0, "A", T0) for s, c, b, r, m in products]),
        warehouse=df("dim_warehouse", [(w, f"Site {w}", "City", r, T0) for w, r in sites]),
        supplier=df("dim_supplier", [
            (s, f"Supplier {s}", "X", n, Decimal("4.00"), 30, T0) for s, n in suppliers]),
        customer=df("dim_customer", []),
        date=dim_date(spark, TODAY),
    )


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def value(df):
    found = df.collect()
    assert len(found) == 1
    return found[0][0]
