"""Receipt ratio, overdue orders, stock cover and aging by dimension on edge rows."""

from __future__ import annotations

from datetime import date, timedelta

from stocklens.operators import planning
from tests.small import rows

AS_OF = date(2001, 6, 30)
ORDERS = "po_id long, supplier_id string, status string, expected_delivery_date date"
LINES = "po_id long, qty_ordered int, qty_received int, qty_open int"


def tables(spark):
    early, today = AS_OF - timedelta(days=12), AS_OF
    orders = [(1, "S1", "OPEN", early), (2, "S1", "partial", AS_OF - timedelta(days=1)), (3, "S1", "CLOSED", early),
              (4, "S2", "OPEN", today), (5, "S2", "OPEN", None), (6, None, "OPEN", early), (8, "S3", "OPEN", early)]
    lines = [(1, 10, 4, 6), (1, 5, 5, 0), (2, 3, 9, 0), (3, 8, 0, 8), (4, 0, 0, 0), (6, 2, 1, 1), (7, 4, 4, 0)]
    return spark.createDataFrame(orders, ORDERS), spark.createDataFrame(lines, LINES)


def test_receipt_ratio(spark):
    got = {r["supplier_id"]: r for r in rows(planning.receipt_ratio(*tables(spark)))}
    assert set(got) == {"S1", "S2", "Unknown"}
    s1, s2, other = got["S1"], got["S2"], got["Unknown"]
    assert (s1["line_count"], s1["qty_ordered"], s1["qty_received"], s1["variance_qty"], s1["receipt_pct"]) == (4, 26, 18, 8, 69.23)
    assert (s2["qty_ordered"], s2["receipt_pct"]) == (0, None)
    assert (other["line_count"], other["qty_ordered"], other["qty_received"]) == (2, 6, 5)


def test_overdue_orders(spark):
    got = {r["supplier_id"]: r for r in rows(planning.overdue_orders(*tables(spark), AS_OF))}
    assert set(got) == {"S1", "S3", "Unknown"}  # due today or without a date is not late
    s1 = got["S1"]
    assert (s1["overdue_orders"], s1["open_lines"], s1["open_qty"], s1["max_days_overdue"]) == (2, 1, 6, 12)
    assert (got["S3"]["overdue_orders"], got["S3"]["open_lines"], got["S3"]["open_qty"]) == (1, 0, 0)
    assert got["Unknown"]["oldest_expected_date"] == AS_OF - timedelta(days=12)


def test_no_orders(spark):
    orders, lines = (t.limit(0) for t in tables(spark))
    assert rows(planning.receipt_ratio(orders, lines)) == []
    assert rows(planning.overdue_orders(orders, lines, AS_OF)) == []
