from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stocklens.operators import derive
from tests.small import TODAY, days_ago, rows

TX = "warehouse_id string, sku_id string, event_type string, qty_change int, event_time timestamp"


def frame(spark, moves):
    data = [(w, s, "RECEIPT", q, datetime.combine(d, datetime.min.time())) for d, w, s, q in moves]
    return spark.createDataFrame(data, TX)


def costs(spark, *skus):
    return spark.createDataFrame([(s, Decimal("2.50")) for s in skus], "sku_id string, unit_cost decimal(18,2)")


def brute(moves, skus, days, opening):
    first = TODAY - timedelta(days=days)
    seen = {(w, s) for d, w, s, _ in moves if d <= TODAY and (opening == "history" or d >= first)}
    total = defaultdict(int)
    for d, w, s, q in moves:
        total[w, s, d] += q
    out = {}
    for w, s in seen:
        if s not in skus:
            continue
        balance = 0
        if opening == "history":
            balance = sum(q for d, a, b, q in moves if (a, b) == (w, s) and d < first)
        for n in range(days + 1):
            day = first + timedelta(days=n)
            balance += total.get((w, s, day), 0)
            out[day, w, s] = max(balance, 0)
    return out


move = st.tuples(
    st.integers(-2, 12).map(days_ago), st.sampled_from(["W1", "W2"]),
    st.sampled_from(["A", "B", "X"]), st.integers(-9, 9),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(move, min_size=1, max_size=15), st.sampled_from(["zero", "history"]))
def test_snapshot_equals_a_day_by_day_walk(spark, moves, opening):
    built = derive.build_snapshot(
        frame(spark, moves), costs(spark, "A", "B"), TODAY, 7, opening=opening
    )
    found = built.collect()
    got = {(r.snapshot_date, r.warehouse_id, r.sku_id): r.on_hand_qty for r in found}
    assert len(got) == len(found)
    assert got == brute(moves, {"A", "B"}, 7, opening)


def test_carried_balances_equal_the_history(spark):
    moves = [(days_ago(n), w, s, q) for n, w, s, q in (
        (40, "W1", "A", 9), (30, "W1", "A", -12), (12, "W2", "B", 4), (8, "W1", "A", 1),
        (7, "W1", "A", 5), (2, "W2", "A", 3))]
    tx, skus = frame(spark, moves), costs(spark, "A", "B")
    month_ago = derive.closing_balances(tx, days_ago(30))
    since_then = tx.filter(F.to_date("event_time") > F.lit(days_ago(30)))
    before = derive.closing_balances(since_then, days_ago(8), month_ago)
    assert {(r.warehouse_id, r.sku_id): r.balance for r in before.collect()} == {
        ("W1", "A"): -2, ("W2", "B"): 4}
    recent = tx.filter(F.to_date("event_time") >= F.lit(days_ago(7)))
    whole = derive.build_snapshot(tx, skus, TODAY, 7, opening="history")
    carried = derive.build_snapshot(recent, skus, TODAY, 7, opening=before)
    assert sorted(carried.collect()) == sorted(whole.collect()) and whole.count() == 24


def test_short_windows_become_the_default(spark):
    tx = frame(spark, [(days_ago(1), "W1", "A", 5)])
    assert derive.build_snapshot(tx, costs(spark, "A"), TODAY, 3).count() == 121
    assert derive.build_snapshot(tx, costs(spark, "A"), TODAY, None).count() == 121


def test_shelf_rule_and_value(spark):
    tx = frame(spark, [(days_ago(7), "W1", "A", 4), (days_ago(2), "W1", "A", -9)])
    rule = {"reserved_qty": F.lit(3), "damaged_qty": F.lit(2), "in_transit_qty": F.lit(6)}
    out = {r["snapshot_date"]: r for r in rows(
        derive.build_snapshot(tx, costs(spark, "A"), TODAY, 7, rule))}
    stocked, empty = out[days_ago(5)], out[days_ago(1)]
    assert (stocked["on_hand_qty"], stocked["reserved_qty"], stocked["damaged_qty"]) == (4, 3, 2)
    assert stocked["available_qty"] == 0 and stocked["inventory_value"] == Decimal("10.00")
    assert (empty["on_hand_qty"], empty["reserved_qty"], empty["damaged_qty"]) == (0, 0, 0)
    assert empty["in_transit_qty"] == 6


def test_daily_movements_by_true_type(spark):
    at = datetime(2001, 7, 1, 9)
    data = [("W", "S", k, q, at) for k, q in (
        ("RECEIPT", 5), ("RECEIPT", -2), ("SHIPMENT", -4), ("RETURN", 3), ("RETURN", -1),
        ("ADJUSTMENT", -6))]
    out = rows(derive.daily_movements(spark.createDataFrame(data, TX)))[0]
    assert out["movement_date"] == date(2001, 7, 1)
    assert (out["gross_receipt_qty"], out["shipment_qty"], out["return_qty"]) == (5, 4, 3)
    assert (out["adjustment_net_qty"], out["net_qty_change"], out["transaction_rows"]) == (-6, -5, 6)


def test_order_without_lines_has_no_total(spark):
    po = spark.createDataFrame([(1,), (2,)], "po_id long")
    lines = spark.createDataFrame(
        [(1, 2, Decimal("1.25")), (1, 3, Decimal("2.00"))],
        "po_id long, qty_ordered int, unit_cost decimal(18,2)",
    )
    got = {r.po_id: r.total_amount for r in derive.po_totals(po, lines).collect()}
    assert got == {1: Decimal("8.50"), 2: None}
