from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stocklens.operators import planning, reports
from stocklens.operators.access import ACCESS, restricted
from stocklens.operators.dashboards import executive
from stocklens.operators.derive import build_snapshot
from tests.small import TODAY, days_ago, make, rows, value

MOVE = "event_time timestamp, warehouse_id string, sku_id string, qty_change int"


def at(n):
    return datetime.combine(days_ago(n), datetime.min.time()) + timedelta(hours=5)


def test_time_weighted_average_equals_the_daily_one(spark):
    moves = [(at(200), "W1", "S1", 50), (at(12), "W1", "S1", -60), (at(9), "W1", "S1", 25), (at(9), "W1", "S1", 1),
             (at(4), "W2", "S1", 3), (at(0), "W2", "S2", 8), (at(30), "W3", "S2", 2)]
    tx = spark.createDataFrame(moves, MOVE)
    costs = spark.createDataFrame([("S1", Decimal("2.50")), ("S2", Decimal("3.00"))], "sku_id string, unit_cost decimal(18,2)")
    sales = spark.createDataFrame([(days_ago(3), "S1", 4), (days_ago(99), "S1", 4), (days_ago(0), "S2", 1)], "created_date date, sku_id string, qty int")
    product = spark.createDataFrame([("S1", "A")], "sku_id string, category string")
    got = {r["category"]: r for r in rows(planning.turnover(tx, sales, costs, product, TODAY, 20))}
    daily = build_snapshot(tx, costs, TODAY, 20, None, opening="history").groupBy("sku_id").agg(F.sum("inventory_value").alias("v"))
    by_sku = {r["sku_id"]: r["v"] for r in rows(daily)}
    assert got["A"]["avg_inventory_value"] == pytest.approx(float(by_sku["S1"]) / 21, abs=0.005)
    assert got["Unknown"]["avg_inventory_value"] == pytest.approx(float(by_sku["S2"]) / 21, abs=0.005)
    assert got["A"]["cogs"] == Decimal("10.00") and got["Unknown"]["cogs"] == Decimal("3.00")
    assert got["A"]["turnover"] == pytest.approx(10 * 21 / float(by_sku["S1"]), abs=0.00005)
    assert got["A"]["days_of_inventory"] == pytest.approx(float(by_sku["S1"]) / 10, abs=0.005)


def test_transfer_quantiles(spark):
    days = [(i * 37) % 101 for i in range(1000)]
    data = [("W1", "W2", datetime(2001, 1 + i % 9, 3), datetime(2001, 1 + i % 9, 3) + timedelta(days=d)) for i, d in enumerate(days)]
    data += [("W1", "W2", datetime(2001, 5, 1), None), ("W2", "W1", datetime(2001, 5, 1), None)]
    frame = spark.createDataFrame(data, "from_warehouse_id string, to_warehouse_id string, requested_at timestamp, completed_at timestamp")
    got = {r["from_warehouse_id"]: r for r in rows(planning.transfer_turnaround(frame))}
    order = sorted(days)
    assert (got["W1"]["completed"], got["W1"]["open"]) == (1000, 1)
    assert (got["W1"]["p50_days"], got["W1"]["p90_days"]) == (order[499], order[899])
    assert got["W1"]["p50_off"] <= 0.02 and abs(got["W1"]["p50_sketch"] - order[499]) <= 3
    assert (got["W2"]["completed"], got["W2"]["open"], got["W2"]["p50_days"], got["W2"]["p50_sketch"]) == (0, 1, None, None)


def test_months_without_a_snapshot_stay(spark):
    data = [(date(2001, 3, 5), Decimal("10")), (date(2001, 3, 30), Decimal("40")), (date(2001, 3, 30), Decimal("10")),
            (date(2001, 5, 2), Decimal("70")), (date(2001, 6, 1), Decimal("35"))]
    snapshot = spark.createDataFrame(data, "snapshot_date date, inventory_value decimal(18,2)")
    got = sorted(rows(planning.month_over_month(snapshot)), key=lambda r: r["month"])
    assert [(r["month"].month, r["inventory_value"], r["change"], r["change_pct"]) for r in got] == [
        (3, Decimal("50.00"), None, None), (4, None, None, None), (5, Decimal("70.00"), None, None),
        (6, Decimal("35.00"), Decimal("-35.00"), -50.0),
    ]
    assert rows(planning.month_over_month(snapshot.limit(0))) == []


def test_snapshot_issues(spark):
    days = {"S1": [0, 1, 2, 5, 9], "S2": [3, 3, 4, 5, 6, 7, 8, 9], "S3": list(range(10))}
    data = [(date(2001, 1, 1 + d), "W9" if s == "S3" else "W1", s) for s, ds in days.items() for d in ds]
    snapshot = spark.createDataFrame(data, "snapshot_date date, warehouse_id string, sku_id string")
    sites = spark.createDataFrame([("W1",)], "warehouse_id string")
    goods = spark.createDataFrame([("S1", "A"), ("S2", ""), ("S3", "B")], "sku_id string, category string")
    found = planning.snapshot_issues(snapshot, sites, goods, date(2001, 1, 1), date(2001, 1, 12))
    assert sorted((r["sku_id"], r["issue"], r["first_day"].day, r["last_day"].day, r["row_count"]) for r in rows(found)) == [
        ("S1", "gap", 4, 5, 2), ("S1", "gap", 7, 9, 3), ("S1", "gap", 11, 12, 2),
        ("S2", "duplicate", 4, 4, 1), ("S2", "gap", 1, 3, 3), ("S2", "gap", 11, 12, 2), ("S2", "no category", 4, 10, 8),
        ("S3", "gap", 11, 12, 2), ("S3", "no warehouse", 1, 10, 10),
    ]


def small_mart(spark):
    return make(
        spark, stock=[(TODAY, "WH01", "S1", 5, 10), (TODAY, "WH02", "S1", 7, 10)], moves=[(TODAY, "WH02", "S1", 7)],
        products=[("S1", "A", "B", 1, 9)], sales=[(TODAY, "S1", 1), (TODAY, "S1", 2)], purchases=[(TODAY, "S1", 3, 1)],
    )


def test_restriction(spark):
    t = small_mart(spark)
    rights = [("a", "region", "North"), ("b", "warehouse", "WH02"), ("b", "warehouse", "WH02"), ("c", "all", None), ("d", "region", None), (None, "all", "")]
    access = spark.createDataFrame(rights, ACCESS)
    orders = spark.createDataFrame([(0, "WH01"), (1, "WH02"), (2, None)], "order_id long, warehouse_id string")
    seen = {u: restricted(t, access, u, orders) for u in ("a", "b", "c", "d", "x")}
    assert {u: value(executive.on_hand_total(s)) for u, s in seen.items()} == {"a": 5, "b": 7, "c": 12, "d": 0, "x": 0}
    assert {u: s.movement.count() for u, s in seen.items()} == {"a": 0, "b": 1, "c": 1, "d": 0, "x": 0}
    assert [r.qty for r in seen["a"].sales_lines.collect()] == [1] and seen["x"].sales_lines.count() == 0
    assert seen["c"].po_lines.count() == 0  # purchase orders were not given
    sql = "SELECT count(*) AS n FROM fact JOIN dim USING (warehouse_id)"
    assert value(reports.readonly_sql(spark, sql, {"fact": seen["b"].snapshot, "dim": seen["b"].warehouse})) == 1


@pytest.mark.parametrize("sql", [
    "SELECT * FROM parquet.`/root/testdata/sf0.001/region.parquet`",
    "SELECT * FROM other_view",
    "SELECT (SELECT count(*) FROM other_view) FROM dim",
    "WITH x AS (SELECT * FROM other_view) SELECT * FROM x",
    "SELECT * FROM dim WHERE sku_id IN (SELECT sku_id FROM default.other_view)",
    "SELECT * FROM (WITH other_view AS (SELECT 1) SELECT * FROM other_view) a, other_view b",
    "SELECT * FROM dim, LATERAL (SELECT * FROM other_view)",
    "SELECT * FROM explode(array(1))",
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM dim",
    "DESCRIBE other_view",
])
def test_statements_beyond_the_given_views_are_refused(spark, sql):
    spark.range(3).createOrReplaceTempView("other_view")
    try:
        with pytest.raises(ValueError):
            reports.readonly_sql(spark, sql, {"dim": small_mart(spark).product})
    finally:
        spark.catalog.dropTempView("other_view")


def test_views_leave_no_trace(spark):
    t = small_mart(spark)
    spark.range(3).createOrReplaceTempView("dim")
    out = reports.readonly_sql(spark, "WITH d AS (SELECT sku_id FROM DIM) SELECT count(*) FROM d, range(2)", {"dim": t.product, "Site": t.warehouse})
    assert value(out) == 2
    assert spark.table("dim").count() == 3 and not spark.catalog.tableExists("site")
    spark.catalog.dropTempView("dim")
    with pytest.raises(Exception, match="nothing"):
        reports.readonly_sql(spark, "SELECT nothing FROM dim", {"dim": t.product})
    assert not spark.catalog.tableExists("dim")
