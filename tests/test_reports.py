from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from stocklens.operators import quality, reports
from stocklens.operators.dashboards import aging, executive, movement, reliability, replenishment
from stocklens.operators.dashboards import stock
from stocklens.operators.filters import NO_FILTERS, Filters, filter_options
from tests.small import TODAY, days_ago, make, rows, value

PRODUCTS = [
    ("A", "food", "X", 10, 100), ("B", "food", "", 10, 100), ("C", "", "Y", 0, 0),
    ("D", "toys", "Y", 10, 100), ("E", "toys", "Y", 10, 100), ("G", "toys", "Y", 10, 100),
]
STOCK = [
    (days_ago(1), "WH01", "A", 500, 500),
    (TODAY, "WH01", "A", 10, 10),  # equal to the reorder point
    (TODAY, "WH01", "B", 100, 100),  # equal to the maximum
    (TODAY, "WH01", "C", 7, 7),  # no policy
    (TODAY, "WH01", "D", 0, 0),
    (TODAY, "WH01", "E", -1, 0),
    (TODAY, "WH01", "Z", 5, 50),  # no product
    (TODAY, "WH09", "A", 9, 90),  # no warehouse
    (TODAY, "WH09", "G", 101, 101),
]


@pytest.fixture(scope="module")
def t(spark):
    return make(
        spark, STOCK, products=PRODUCTS,
        moves=[(days_ago(n), "WH01", s, 1) for n, s in
               ((30, "A"), (31, "B"), (60, "C"), (91, "Z"))] + [(days_ago(1), "WH01", "D", -4)],
        sales=[(days_ago(30), "D", 15), (days_ago(31), "E", 99), (TODAY, "A", 31)],
        purchases=[(TODAY, "A", 10, 4), (TODAY, "A", 3, 3), (days_ago(46), "Z", 5, 9),
                   (days_ago(45), "Z", 5, 0)],
        counts=[(days_ago(60), "WH01", "A", 0), (days_ago(61), "WH01", "A", 5),
                (TODAY, "WH01", "B", -1), (TODAY, "WH09", "B", 3)],
        suppliers=[("S1", 7), ("S2", 8), ("S3", 2)],
    )


@pytest.fixture(scope="module")
def empty(spark):
    return make(spark, sites=())


def statuses(df):
    return {(r["warehouse_id"], r["sku_id"]): r["stock_status"] for r in rows(df)}


def test_status_precedence_and_thresholds(t):
    got = statuses(stock.stock_status(t))
    assert got == {
        ("WH01", "A"): "Healthy", ("WH01", "B"): "Healthy", ("WH01", "C"): "Healthy",
        ("WH01", "D"): "Stockout", ("WH01", "E"): "Stockout", ("WH01", "Z"): "Healthy",
        ("WH09", "A"): "Low stock", ("WH09", "G"): "Overstock",
    }
    counted = {r["stock_status"]: r["sku_count"] for r in rows(stock.status_distribution(t))}
    assert sum(counted.values()) == len(got)


def test_unmatched_dimensions(t):
    by_key = {(r["warehouse_id"], r["sku_id"]): r for r in rows(stock.stock_status(t))}
    assert by_key["WH01", "Z"]["category"] == "Unknown" and by_key["WH01", "Z"]["sku_name"] == "Z"
    assert by_key["WH09", "A"]["warehouse"] == "WH09"
    assert by_key["WH01", "C"]["category"] == ""
    assert rows(reliability.data_quality_summary(t))[0] == {
        "total_rows": 8, "missing_category_rows": 2, "missing_brand_rows": 2,
        "negative_available_rows": 1,
    }
    # A chosen region drops stock of an unknown warehouse.
    assert value(executive.available_total(t, Filters(region=("North",)))) == 121
    assert value(executive.available_total(t)) == 231


def test_kpi_counts_stockouts_but_status_does_not(t):
    assert value(executive.low_stock_count(t)) == 3
    assert value(executive.overstock_count(t)) == 1
    assert value(stock.below_reorder_count(t)) == 3
    assert value(stock.below_reorder_count(t, Filters(stock_status=("Low stock",)))) == 1
    assert value(stock.negative_available_count(t)) == 1
    assert value(reliability.negative_stock_rows(t)) == 1
    assert value(replenishment.suggested_reorder_qty(t)) == 100 + 101 + 91


def test_warehouses_without_stock_stay_listed(t):
    low = {r["warehouse"]: r["low_stock_items"] for r in rows(stock.low_stock_by_warehouse(t))}
    assert low == {"Site WH01": 2, "Site WH02": 0}
    toys = rows(stock.low_stock_by_warehouse(t, Filters(category=("toys",))))
    assert [r["warehouse"] for r in toys] == ["Site WH01"]
    over = rows(stock.low_stock_by_warehouse(t, Filters(stock_status=("Overstock",))))
    assert {r["low_stock_items"] for r in over} == {0}


def test_exception_matrix_order(t):
    out = rows(stock.exception_matrix(t))
    assert [r["sku_id"] for r in out] == ["D", "E", "A", "G"]
    assert [r["sku_id"] for r in rows(stock.exception_matrix(t, limit=2))] == ["D", "E"]


def test_zero_stock_with_demand(t):
    out = rows(stock.zero_stock_with_demand(t, NO_FILTERS, TODAY))
    assert [(r["sku_id"], r["sold_qty_30d"]) for r in out] == [("D", 15)]


def test_alerts_and_limits(t):
    low = rows(reports.low_stock_alerts(t, 30))
    assert [(r["warehouse_id"], r["sku_id"]) for r in low] == [
        ("WH01", "E"), ("WH01", "D"), ("WH09", "A"),
    ]
    assert [r["coverage_ratio"] for r in low] == [-0.1, 0.0, 0.9]
    assert len(rows(reports.low_stock_alerts(t, 0))) == 1
    assert reports.clamp(99, 30) == 30
    over = rows(reports.overstock_alerts(t))[0]
    assert (over["stock_ratio"], over["warehouse_name"]) == (1.01, "WH09")


def test_overview_and_empty_tables(t, empty):
    out = rows(reports.inventory_overview(t))[0]
    assert (out["warehouse_count"], out["sku_count"], out["low_stock_sku_count"]) == (2, 7, 3)
    assert rows(reports.inventory_overview(empty)) == []
    assert value(executive.value_total(empty)) == Decimal("0.00")
    assert value(executive.low_stock_count(empty)) == 0
    assert value(aging.count_accuracy(empty, NO_FILTERS, TODAY)) is None
    assert value(aging.avg_abs_variance(empty, NO_FILTERS, TODAY)) is None
    assert value(replenishment.avg_lead_time(empty)) is None
    assert value(replenishment.supplier_sla(empty)) == 0.0
    assert value(reliability.snapshot_lag_hours(empty, NO_FILTERS, datetime(2001, 8, 2))) is None
    assert value(movement.avg_daily_sold(empty, NO_FILTERS, TODAY)) == 0.0
    assert [r["aging_value"] for r in rows(aging.aging_buckets(empty))] == [Decimal("0.00")] * 4
    assert rows(reports.health(empty))[0]["snapshot_rows"] == 0


def test_aging_boundaries(t):
    days = {(r["warehouse_id"], r["sku_id"]): r["days_since_movement"]
            for r in rows(aging.aging_base(t))}
    assert days == {
        ("WH01", "A"): 30, ("WH01", "B"): 31, ("WH01", "C"): 60, ("WH01", "Z"): 91,
        ("WH09", "A"): 0, ("WH09", "G"): 0,  # never moved
    }
    buckets = [(r["aging_bucket"], r["aging_value"]) for r in rows(aging.aging_buckets(t))]
    assert buckets == [
        ("0-30 days", Decimal(10 + 90 + 101)), ("31-60 days", Decimal(107)),
        ("61-90 days", Decimal(0)), ("90+ days", Decimal(50)),
    ]
    assert sum(v for _, v in buckets) == sum(r["inventory_value"] for r in rows(aging.aging_base(t)))
    assert value(aging.dead_stock_value(t)) == Decimal(50)
    assert value(aging.slow_moving_value(t)) == Decimal(107)
    present = [r["aging_bucket"] for r in rows(aging.aging_buckets_present(t))]
    assert present == ["0-30 days", "31-60 days", "90+ days"]


def test_slow_movers_rank_and_do_not_filter(t):
    out = rows(movement.slow_movers(t))
    assert [(r["sku_id"], r["days_since_last_movement"]) for r in out] == [
        ("Z", 91), ("C", 60), ("B", 31), ("A", 30), ("G", 0), ("A", 0),
    ]
    assert [r["movement_flag"] for r in out[3:5]] == ["No movement >=30d", "Slowest recent movers"]
    assert out[4]["last_event_date"] is None
    top = rows(aging.top_dead_slow(t))
    assert [r["sku_id"] for r in top] == ["Z", "C", "B", "A", "G", "A"]
    assert len(rows(aging.dead_slow_only(t))) == 4
    assert [r["sku_id"] for r in rows(movement.idle_skus(t, TODAY))] == ["G", "B", "Z", "C"]


def test_replenishment_plan(t):
    out = {r["sku_id"]: r for r in rows(replenishment.replenishment_plan(t, NO_FILTERS, TODAY))}
    assert set(out) == {"A", "B", "D", "E", "G"}  # no policy, no plan
    assert (out["A"]["available_qty"], out["A"]["recommended_reorder_qty"]) == (19, 81)
    assert (out["A"]["avg_daily_demand"], out["A"]["days_of_cover"]) == (1.03, 18.45)
    assert out["E"]["days_of_cover"] == 9999.0 and out["E"]["recommendation_priority"] == "Urgent"
    assert out["G"]["recommended_reorder_qty"] == 0
    urgent = rows(replenishment.urgent_replenishment(t, TODAY))
    assert [r["sku_id"] for r in urgent] == ["E", "D"]


def test_purchases_and_suppliers(t):
    assert value(replenishment.open_po_qty(t)) == 11
    assert value(replenishment.open_po_lines(t)) == 2
    assert value(replenishment.open_po_qty(t, Filters(category=("food",)))) == 6
    assert value(replenishment.avg_lead_time(t)) == 5.67
    assert value(replenishment.supplier_sla(t)) == 0.6667
    out = rows(reports.purchase_replenishment(t))
    assert [(r["sku_id"], r["qty_open"], r["open_po_count"]) for r in out] == [("A", 6, 1), ("Z", 5, 1)]
    trend = rows(replenishment.po_trend(t, NO_FILTERS, TODAY))  # the last 45 days
    assert [(r["open_qty"], r["received_qty"]) for r in trend] == [(5, 0), (6, 7)]


def test_counts_window_is_inclusive(t):
    assert value(aging.count_accuracy(t, NO_FILTERS, TODAY)) == 33.33
    assert value(aging.avg_abs_variance(t, NO_FILTERS, TODAY)) == 1.33
    by_site = rows(aging.variance_by_warehouse(t, NO_FILTERS, TODAY))
    assert [(r["warehouse"], r["accuracy_pct"]) for r in by_site] == [("WH09", 0.0), ("Site WH01", 50.0)]


def test_a_filter_over_all_values_is_the_whole(t):
    whole = value(executive.value_total(t))
    parts = [value(executive.value_total(t, Filters(warehouse=(w,)))) for w in ("WH01", "WH09")]
    assert sum(parts) == whole
    assert value(executive.value_total(t, Filters(warehouse=("WH01", "WH09")))) == whole


def test_filter_options(t):
    options = {k: [r["value"] for r in rows(v)] for k, v in
               filter_options(t, Filters(region=("South",), category=("food",))).items()}
    assert options["region"] == ["North", "South"] and options["warehouse"] == ["WH02"]
    assert options["category"] == ["food", "toys"] and options["brand"] == ["X"]
    assert options["sku"] == ["A", "B"]
    assert options["stock_status"] == ["Stockout", "Low stock", "Healthy", "Overstock"]


def test_recent_movements(t):
    now = datetime(2001, 8, 1, 12)
    assert [r["sku_id"] for r in rows(reports.recent_movements(t, now))] == ["D"]
    assert rows(reports.recent_movements(t, now, 90, warehouse_id="wh09")) == []
    got = rows(reports.recent_movements(t, now, 90, sku_id="a", limit=1))
    assert (got[0]["movement_count"], got[0]["net_qty_change"]) == (1, 1)


@pytest.mark.parametrize("sql", [
    "", " ; ", "select 1; drop table x", "insert into x values (1)", "delete from x",
    "with a as (select 1) select * from a; select 2", "values (1)", "select 1 as Drop",
])
def test_unsafe_sql_is_refused(sql):
    with pytest.raises(ValueError):
        reports.check_readonly(sql)


def test_readonly_sql(spark, t):
    assert reports.check_readonly(" explain select 1; ") == "explain select 1"
    out = reports.readonly_sql(spark, "SELECT count(*) AS n FROM dim_product", {"dim_product": t.product})
    assert value(out) == 6
    assert reports.readonly_sql(spark, "select id from range(1000)").count() == 200
    assert reports.sample_rows(spark.range(100), 50).count() == 20


def test_readiness_gate(t, empty):
    assert quality.assert_populated({"stock": t.snapshot, "sites": t.warehouse}).count() == 2
    with pytest.raises(ValueError, match="stock"):
        quality.assert_populated({"stock": empty.snapshot, "items": t.product})


def test_alert_states(spark):
    kpis = spark.createDataFrame(
        [("supplier_sla", 0.95), ("snapshot_lag_hours", 23.0), ("dead_stock_value", 1.0),
         ("count_accuracy", None)], "kpi string, value double")
    got = {r["kpi"]: r["state"] for r in rows(quality.alerts(kpis, quality.rules_table(spark)))}
    assert got == {"supplier_sla": "ok", "snapshot_lag_hours": "ok", "dead_stock_value": "alert",
                   "count_accuracy": "no data"}
