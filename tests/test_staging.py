from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stocklens.functions import latest_per_key, ratio
from stocklens.operators import staging
from stocklens.plans.pipeline import MART_READS, lazy_mart, raw_snapshot, signed_snapshot
from stocklens.schemas import mart_schema
from stocklens.operators.mart import TABLE_NAMES
from stocklens.sources.trade_tables import TradeTables
from tests.small import rows

NOW = datetime(2001, 8, 1)


def test_blank_keys_are_dropped_and_others_normalised(spark):
    raw = spark.createDataFrame(
        [("", "a", 1), ("  ", "b", 1), (" wh01 ", " sku_1 ", -3), ("WH02", None, 1), ("x", " ", 1)],
        "warehouse_id string, sku_id string, qty_change int",
    ).withColumns({"event_time": F.lit(NOW), "ingestion_time": F.lit(NOW)})
    out = rows(staging.stg_transactions(raw))
    assert [(r["warehouse_id"], r["sku_id"]) for r in out] == [("WH01", "SKU_1")]
    assert (out[0]["event_type"], out[0]["qty_in"], out[0]["qty_out"]) == ("outbound", 0, 3)


def test_movement_direction(spark):
    raw = spark.createDataFrame(
        [("W", "S", 5), ("W", "S", -5), ("W", "S", 0)],
        "warehouse_id string, sku_id string, qty_change int",
    ).withColumns({"event_time": F.lit(NOW), "ingestion_time": F.lit(NOW)})
    out = {r["qty_change"]: r for r in rows(staging.stg_transactions(raw))}
    assert out[5]["event_type"] == "inbound" and out[-5]["event_type"] == "outbound"
    assert out[0]["event_type"] == "adjustment"
    assert all(r["qty_in"] - r["qty_out"] == q for q, r in out.items())


def test_po_lines_clamp_before_the_open_quantity(spark):
    raw = spark.createDataFrame(
        [(1, 1, 1, " s1", 10, -5, 2.5, ""), (2, 1, 2, "s2", -1, 0, -2.0, " open "),
         (3, 1, 3, "s3", 4, 9, 1.0, "  ")],
        "po_line_id long, po_id long, line_no int, sku_id string, qty_ordered int, "
        "qty_received int, unit_cost double, line_status string",
    ).withColumns({"created_at": F.lit(NOW), "ingestion_time": F.lit(NOW)})
    out = {r["po_line_id"]: r for r in rows(staging.stg_po_lines(raw))}
    assert (out[1]["qty_received"], out[1]["qty_open"]) == (0, 10)
    assert out[1]["line_status"] == "unknown" and out[3]["line_status"] == "unknown"
    assert out[2]["line_status"] == "open" and out[2]["qty_ordered"] == 0
    assert out[2]["unit_cost"] == Decimal("0.00") and out[3]["qty_open"] == 0


def test_counts_recompute_the_variance(spark):
    raw = spark.createDataFrame(
        [(date(2001, 7, 1), "w", "s", 10, 7, 99)],
        "count_date date, warehouse_id string, sku_id string, system_qty int, counted_qty int, "
        "variance_qty int",
    ).withColumns({"created_at": F.lit(NOW), "ingestion_time": F.lit(NOW)})
    assert rows(staging.stg_stock_counts(raw))[0]["variance_qty"] == -3


def test_latest_warehouse_by_parsed_date(spark):
    raw = spark.createDataFrame(
        [(" wh1", "old", "c", "r", "2001-01-01"), ("WH1", " new ", "c", "r", "2001-01-01 10:00:00"),
         ("wh1 ", "never", "c", "r", "n/a"), ("WH2", "only", "c", "r", "n/a"),
         ("WH3", "b", "c", "r", "2001-02-01"), ("WH3", "a", "z", "r", "2001-02-01"),
         ("WH4", "x", "c", "r", "12:30")],
        "warehouse_id string, warehouse_name string, city string, region string, created_at string",
    )
    out = {r["warehouse_id"]: r for r in rows(staging.stg_warehouse(raw))}
    assert out["WH1"]["warehouse_name"] == "new"
    assert out["WH2"]["created_at"] == datetime(1970, 1, 1)
    assert (out["WH3"]["warehouse_name"], out["WH3"]["city"]) == ("b", "c")  # one whole row
    assert out["WH4"]["created_at"] == datetime(1970, 1, 1)
    assert staging.stg_warehouse(raw, dedupe=False).count() == 7


version = st.tuples(st.sampled_from("ab"), st.integers(0, 3), st.sampled_from("xyz"))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(version, min_size=1, max_size=12), st.randoms())
def test_latest_is_idempotent_and_ignores_order(spark, versions, random):
    schema = "k string, ts int, v string"
    shuffled = list(versions)
    random.shuffle(shuffled)
    first = latest_per_key(spark.createDataFrame(versions, schema), ["k"], "ts")
    second = latest_per_key(spark.createDataFrame(shuffled, schema), ["k"], "ts")
    want = {}
    for k, ts, v in versions:
        want[k] = max(want.get(k, (ts, v)), (ts, v))
    got = {r.k: (r.ts, r.v) for r in first.collect()}
    assert got == want == {r.k: (r.ts, r.v) for r in second.collect()}
    again = latest_per_key(first, ["k"], "ts")
    assert {r.k: (r.ts, r.v) for r in again.collect()} == want


def test_ratio_is_exact(spark):
    pairs = [(a, b) for a in (0, 1, 5, 7, 12, 125, 375, 999, -1, -125) for b in range(0, 1001, 8)]
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.withColumn("r", ratio(F.col("a"), F.col("b"))).collect():
        if r.b == 0:
            assert r.r is None
        else:
            exact = (Decimal(r.a) / Decimal(r.b)).quantize(Decimal("0.01"), "ROUND_HALF_EVEN")
            assert Decimal(str(r.r)) == exact, (r.a, r.b)


def test_half_even(spark):
    df = spark.createDataFrame([(125, 1000), (375, 1000), (1, 8)], "a long, b long")
    got = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.12, 0.38, 0.12]


def test_calendar(spark):
    out = {r["full_date"]: r for r in rows(staging.dim_date(spark, date(2001, 8, 1)))}
    assert len(out) == 861
    assert min(out) == date(1999, 5, 24) and max(out) == date(2001, 9, 30)
    saturday = out[date(2001, 8, 4)]
    assert (saturday["date_key"], saturday["day_of_week"], saturday["is_weekend"]) == (20010804, 6, 1)
    assert (saturday["day_name"], saturday["month_name"]) == ("Sat", "August")
    assert all(r["day_of_week"] == d.isoweekday() for d, r in out.items())


@pytest.mark.parametrize("field", sorted(MART_READS))
def test_mart_schema(spark, field):
    tables = lazy_mart(TradeTables(spark, "/root/testdata/sf0.001"))
    declared = mart_schema(TABLE_NAMES[field])
    got = getattr(tables, field).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in declared]


@pytest.mark.parametrize("name", ["snapshot", "po_lines", "sales_lines", "stock_counts"])
def test_facts_landed_twice_are_staged_once(spark, name):
    clean = {
        "snapshot": staging.stg_snapshot, "po_lines": staging.stg_po_lines,
        "sales_lines": staging.stg_sales_lines, "stock_counts": staging.stg_stock_counts,
    }[name]
    src = TradeTables(spark, "/root/testdata/sf0.001")
    raw = raw_snapshot(src).limit(500) if name == "snapshot" else getattr(src, name)
    ids = {"po_lines": ["po_line_id"], "sales_lines": ["so_line_id"], "stock_counts": ["count_id"]}
    raw = (raw.dropDuplicates(ids[name]) if name in ids else raw).persist()
    once = clean(raw, dedupe=False)
    assert clean(raw.union(raw), dedupe=True).exceptAll(once).count() == 0
    assert clean(raw.union(raw), dedupe=True).count() == once.count()
    assert clean(raw.union(raw), dedupe=False).count() == 2 * once.count()
    later = raw.withColumn("ingestion_time", F.timestamp_seconds(F.lit(2_000_000_000)))
    assert clean(raw.union(later), dedupe=True).select("ingestion_time").distinct().count() == 1
    raw.unpersist()


def test_rows_without_a_key_all_stay(spark):
    src = TradeTables(spark, "/root/testdata/sf0.001")
    raw = src.stock_counts.limit(7).withColumn("count_id", F.lit(None).cast("long"))
    assert staging.stg_stock_counts(raw, dedupe=True).count() == 7


def test_negative_stock_reaches_the_fact(spark):
    src = TradeTables(spark, "/root/testdata/sf0.001")
    raw = raw_snapshot(src).limit(20).withColumn("available_qty", F.lit(-4).cast("int"))
    assert {r.available_qty for r in staging.stg_snapshot(raw).collect()} == {0}
    assert {r.available_qty for r in signed_snapshot(raw).collect()} == {-4}
