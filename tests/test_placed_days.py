"""Tables by day written from runs or from a table by day: dense rows are neither shuffled nor sorted."""

from __future__ import annotations

from datetime import timedelta
from types import SimpleNamespace

import pyarrow.parquet as pq

from stocklens import catalog
from stocklens.operators import derive
from stocklens.plans import layout
from stocklens.plans import manifest as m
from stocklens.plans.incremental import SNAPSHOT, IncrementalMart
from tests.small import TODAY, days_ago
from tests.test_incremental import moves as movements
from tests.test_snapshot import costs, frame
from tests.test_snapshot_runs import moves

PAIR = ["warehouse_id", "sku_id"]


def shuffled_by(monkeypatch):
    """The columns that rows are arranged by from now on."""
    seen, was = [], m.arranged
    for module in (m, layout):
        monkeypatch.setattr(module, "arranged", lambda df, column, sort: seen.append(column) or was(df, column, sort))
    return seen


def test_placed_days_are_written_in_the_order_of_keys(spark, tmp_path):
    runs = derive.stock_runs(frame(spark, moves()), costs(spark, "A", "B", "C"), TODAY, 120, opening="history")
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    for n, task_runs in enumerate((7, 10_000)):  # few days a task, and more of them than files may be open
        path = str(tmp_path / str(n))
        days = layout.placed_days(runs, task_runs)
        assert "Exchange" not in (plan := days._jdf.queryExecution().executedPlan().toString())[: plan.index("explode(sequence(valid_from")]
        held = m.publish(days, path, "snapshot_date", "snapshot_date", PAIR, placed=True)
        assert len(held.parts) == 121 and held.rows == days.count() and spark.conf.get(key) == before
        assert (held.first, held.last) == (days_ago(120).isoformat(), TODAY.isoformat())
        want = derive.fill_days(runs).select(sorted(runs.columns[2:]))
        assert sorted(m.read_table(spark, path).select(want.columns).collect()) == sorted(want.collect())
        for file in tmp_path.glob(f"{n}/v=*/*/*.parquet"):
            keys = [tuple(r.values()) for r in pq.ParquetFile(file).read(columns=PAIR).to_pylist()]
            assert keys == sorted(keys)


def test_clipped_runs(spark):
    data = [("A", days_ago(9), days_ago(3)), ("B", days_ago(2), days_ago(1)), ("C", None, days_ago(1)), ("D", days_ago(5), None)]
    runs = spark.createDataFrame(data, "sku_id string, valid_from date, valid_to date")
    assert sorted(map(tuple, derive.clipped(runs, days_ago(4), days_ago(2)).collect())) == [
        ("A", days_ago(4), days_ago(3)), ("B", days_ago(2), days_ago(2))]
    assert derive.clipped(runs).count() == 2 and derive.clipped(runs, last=days_ago(10)).count() == 0


def test_a_refreshed_snapshot_is_not_shuffled_by_day(spark, tmp_path, monkeypatch):
    seen = shuffled_by(monkeypatch)
    mart = IncrementalMart(spark, str(tmp_path), costs(spark, "A", "B", "C"), 30)
    first = [(days_ago(40), "W1", "A", 5), (days_ago(12), "W1", "B", 4)]
    later = [(days_ago(3), "W1", "C", 2), (days_ago(20), "W1", "A", -1)]
    mart.refresh(movements(spark, *first), days_ago(8))
    mart.refresh(movements(spark, *later), TODAY)
    everything = movements(spark, *first, *later)
    want = derive.build_snapshot(everything, mart.costs, TODAY, 30, opening="history")
    assert set(seen) == {"month"}
    assert sorted(mart.table(SNAPSHOT, want.schema).select(want.columns).collect()) == sorted(want.collect())


def test_a_replaced_window_is_not_shuffled_by_day(spark, tmp_path, monkeypatch):
    seen = shuffled_by(monkeypatch)
    monkeypatch.setattr(catalog, "work_folder", lambda spark, purpose: str(tmp_path / purpose))
    data = [(TODAY - timedelta(days=n), w, s, n, None, None) for n in range(60) for w in ("WH01", "WH02") for s in "AB"]
    kind = "snapshot_date date, warehouse_id string, sku_id string, on_hand_qty int, created_at timestamp, ingestion_time timestamp"
    snapshot = spark.createDataFrame(data, kind)
    found = catalog.replaced_window(SimpleNamespace(spark=spark, snapshot=snapshot))
    want = snapshot.drop("created_at", "ingestion_time")
    assert seen == [] and sorted(found.select(want.columns).collect()) == sorted(want.collect())
