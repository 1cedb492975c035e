"""Snapshot polls as runs of days: the same rows and keys as polls of days, without a shuffle of the days."""

from __future__ import annotations

from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stocklens import catalog
from stocklens.operators import derive, staging
from stocklens.plans import manifest as m
from stocklens.plans import pipeline
from stocklens.plans.incremental import IncrementalMart
from stocklens.sources import extract
from tests.small import LANDED, TODAY
from tests.test_placed_days import shuffled_by
from tests.test_snapshot import costs, frame
from tests.test_snapshot_runs import filled_last, moves


def runs(spark):
    twice = costs(spark, "A", "B", "C", "A")
    built = derive.stock_runs(frame(spark, moves()), twice, TODAY, 120, opening="history")
    odd = built.withColumn("unit_cost", F.when(F.col("sku_id") != "B", F.col("unit_cost")))
    return odd.withColumns({c: F.lit(LANDED) for c in ("created_at", "ingestion_time")})


def test_days_of_runs_have_the_keys_of_days(spark):
    texts = extract.runs_with_row_text(runs(spark))
    got = extract.days_with_row_key(derive.fill_days(texts))
    want = extract.with_row_key(derive.fill_days(runs(spark)))
    assert got.columns == want.columns and filled_last(got)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert {r["copy"] for r in got.select("copy").distinct().collect()} == {1, 2}


@pytest.mark.parametrize("hours", [0, 6])
def test_newer_days_of_runs(spark, hours):
    last = datetime(2001, 6, 1) + timedelta(hours=hours)
    newer, mark = extract.incremental_read(runs(spark), "snapshot_date", last, 20 * 86_400)
    days, of_days = extract.incremental_read(derive.fill_days(runs(spark)), "snapshot_date", last, 20 * 86_400)
    assert sorted(derive.fill_days(newer).collect(), key=str) == sorted(days.collect(), key=str)
    assert mark.collect() == of_days.collect()
    none, mark = extract.incremental_read(runs(spark), "snapshot_date", datetime(2002, 1, 1))
    assert none.count() == 0 and mark.first()[0] == datetime(2002, 1, 1)


def test_polls_of_the_snapshot_are_not_arranged_by_day(spark, tmp_path, monkeypatch):
    seen = shuffled_by(monkeypatch)
    rule = {c: F.lit(1) for c in ("reserved_qty", "damaged_qty", "in_transit_qty")}
    monkeypatch.setattr(pipeline, "sample_shelf_rule", lambda: rule)
    monkeypatch.setattr(catalog, "work_folder", lambda spark, purpose: str(tmp_path / purpose))
    twice = costs(spark, "A", "B", "C", "A")
    src = SimpleNamespace(spark=spark, transactions=frame(spark, moves()), sku_costs=twice)
    got = catalog.overlapping_polls(src, "raw_inventory_snapshot_daily")
    want = staging.stg_snapshot(pipeline.raw_snapshot(src))
    assert seen == [] and got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert m.read_manifest(spark, f"{tmp_path}/polls/raw_inventory_snapshot_daily").rows == pipeline.raw_snapshot(src).count()


def test_settled_rows_of_new_months_replace_nothing(spark, tmp_path):
    kind = "id int, day date, qty int"
    rows = [(n, datetime(2001, month, 3).date(), n) for n, month in enumerate((4, 5, 6))]
    mart = IncrementalMart(spark, str(tmp_path), spark.range(0))
    mart.upsert("lines", spark.createDataFrame(rows, kind), ["id"], "day", settled=True)
    mart.upsert("lines", spark.createDataFrame([(2, rows[2][1], 20), (3, datetime(2001, 7, 1).date(), 3)], kind), ["id"], "day", settled=True)
    assert sorted((r.id, r.qty) for r in mart.table("lines").collect()) == [(0, 0), (1, 1), (2, 20), (3, 3)]
