"""Runs of days: staged and laid out before the days are filled in."""

from __future__ import annotations

import random
from types import SimpleNamespace

from pyspark.sql import functions as F

from stocklens.catalog import OUTGOING, wire_rows
from stocklens.operators import derive, staging
from stocklens.plans import pipeline
from stocklens.sources import extract
from tests.small import LANDED, TODAY, days_ago
from tests.test_snapshot import costs, frame

COLUMNS = ["snapshot_date", "warehouse_id", "sku_id", "on_hand_qty", "inventory_value"]


def moves():
    rng = random.Random(3)
    return [
        (days_ago(rng.randint(-2, 150)), rng.choice(["W1", "W2"]), rng.choice("ABCX"), rng.randint(-9, 9))
        for _ in range(60)
    ]


def landed(df):
    return df.withColumns({c: F.lit(LANDED) for c in ("created_at", "ingestion_time")})


def filled_last(df):
    """No exchange above the step that makes a row for each day."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("explode(sequence(valid_from")]
    return "Exchange" not in top


def test_staged_runs_equal_staged_days(spark):
    tx = frame(spark, moves())
    twice = costs(spark, "A", "B", "C", "A")  # a key that comes twice
    runs = landed(derive.stock_runs(tx, twice, TODAY, opening="history"))
    days = landed(derive.build_snapshot(tx, twice, TODAY, opening="history"))
    by_run = derive.fill_days(staging.stg_snapshot(runs.unionByName(runs)))
    by_day = staging.stg_snapshot(days.unionByName(days))
    assert by_run.columns == by_day.columns
    assert sorted(by_run.collect()) == sorted(by_day.collect())
    assert filled_last(derive.fill_days(staging.stg_snapshot(runs)))


def test_runs_of_a_pair_do_not_overlap(spark):
    runs = derive.stock_runs(frame(spark, moves()), costs(spark, "A", "B", "C"), TODAY, 120, opening="history")
    per_pair = runs.groupBy("warehouse_id", "sku_id").agg(
        F.sum(F.datediff("valid_to", "valid_from") + 1).alias("days"),
        F.min("valid_from").alias("first"), F.max("valid_to").alias("last"),
    )
    assert {(r.days, r.first, r.last) for r in per_pair.collect()} == {(121, days_ago(120), TODAY)}


def test_cut_runs_cover_the_same_days(spark):
    runs = derive.stock_runs(frame(spark, moves()), costs(spark, "A", "B", "C"), TODAY, 120, opening="history")
    cut = derive.cut_runs(runs, 11)
    pieces = runs.agg(F.sum(F.size(derive.block_numbers(11)))).first()[0]
    assert cut.count() == pieces > runs.count()
    assert cut.filter(F.datediff("valid_to", "valid_from") >= 11).count() == 0
    whole = derive.fill_days(runs).select(*COLUMNS).collect()
    assert sorted(derive.fill_days(cut).select(*COLUMNS).collect()) == sorted(whole)


def test_published_snapshot_shuffles_runs_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "TASK_RUNS", 7)
    src = SimpleNamespace(spark=spark, sku_costs=costs(spark, "A", "B", "C"))
    mart = pipeline.PublishedMart(src, str(tmp_path), "state")
    mart.__dict__["movement"] = frame(spark, moves())
    rule = {c: F.lit(1) for c in ("reserved_qty", "damaged_qty", "in_transit_qty")}
    monkeypatch.setattr(pipeline, "sample_shelf_rule", lambda: rule)
    assert filled_last(mart.placed_snapshot())
    lazy = mart.frame("snapshot")
    written = mart.snapshot.select(*lazy.columns)
    assert sorted(written.collect(), key=str) == sorted(lazy.collect(), key=str)
    held = mart.manifest("snapshot")
    assert (held.rows, held.last) == (lazy.count(), TODAY.isoformat()) and len(held.parts) == 121


def test_wire_rows_get_their_cost_before_days_are_filled(spark, monkeypatch):
    rule = {c: F.lit(1) for c in ("reserved_qty", "damaged_qty", "in_transit_qty")}
    monkeypatch.setattr(pipeline, "sample_shelf_rule", lambda: rule)
    monkeypatch.setattr(staging, "stg_product", lambda skus: skus)
    known = costs(spark, "A", "C").withColumn("unit_cost", F.lit(7).cast("decimal(18,2)"))
    src = SimpleNamespace(transactions=frame(spark, moves()), sku_costs=costs(spark, "A", "B", "C"), skus=known)
    sent = OUTGOING["snapshot_topic"](src)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert filled_last(sent) and "Join" not in plan[: plan.index("explode(sequence(valid_from")]
    want = extract.extract_snapshot(pipeline.raw_snapshot(src).drop("ingestion_time"), known)
    assert sent.columns == want.columns
    assert sorted(sent.collect(), key=str) == sorted(want.collect(), key=str)


def test_wire_rows_are_shaped_once_per_run(spark, monkeypatch):
    rule = {c: F.lit(1) for c in ("reserved_qty", "damaged_qty", "in_transit_qty")}
    monkeypatch.setattr(pipeline, "sample_shelf_rule", lambda: rule)
    monkeypatch.setattr(staging, "stg_product", lambda skus: skus)
    known = costs(spark, "A", "C")
    src = SimpleNamespace(transactions=frame(spark, moves()), sku_costs=costs(spark, "A", "B", "C"), skus=known)
    sent = wire_rows(src, "snapshot_topic")
    plan = sent._jdf.queryExecution().executedPlan().toString()
    per_day = plan[: plan.index("explode(sequence(valid_from")]
    assert filled_last(sent) and "as double" not in per_day and "created_at" in per_day
    want = extract.to_wire(OUTGOING["snapshot_topic"](src))
    assert sent.schema == want.schema
    assert sorted(sent.collect(), key=str) == sorted(want.collect(), key=str)


def test_wire_days_beyond_the_known_ones(spark):
    data = [("A", days_ago(9), days_ago(-3)), ("B", days_ago(2), days_ago(2)), ("C", None, days_ago(1))]
    runs = spark.createDataFrame(data, "sku_id string, valid_from date, valid_to date")
    sent = extract.wire_snapshot(runs, days_ago(5), days_ago(1))
    want = [("A", days_ago(n).isoformat()) for n in range(9, -4, -1)] + [("B", days_ago(2).isoformat())]
    assert sorted(map(tuple, sent.collect())) == sorted(want)
