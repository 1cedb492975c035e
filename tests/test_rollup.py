from __future__ import annotations

import json

from stocklens.sources import topics
from stocklens.streaming.rollup import ROLLUP, movement_rollup, numbered_movements, start_rollup

TOPIC = "inventory_topic"


def line(n, when, qty=1, sku="S1"):
    return json.dumps({"event_id": n, "warehouse_id": "W1", "sku_id": sku, "qty_change": qty, "event_time": when})


def put(folder, name, *lines):
    (folder / TOPIC).mkdir(parents=True, exist_ok=True)
    (folder / TOPIC / name).write_text("\n".join(lines) + "\n")


def run(spark, folder):
    messages = topics.read_topic(spark, TOPIC, folder=str(folder))
    start_rollup(messages, str(folder / "totals"), str(folder / "checkpoint")).awaitTermination()
    rows = spark.read.schema(ROLLUP).parquet(str(folder / "totals")).collect()
    return sorted((str(r.window_start)[:10], r.sku_id, r.movement_count, r.net_qty_change) for r in rows)


def test_late_repeated_and_too_late_events_over_restarts(spark, tmp_path):
    put(tmp_path, "1", line(1, "2001-05-01 10:00:00", 5), line(2, "2001-05-01 11:00:00", 7), line(1, "2001-05-01 10:00:00", 5))
    assert run(spark, tmp_path) == []  # no window is closed yet
    put(tmp_path, "2", line(3, "2001-05-02 09:00:00"), line(2, "2001-05-01 11:00:00", 7), "{broken", line(None, "2001-05-02 09:00:00"))
    put(tmp_path, "3", line(4, "2001-05-01 23:00:00", -2), line(5, "2001-05-02 09:00:00", 3, "S2"))
    assert run(spark, tmp_path) == []
    put(tmp_path, "4", line(6, "2001-05-04 06:00:00"))
    first = [("2001-05-01", "S1", 3, 10)]
    assert run(spark, tmp_path) == first
    assert run(spark, tmp_path) == first  # a restart without news adds nothing
    put(tmp_path, "5", line(7, "2001-05-01 12:00:00", 100), line(3, "2001-05-02 09:00:00"), line(8, "2001-05-09 00:00:00"))
    want = [*first, ("2001-05-02", "S1", 1, 1), ("2001-05-02", "S2", 1, 3), ("2001-05-04", "S1", 1, 1)]
    assert run(spark, tmp_path) == want
    batch = spark.read.text(str(tmp_path / TOPIC))
    totals = {(str(r.window_start)[:10], r.sku_id): r.movement_count for r in movement_rollup(numbered_movements(batch)).collect()}
    assert totals[("2001-05-01", "S1")] == 4 and totals[("2001-05-09", "S1")] == 1  # the batch has no watermark
