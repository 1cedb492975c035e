from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from stocklens.catalog import movement_totals
from stocklens.operators.staging import stg_transactions
from stocklens.plans.layout import read_current
from stocklens.sources import topics
from stocklens.streaming.landing import start_landing, start_rejects, stream_append, stream_refresh

NOW = datetime(2001, 8, 1, 6)
TOPIC = "inventory_topic"


def line(n: int) -> str:
    when = f"2001-0{1 + n % 3}-01 00:00:{n:02d}"
    return json.dumps({"warehouse_id": "W1", "sku_id": f"S{n % 2}", "qty_change": n - 3,
                       "event_time": when})


def put(folder, name, *lines):
    (folder / TOPIC).mkdir(parents=True, exist_ok=True)
    (folder / TOPIC / name).write_text("\n".join(lines) + "\n")


def run(spark, folder):
    for start, table, extra in ((start_landing, "raw", [NOW]), (start_rejects, "bad", [])):
        stream = topics.read_topic(spark, TOPIC, folder=str(folder), files_per_trigger=1)
        paths = [str(folder / table), str(folder / f"{table}-checkpoint")]
        start(stream, TOPIC, *paths, *extra).awaitTermination()


def test_stream_equals_batch_and_restarts_add_nothing(spark, tmp_path):
    for i in range(4):
        put(tmp_path, f"{i}.json", line(i), line(i + 4), *(["{broken"] if i == 2 else []))
    run(spark, tmp_path)
    batch = topics.land(spark.read.text(str(tmp_path / TOPIC)), TOPIC, NOW)

    def landed():
        return sorted(spark.read.parquet(str(tmp_path / "raw")).drop("month").collect())

    assert landed() == sorted(batch.collect()) and len(landed()) == 8
    assert [r.message for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["{broken"]
    run(spark, tmp_path)
    assert len(landed()) == 8
    put(tmp_path, "late.json", line(9))
    run(spark, tmp_path)
    assert len(landed()) == 9
    assert {p.name for p in (tmp_path / "raw").glob("month=*")} == {
        "month=2001-01", "month=2001-02", "month=2001-03",
    }


def test_refresh_after_every_batch(spark, tmp_path):
    put(tmp_path, "a.json", line(1), line(2))
    run(spark, tmp_path)
    raw, mart = str(tmp_path / "raw"), str(tmp_path / "totals")

    def refresh():
        schema = spark.read.parquet(raw).schema
        stream = spark.readStream.schema(schema).parquet(raw)
        stream_refresh(
            stream, lambda _: movement_totals(spark.read.parquet(raw)), mart,
            str(tmp_path / "totals-checkpoint"), every_seconds=None,
        ).awaitTermination()

    refresh()
    assert read_current(spark, mart).agg(F.sum("movement_count")).first()[0] == 2
    put(tmp_path, "b.json", line(5))
    run(spark, tmp_path)
    refresh()
    totals = read_current(spark, mart)
    assert totals.agg(F.sum("movement_count")).first()[0] == 3
    assert totals.agg(F.sum("net_qty_change")).first()[0] == (1 - 3) + (2 - 3) + (5 - 3)


def test_append_equals_a_full_refresh(spark, tmp_path):
    raw, fact = str(tmp_path / "raw"), str(tmp_path / "fact")
    for i in range(3):
        put(tmp_path, f"{i}.json", line(i), line(i + 3))
        run(spark, tmp_path)
        stream = spark.readStream.schema(spark.read.parquet(raw).schema).parquet(raw)
        stream_append(
            stream, stg_transactions, fact, str(tmp_path / "fact-checkpoint"), "event_date", None
        ).awaitTermination()
    whole = stg_transactions(spark.read.parquet(raw))
    appended = spark.read.parquet(fact).select(*whole.columns)
    assert sorted(appended.collect()) == sorted(whole.collect())
    assert appended.count() == 6
