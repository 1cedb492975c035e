from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.functions import latest_per_key
from stocklens.plans import layout
from stocklens.plans.incremental import IncrementalMart
from stocklens.schemas import MESSAGES, message_schema
from stocklens.sources import extract, topics
from tests.small import rows

NOW = datetime(2001, 8, 1, 6)


def at(second: int) -> datetime:
    return datetime(2001, 1, 1, 0, 0, second)


@pytest.fixture
def updates(spark):
    data = [(1, at(0)), (2, at(1)), (3, at(2)), (4, at(2)), (5, at(3))]
    return spark.createDataFrame(data, "id int, created_at timestamp")


def test_marks_are_strict_and_polls_add_up(spark, updates):
    first, mark = extract.incremental_read(updates.filter("id <= 3"), "created_at", at(0))
    assert sorted(r.id for r in first.collect()) == [2, 3]
    reached = mark.first()["mark"]
    assert reached == at(2)
    second, _ = extract.incremental_read(updates, "created_at", reached)
    # Row 4 came late with the second of the mark: a strict poll misses it.
    assert sorted(r.id for r in second.collect()) == [5]
    again, _ = extract.incremental_read(updates, "created_at", reached, overlap_seconds=1)
    both = first.unionAll(again)
    assert sorted(r.id for r in latest_per_key(both, ["id"], "created_at").collect()) == [2, 3, 4, 5]


def test_mark_never_goes_back(spark):
    numbers = spark.range(10).withColumnRenamed("id", "stream_seq")
    newer, mark = extract.incremental_read(numbers, "stream_seq", 50)
    assert newer.count() == 0 and mark.first()["mark"] == 50
    newer, mark = extract.incremental_read(numbers, "stream_seq", 4)
    assert newer.count() == 5 and mark.first()["mark"] == 9


def test_marks_are_kept(spark, tmp_path):
    path = str(tmp_path / "mark")
    for last in (3, 7):
        extract.save_mark(spark.createDataFrame([(last,)], "mark long"), path)
        assert extract.load_mark(spark, path) == last


def test_poll_statement():
    options = extract.jdbc_options(
        "jdbc:x", "stock_counts", "created_at", at(5), "count_id", (1, 900), 8
    )
    assert "created_at > '2001-01-01 00:00:05'" in options["dbtable"]
    assert (options["numPartitions"], options["fetchsize"]) == ("8", "5000")
    assert "stream_seq > 12" in extract.jdbc_options("u", "t", "stream_seq", 12)["dbtable"]


def test_every_input_has_a_topic():
    assert {topic for _, topic in extract.INPUTS.values()} == set(MESSAGES) == set(topics.LANDINGS)


def test_wire_shape(spark):
    df = spark.createDataFrame(
        [(7, date(2001, 1, 2), at(3), Decimal("1.20"), 5)],
        "STREAM_SEQ long, Count_Date date, created_at timestamp, unit_cost decimal(18,2), QTY long",
    )
    out = extract.to_wire(df)
    assert out.columns == ["count_date", "created_at", "unit_cost", "qty"]
    assert tuple(out.first()) == ("2001-01-02", "2001-01-01 00:00:03", 1.2, 5)
    assert out.schema["qty"].dataType == T.IntegerType()


def test_extract_time_cost(spark):
    snapshot = spark.createDataFrame([("A", 1), ("Z", 2)], "sku_id string, on_hand_qty int")
    skus = spark.createDataFrame([("A", 1.5)], "sku_id string, unit_cost double")
    got = {r.sku_id: r.unit_cost for r in extract.extract_snapshot(snapshot, skus).collect()}
    assert got == {"A": 1.5, "Z": None}


def messages(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_broken_and_incomplete_messages(spark):
    lines = messages(
        spark,
        '{"warehouse_id": "W", "sku_id": "S", "qty_change": 3, "event_time": "2001-01-01 10:00:00"}',
        '{"warehouse_id": "W", "sku_id": "S", "qty_ch',
        '{"warehouse_id": "W", "sku_id": "S", "qty_change": "many", "event_time": null}',
        '{"warehouse_id": "W"}',
    )
    good = rows(topics.land(lines, "inventory_topic", NOW))
    assert [r["qty_change"] for r in good] == [3, None]
    assert good[0]["event_time"] == datetime(2001, 1, 1, 10)
    assert good[0]["ingestion_time"] == NOW
    assert topics.rejects(lines, "inventory_topic").count() == 2


def test_facts_without_a_date_are_rejected_but_dimensions_are_not(spark):
    def line(created):
        return json.dumps({"so_line_id": 1, "qty": 2, "unit_price": 1.159, "created_at": created})

    lines = messages(spark, line("2001-02-03 04:05:06"), line("2001-02-03"), line("n/a"), line(None))
    landed = rows(topics.land(lines, "sales_lines_topic", NOW))
    assert [r["created_at"] for r in landed] == [datetime(2001, 2, 3, 4, 5, 6), datetime(2001, 2, 3)]
    assert landed[0]["unit_price"] == Decimal("1.16")
    counts = messages(spark, *[
        json.dumps({"count_id": i, "count_date": d, "created_at": "2001-01-01 00:00:00"})
        for i, d in enumerate(["2001-01-05", "soon"])])
    assert [r["count_date"] for r in rows(topics.land(counts, "stock_counts_topic", NOW))] == [
        date(2001, 1, 5)]
    dims = messages(spark, '{"warehouse_id": "W", "created_at": "n/a"}')
    assert rows(topics.land(dims, "dim_warehouses_topic", NOW))[0]["created_at"] == "n/a"


@pytest.mark.parametrize("topic", sorted(MESSAGES))
def test_landing_schema(spark, topic):
    landed = topics.land(messages(spark, "{}"), topic, NOW)
    assert set(message_schema(topic).fieldNames()) | {"ingestion_time"} == set(landed.columns)


def test_swap_keeps_readers_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        layout.current_path(spark, path)
    layout.swap_overwrite(spark.range(5), path)
    reader = layout.read_current(spark, path)
    layout.swap_overwrite(spark.range(8), path)
    assert reader.count() == 5  # a reader of the old version still finds its files
    assert layout.read_current(spark, path).count() == 8
    layout.swap_overwrite(spark.range(2), path)
    versions = [p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("v=")]
    assert len(versions) == 2


def test_failed_refresh_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    layout.swap_overwrite(spark.range(5), path)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        layout.swap_overwrite(broken, path)
    assert layout.read_current(spark, path).count() == 5


def days(spark, *pairs):
    return spark.createDataFrame([(date(2001, 1, d), v) for d, v in pairs], "day date, v int")


def test_replace_window(spark, tmp_path):
    path = str(tmp_path / "days")
    layout.write_by_day(days(spark, (1, 1), (2, 2), (3, 3), (4, 4)), path, "day", ["v"])
    fresh = days(spark, (1, 99), (2, 20), (2, 21), (4, 40))
    layout.replace_window(fresh, path, "day", date(2001, 1, 2), date(2001, 1, 4))
    got = sorted((r.day.day, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 20), (2, 21), (4, 40)]  # day 3 lost its rows


def test_monthly_layout_prunes(spark, tmp_path):
    path = str(tmp_path / "months")
    df = spark.createDataFrame([(date(2001, m, 5), m) for m in range(1, 13)], "day date, v int")
    layout.write_layer(df, path, "day", ["v"])
    recent = layout.since(spark.read.parquet(path), "day", date(2001, 11, 5))
    assert sorted(r.v for r in recent.collect()) == [11, 12]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    middle = layout.between(spark.read.parquet(path), "day", date(2001, 2, 6), date(2001, 4, 5))
    assert sorted(r.v for r in middle.collect()) == [3, 4]


def test_row_keys_are_the_same_at_every_poll(spark):
    kind = "a int, b string, ingestion_time timestamp"
    early, late = datetime(2001, 8, 1, 6), datetime(2001, 8, 1, 7)
    data = [(1, "x"), (1, "x"), (1, None), (None, None), (None, None), (2, "")]
    first = extract.with_row_key(spark.createDataFrame([(*r, early) for r in data], kind))
    again = extract.with_row_key(spark.createDataFrame([(*r, late) for r in reversed(data)], kind))
    keys = [sorted((r.row_key, r["copy"], repr(r.a), repr(r.b)) for r in df.collect()) for df in (first, again)]
    assert keys[0] == keys[1] and len({k[:2] for k in keys[0]}) == len(data)
    assert {r.ingestion_time for r in again.collect()} == {late}


def test_an_overlapping_poll_opens_only_the_months_it_has_rows_of(spark, tmp_path):
    kind = "a int, day date, ingestion_time timestamp"
    early, late = datetime(2001, 8, 1, 6), datetime(2001, 8, 2, 6)
    days = [date(2001, 5, 3), date(2001, 6, 3), date(2001, 6, 3), date(2001, 7, 9)]
    first = spark.createDataFrame([(1, d, early) for d in days[:3]], kind)
    again = spark.createDataFrame([(1, d, late) for d in days[1:]], kind)
    mart = IncrementalMart(spark, str(tmp_path), spark.range(0))
    mart.upsert("polled", extract.with_row_key(first), extract.ROW_KEY, "day", settled=True)
    (other,) = (tmp_path / "polled").glob("*/month=2001-05/*.parquet")
    whole = other.read_bytes()
    other.write_bytes(b"none")  # not even its footer can be read
    mart.upsert("polled", extract.with_row_key(again), extract.ROW_KEY, "day", settled=True)
    other.write_bytes(whole)
    rows = mart.table("polled").collect()
    assert sorted((r.day, r["copy"]) for r in rows) == [(days[0], 1), (days[1], 1), (days[1], 2), (days[3], 1)]
    assert all(len(r.row_key) == 16 for r in rows)
