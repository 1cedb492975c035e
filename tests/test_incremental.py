from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stocklens.operators.derive import build_snapshot
from stocklens.plans import manifest as m
from stocklens.plans.incremental import MOVES, SNAPSHOT, IncrementalMart
from stocklens.plans.layout import with_month
from stocklens.plans.pipeline import PublishedMart, StoredTradeTables, published_mart

TODAY = date(2001, 8, 1)
DAYS = 30
MOVE = "event_date date, event_time timestamp, warehouse_id string, sku_id string, qty_change int"


def moves(spark, *rows):
    return spark.createDataFrame(
        [(d, datetime.combine(d, datetime.min.time()), w, s, q) for d, w, s, q in rows], MOVE
    )


def ago(n):
    return TODAY - timedelta(days=n)


FIRST = [
    (ago(200), "W1", "S1", 50), (ago(40), "W1", "S1", -5), (ago(20), "W1", "S1", -10), (ago(9), "W2", "S2", 7),
    (ago(28), "W2", "S1", 4), (ago(31), "W2", "S3", 3),
]
SECOND = [(ago(3), "W1", "S1", -20), (ago(2), "W3", "S1", 9), (ago(1), "W2", "S2", -9), (ago(0), "W2", "S2", 1)]
LATE = [(ago(15), "W1", "S1", 2), (ago(300), "W1", "S1", 1), (ago(29), "W4", "S2", 6), (ago(100), "W5", "S1", 8)]


@pytest.fixture()
def costs(spark):
    return spark.createDataFrame([("S1", 2.0), ("S2", 3.0)], "sku_id string, unit_cost double").withColumn(
        "unit_cost", F.col("unit_cost").cast("decimal(18,2)")
    )


def rebuilt(costs, tx, as_of):
    return build_snapshot(tx, costs, as_of, DAYS, None, opening="history")


def same(a, b):
    columns = sorted(a.columns)
    assert sorted(map(repr, a.select(columns).collect())) == sorted(map(repr, b.select(columns).collect()))


def test_refreshes_equal_a_rebuild(spark, tmp_path, costs):
    mart = IncrementalMart(spark, str(tmp_path), costs, DAYS)
    landed = []
    for rows, day in ((FIRST, ago(8)), (SECOND, TODAY), (LATE, TODAY), ([], TODAY + timedelta(days=1)), (SECOND[:1], TODAY + timedelta(days=12))):
        landed += rows
        before = mart.held(SNAPSHOT)
        mart.refresh(moves(spark, *rows), day)
        now = mart.held(SNAPSHOT)
        everything = moves(spark, *landed)
        want = rebuilt(costs, everything, day)
        same(mart.table(SNAPSHOT, want.schema), want)
        assert now.rows == want.count() and now.last == day.isoformat()
        assert mart.held(MOVES).rows == len(landed)
        same(mart.table(MOVES, with_month(everything, "event_date").schema).drop("month"), everything)
        if rows is SECOND:  # days before the first new movement keep their files
            old = (ago(20)).isoformat()
            assert set(before.parts[old]) <= set(now.parts[old]) and now.parts[ago(3).isoformat()] != before.parts.get(ago(3).isoformat())
            assert all(v >= (TODAY - timedelta(days=DAYS)).isoformat() for v in now.parts)


def test_another_application_opens_the_tables_and_old_files_go(spark, tmp_path, costs):
    IncrementalMart(spark, str(tmp_path), costs, DAYS).refresh(moves(spark, *FIRST), ago(8))
    again = IncrementalMart(spark.newSession(), str(tmp_path), costs, DAYS)
    again.refresh(moves(spark, *SECOND), TODAY)
    again.refresh(moves(spark, *LATE), TODAY)
    same(again.table(SNAPSHOT, rebuilt(costs, moves(spark), TODAY).schema), rebuilt(costs, moves(spark, *FIRST, *SECOND, *LATE), TODAY))
    held = again.held(SNAPSHOT)
    kept = {str(p.relative_to(tmp_path / SNAPSHOT)) for p in (tmp_path / SNAPSHOT).glob("v=*/snapshot_date=*")}
    assert kept == set(held.folders()) | {f for f in held.before if "=" in f and "/" in f}


def test_a_refresh_that_stopped_half_way(spark, tmp_path, costs, monkeypatch):
    mart = IncrementalMart(spark, str(tmp_path), costs, DAYS)
    mart.refresh(moves(spark, *FIRST), ago(8))
    with monkeypatch.context() as broken:
        broken.setattr(IncrementalMart, "_built", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            mart.refresh(moves(spark, *SECOND), TODAY)
    assert mart.held(SNAPSHOT).last == ago(8).isoformat()
    mart.refresh(moves(spark, *LATE), TODAY)
    want = rebuilt(costs, moves(spark, *FIRST, *SECOND, *LATE), TODAY)
    same(mart.table(SNAPSHOT, want.schema), want)


def test_upsert_rewrites_touched_months_only(spark, tmp_path):
    kind = "id int, day date, qty int, ingestion_time timestamp"
    at = datetime(2001, 8, 1, 6, 0, 0, 250)
    rows = [(1, date(2001, 6, 3), 1, at), (2, date(2001, 7, 3), 2, at), (3, date(2001, 7, 9), 3, at)]
    mart = IncrementalMart(spark, str(tmp_path), spark.range(0))
    mart.upsert("lines", spark.createDataFrame(rows, kind), ["id"], "day")
    before = mart.held("lines")
    later = at + timedelta(hours=2)
    for _ in range(2):  # what lands twice is stored once
        mart.upsert("lines", spark.createDataFrame([(3, date(2001, 7, 9), 30, later), (4, date(2001, 8, 1), 4, later)], kind), ["id"], "day")
    held = mart.held("lines")
    found = mart.table("lines", with_month(spark.createDataFrame(rows, kind), "day").schema)
    assert sorted((r.id, r.qty) for r in found.collect()) == [(1, 1), (2, 2), (3, 30), (4, 4)]
    assert held.parts["2001-06"] == before.parts["2001-06"] and held.parts["2001-07"] != before.parts["2001-07"]
    assert (held.rows, held.first, held.last) == (4, "2001-06-03", "2001-08-01")
    assert spark.sql(f"SELECT timestamp_micros({held.landed}) t").first().t == later


def test_a_row_that_moves_leaves_its_old_month(spark, tmp_path):
    kind = "id int, day date, qty int, ingestion_time timestamp"
    at = datetime(2001, 8, 1, 6)
    rows = [(1, date(2001, 5, 3), 1, at), (2, date(2001, 6, 3), 2, at), (3, date(2001, 6, 9), 3, at), (4, date(2001, 7, 1), 4, at)]
    mart = IncrementalMart(spark, str(tmp_path), spark.range(0))
    mart.upsert("lines", spark.createDataFrame(rows, kind), ["id"], "day")
    before = mart.held("lines")
    mart.upsert("lines", spark.createDataFrame([(2, date(2001, 7, 2), 20, at), (4, date(2001, 8, 5), 40, at)], kind), ["id"], "day")
    held = mart.held("lines")
    schema = with_month(spark.createDataFrame(rows, kind), "day").schema
    found = sorted((r.id, r.month, r.qty) for r in mart.table("lines", schema).collect())
    assert found == [(1, "2001-05", 1), (2, "2001-07", 20), (3, "2001-06", 3), (4, "2001-08", 40)]
    assert held.parts["2001-05"] == before.parts["2001-05"] and held.rows == 4


def test_appends_are_compacted(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "day date, n int"
    schema = with_month(spark.createDataFrame([], kind), "day").schema
    for n in range(m.COMPACT + 2):
        rows = with_month(spark.createDataFrame([(date(2001, 7, 1 + n), n)], kind), "day")
        m.publish(rows, path, "month", "day") if n == 0 else m.append(rows, path, schema, "day")
    held = m.read_manifest(spark, path)
    assert len(held.parts["2001-07"]) < m.COMPACT and held.rows == m.COMPACT + 2
    assert sorted(r.n for r in m.read_table(spark, path, schema).collect()) == list(range(m.COMPACT + 2))
    assert m.read_table(spark, path, schema, ["2001-06"]).count() == 0


def test_a_second_application_reads_the_published_mart(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    mart = published_mart(spark, folder)
    assert mart.supplier.count() == mart.manifest("supplier").rows
    second = PublishedMart(StoredTradeTables(spark, folder, mart.root), mart.root, mart.state)

    def no_write(*args, **options):
        raise AssertionError("written again")

    monkeypatch.setattr("stocklens.plans.pipeline.swap_overwrite", no_write)
    assert second.supplier.count() == mart.supplier.count()
    assert second.manifests["supplier"].version == mart.manifests["supplier"].version
    changed = PublishedMart(StoredTradeTables(spark, folder, mart.root), mart.root, "another state")
    with pytest.raises(AssertionError):
        changed.supplier  # noqa: B018
