"""Messages of snapshot runs, and how often a message is decoded."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocklens.functions import kept_if
from stocklens.sources import extract, topics
from tests.small import LANDED, days_ago


def runs(spark):
    data = [
        ('A"1\\', days_ago(3), days_ago(0), "W1", 5, 1.25),
        (None, days_ago(9), days_ago(8), None, None, None),
        ("B", days_ago(2), days_ago(2), None, 7, None),
        ("C", None, days_ago(1), "W1", 7, 1.0),
    ]
    return spark.createDataFrame(data, "sku_id string, valid_from date, valid_to date, warehouse_id string, on_hand_qty int, unit_cost double")


def test_messages_of_runs_are_those_of_their_days(spark):
    last = ["on_hand_qty", "sku_id", "valid_from", "valid_to"]
    for wired in (runs(spark), runs(spark).select("valid_from", "valid_to", "sku_id"), runs(spark).select(*last)):
        got = topics.run_messages(extract.wire_runs(wired), days_ago(2), days_ago(1))
        want = topics.to_messages(extract.wire_snapshot(wired, days_ago(2), days_ago(1)))
        assert sorted(r.value for r in got.collect()) == sorted(r.value for r in want.collect())


def test_a_message_is_decoded_once(spark):
    sent = runs(spark).withColumns({"created_at": F.lit(LANDED), "inventory_value": F.lit(3.5)})
    messages = topics.run_messages(extract.wire_runs(sent), days_ago(9), days_ago(0))
    broken = spark.createDataFrame([('{"snapshot_date": "2001-07-01", "sku',), (None,), ("7",)], "value string")
    late = spark.createDataFrame([('{"snapshot_date": "soon", "sku_id": "D", "created_at": "2001-08-01"}',)], "value string")
    landed = topics.land(messages.unionAll(broken).unionAll(late), "snapshot_topic", LANDED)
    assert sorted(r.sku_id or "" for r in landed.collect()) == ["", "", 'A"1\\', 'A"1\\', 'A"1\\', 'A"1\\', "B"]
    for df in (topics.land(messages, "snapshot_topic", LANDED), topics.rejects(messages, "snapshot_topic")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("RLIKE") <= 2


def test_kept_rows_are_those_of_a_filter(spark):
    df = spark.range(6).select(F.when(F.col("id") > 1, F.col("id") % 3).alias("n"))
    kept = kept_if(df.withColumn("twice", F.col("n") * 2), F.col("twice") > 0)
    assert kept.columns == ["n", "twice"] and sorted(map(tuple, kept.collect())) == [(1, 2), (2, 4), (2, 4)]
