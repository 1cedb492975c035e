from __future__ import annotations

from pyspark.sql import functions as F

from stocklens.operators import quality
from tests.small import rows


def test_reconcile_counts(spark):
    a, b = spark.range(5), spark.range(3)
    out = rows(quality.reconcile_counts({"x": a, "y": b}, {"x": a, "y": b}, {"x": b, "y": b}))
    assert [(r["table"], r["source_rows"], r["mart_rows"], r["difference"]) for r in out] == [
        ("x", 5, 3, 2), ("y", 3, 3, 0)]


def test_rule_reports(spark):
    df = spark.createDataFrame([(1, 5), (1, 0), (2, None), (None, 3)], "k int, q int")
    broken = rows(quality.row_violations(df, "t", {"positive": F.col("q") > 0}))
    assert broken == [{"table": "t", "rule": "positive", "violations": 2}]
    parents = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.missing_parents(df, "t", "k", parents, "id", "exists"))[0]["violations"] == 2
    assert rows(quality.repeated_keys(df, "t", ["k"], "unique"))[0]["violations"] == 1
