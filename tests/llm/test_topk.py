from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from check import compare
from stocklens.llm import topk


def test_query_against_its_sql(spark):
    name = "op8_tiled_top_k"
    outcome, _ = compare(spark, "/root/testdata/sf0.01", name, contract.queries()[name], contract.oracle_sql()[name])
    assert outcome.startswith("equal") and "TYPES" not in outcome, outcome


def brute(rows, k):
    forms = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            forms.setdefault(i, []).append([math.floor(64 * x) for x in v])
    out = set()
    for q in (i for i in forms if i % 20 == 0):
        scores = [
            (-max(sum(x * y for x, y in zip(a, b, strict=False)) for a in forms[q] for b in forms[c]), c)
            for c in forms if c != q
        ]
        out |= {(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.mark.parametrize(("tile", "shard"), [(2, 3), (512, 4096)])
def test_against_brute_force(spark, tile, shard):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 8], "a") for i in range(130)]  # many ties
    rows += [(i, list(v), "b") for i, v, _ in rows[:40]]  # repeated rows
    rows += [(7, [1.0, 0.0, 0.0, 0.0], ""), (20, [0.5] * 6, ""), (40, [], ""), (None, [1.0], ""), (60, None, "")]
    rows += [(200, [math.nan, 1.0], ""), (220, [1.0, math.inf], ""), (240, [1.0, None], "")]
    rows += [(260, [1e6, -1e6, 3e5, 0.1], ""), (261, [1e6, 1e6, 1e6, 1e6], "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    found = topk.top_k(frame, F.col("vec_id") % 20 == 0, k=5, tile=tile, shard=shard).collect()
    assert {tuple(r) for r in found} == brute(rows, 5)


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 64 * 128)]
    alone = frame.where("vec_id = 0")
    assert topk.top_k(alone, F.col("vec_id") % 20 == 0).count() == 0
    assert topk.top_k(frame.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0
    assert topk.top_k(frame.where("vec_id = 1"), F.col("vec_id") % 20 == 0).count() == 0


def test_products_are_exact_or_fail():
    big = np.array([[1 << 30, 3]])
    assert topk.products(big, big).tolist() == [[(1 << 60) + 9]]
    with pytest.raises(OverflowError):
        topk.products(np.array([[1 << 40]]), np.array([[1 << 40]]))


def test_copies_of_the_tiles_are_not_broadcast(spark):
    rows = spark.range(600).select(F.col("id").alias("vec_id"), F.array(F.col("id") / 64, F.lit(0.5)).alias("embedding"))
    found = topk.top_k(rows, F.col("vec_id") % 20 == 0, k=3, tile=4, shard=50)
    assert found.count() == 30 * 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize(("value", "size"), [(127, 1), (-128, 1), (128, 2), (-129, 2), (1 << 15, 4), (-(1 << 31), 4), (1 << 31, 8)])
def test_blocks_take_the_bytes_they_need(value, size):
    assert topk.item_size(np.array([[0, value]])) == size
    assert topk.item_size(np.zeros((0, 3), np.int64)) == 1


def test_wide_vectors_and_large_values(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELLS", 12)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-(1 << n), 1 << n, 4)]) for i, n in enumerate([0, 3, 9, 20] * 12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(frame, F.col("vec_id") % 20 == 0, k=4).collect()
    assert {tuple(r) for r in found} == brute(rows, 4)
