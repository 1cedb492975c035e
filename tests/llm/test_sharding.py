from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stocklens.llm import sharding
from stocklens.llm.common import table
from tests.llm.rows import EDGE, edge_docs, no_docs

SMALL = "/root/testdata/sf0.01"


def test_query(spark):
    rows = sharding.op2_feistel_shards(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    assert len(rows) == len(texts)
    shards = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
        shards[r.shard].append(r.slot)
    assert sorted(shards) == list(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    sizes = [len(s) for s in shards.values()]
    assert max(sizes) - min(sizes) <= 1
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.number)]
    assert order == sorted(order)
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.op2_feistel_shards(spark, SMALL).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in rows}


@pytest.mark.parametrize("total", [1, 2, 3, 5, 40, 41, 1000, 4099, 250_000])
def test_permutation_and_its_inverse(spark, total):
    rows = spark.range(total).select("id", sharding.permuted(F.col("id"), total).alias("p"))
    found = rows.withColumn("back", sharding.permuted(F.col("p"), total, inverse=True))
    checked = found.agg(F.count_distinct("p"), F.min("p"), F.max("p"), F.sum((F.col("back") != F.col("id")).cast("int")))
    assert tuple(checked.first()) == (total, 0, total - 1, 0)


def test_number_follows_from_shard_and_slot(spark):
    rows = sharding.shard(edge_docs(spark), shards=3)
    back = rows.select("number", sharding.number_at(F.col("shard"), F.col("slot"), len(EDGE), 3).alias("n")).collect()
    assert all(r.number == r.n for r in back)


def test_it_is_a_shuffle(spark):
    rows = spark.range(10_000).select("id", sharding.permuted(F.col("id"), 10_000).alias("p"))
    near = rows.where("abs(id - p) < 100").count()
    assert 100 < near < 350  # about 200 by chance
    assert abs(rows.corr("id", "p")) < 0.05


def test_edge_rows(spark):
    rows = sharding.shard(edge_docs(spark)).collect()
    assert len(rows) == len(EDGE)
    assert sorted(r.number for r in rows) == list(range(len(EDGE)))
    assert [(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2)] == [(16, 0)] * 3
    assert len({(r.shard, r.slot) for r in rows}) == len(EDGE)
    assert sharding.shard(no_docs(spark)).count() == 0
