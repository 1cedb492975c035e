from __future__ import annotations

import zlib

import numpy as np

from stocklens.llm import quality_classifier as c
from stocklens.llm.common import table
from tests.llm.rows import EDGE, edge_docs, labels, no_docs

SMALL = "/root/testdata/sf0.01"


def test_query_and_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in c.op4_subword_quality(spark, SMALL).collect()}
    assert len(rows) == table(spark, SMALL, "documents").count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(rows[r.doc_id].predicted, r.quality) for r in table(spark, SMALL, "labels").collect() if rows[r.doc_id].held_out]
    assert len(held) > 50
    assert sum(p == y for p, y in held) / len(held) > 0.97


def test_words_hash_alike_wherever_they_stand():
    alone = set(c.buckets_of("hello").tolist())
    assert alone <= set(c.buckets_of("a longer text with hello inside it").tolist())
    pairs = c.buckets_of("x x x x x x")
    assert np.bincount(pairs).max() >= 5  # repeated neighbours are one pair
    assert len(c.buckets_of("")) == 0 and len(c.buckets_of(" \n")) == 0


def test_edge_rows(spark):
    given = labels(spark, [(4, 1, 0, "", ""), (9, 1, 0, "", ""), (3, 0, 0, "", ""), (8, 0, 0, "", ""), (None, 1, 0, "", ""), (99, 1, 0, "", ""), (7, None, 0, "", ""), (10, 5, 0, "", "")])
    rows = c.classify(edge_docs(spark), given).collect()
    assert len(rows) == len(EDGE)
    assert all(r.held_out for r in rows if r.doc_id is None)
    empty = {r.score for r in rows if r.doc_id in (1, 2)}
    assert len(empty) == 1
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1
    assert c.classify(no_docs(spark), given).count() == 0
    assert {r.score for r in c.classify(edge_docs(spark), labels(spark, [])).collect()} == {0.5}
