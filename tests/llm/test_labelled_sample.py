"""The labelled samples: labels without a document take no place, repeated keys and long texts keep the bounds."""

from __future__ import annotations

import numpy as np

from stocklens.llm import mixing
from stocklens.llm import quality_classifier as c

DOCS = "doc_id long, text string"


def told_apart(spark, n=40):
    """Documents of two kinds, and their labels."""
    rows = [(i, " ".join((["clear", "prose"] if i % 2 else ["junk", "spam"]) + [f"w{i}"]) + " of text") for i in range(n)]
    return rows, [(i, i % 2, 0) for i, _ in rows]


def apart(rows):
    good, bad = ([r.score for r in rows if r.doc_id % 2 == side] for side in (1, 0))
    return min(good) > max(bad)


def test_labels_without_a_document_take_no_place(spark, monkeypatch):
    monkeypatch.setattr(c, "SAMPLE", 30)
    monkeypatch.setattr(mixing, "SAMPLE", 30)
    rows, marks = told_apart(spark)
    labels = spark.createDataFrame([*marks, *((1000 + i, i % 3 % 2, 0) for i in range(4000))], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, DOCS)
    assert apart(c.classify(docs, labels).collect())
    seen = {r.doc_id: r.p_0 for r in mixing.mixed(docs, labels).collect()}
    assert min(p for i, p in seen.items() if i % 2) > max(p for i, p in seen.items() if not i % 2)


def test_one_key_many_times(spark, monkeypatch):
    monkeypatch.setattr(c, "SAMPLE", 50)
    rows, marks = told_apart(spark)
    key = next(i for i in range(1, 40, 2) if spark.range(1).select(c.fold(c.F.lit(i))).first()[0])
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    same = spark.createDataFrame([*rows, *[rows[key]] * 10_000], DOCS)
    once = {r.doc_id: r.score for r in c.classify(spark.createDataFrame(rows, DOCS), labels).collect()}
    given = {r.doc_id: r.score for r in c.classify(same, labels).distinct().collect()}
    assert given == once  # the same model
    different = spark.createDataFrame([*rows, *((key, f"clear prose number {i}") for i in range(10_000))], DOCS)
    assert c.classify(different, labels).count() == 10_040


def test_bytes_of_the_sample_are_bounded(spark, monkeypatch):
    rows, marks = told_apart(spark)
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    values, _ = c.fit(docs, labels, "doc_id", "text", "quality")
    monkeypatch.setattr(c, "SAMPLE_BYTES", 0)
    nothing, bias = c.fit(docs, labels, "doc_id", "text", "quality")
    assert np.abs(values).max() > 0 == np.abs(nothing).max() and bias == 0


def test_toxic_documents_are_read_less(spark):
    rows = mixing.op1_soft_mixture(spark, "/root/testdata/sf0.01")
    labelled = rows.join(mixing.table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    mean = labelled.where("toxic = 1").agg(mixing.F.avg("rate")).first()[0]
    assert mean < 0.6
