"""A domain that few labels have keeps its words."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stocklens.llm import mixing
from tests.llm.rows import labels

MARKS = [f"vile{i}" for i in range(10)]


def texts(total: int, toxic: int):
    """Documents of equal shape; a toxic one holds three of ten words that no other has."""
    rnd = random.Random(total)
    for i in range(total):
        words = [f"w{rnd.randrange(400)}" for _ in range(60)]
        if i < toxic:
            words[5:8] = rnd.sample(MARKS, 3)
        yield i, " ".join(words)


@pytest.mark.parametrize("total, toxic", [(2000, 20), (2000, 60), (300, 12)])
def test_words_of_a_rare_domain_are_kept(spark, total, toxic):
    docs = spark.createDataFrame(list(texts(total, toxic)), "doc_id long, text string")
    given = labels(spark, [(i, 1, int(i < toxic), "", "") for i in range(total)])
    targets = mixing.Targets()
    model = mixing.fit(docs, given, mixing.domain_of_labels(), targets, "doc_id", "text")
    assert len(set(MARKS) & set(model.vocabulary)) >= 5
    found = mixing.features(docs, [F.col("doc_id")], "text")
    rows = model.posteriors(found, ["doc_id"]).collect()
    column = f"p_{targets.domains.index('toxic')}"
    held = [r[column] for r in rows if r.doc_id < toxic]
    assert sum(x > 0.5 for x in held) > 0.9 * toxic
    assert sum(r[column] > 0.5 for r in rows if r.doc_id >= toxic) < 0.01 * total
