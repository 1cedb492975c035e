"""Each stage against its own operator's plain-Python rule, on the rows the stage was given."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as c
from stocklens.llm.common import settle, table
from tests.llm.rows import edge_docs, labels, no_docs
from tests.llm.test_pii import brute as brute_spans
from tests.llm.test_quality_rules import brute as brute_metrics
from tests.llm.test_simhash import brute_components, brute_print

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SMALL, "documents")
    found = {"given": docs}
    for name, stage in c.STAGES:
        docs = settle(stage(spark, docs, SMALL), name)
        found[name] = docs
    return found


def test_all_but_the_last_have_the_columns_of_documents(stages):
    for name, _ in c.STAGES[:-1]:
        assert stages[name].dtypes == stages["given"].dtypes, name


def test_quality(stages):
    kept = {r.doc_id for r in stages["quality"].collect()}
    for r in stages["given"].collect():
        words, chars, symbols, _, repeats = brute_metrics(r.text)
        if words < 50 or 100 * repeats > 50 * words or 10 * symbols > words:
            assert r.doc_id not in kept
        elif symbols == 0 and repeats == 0 and 3 * words <= chars <= 12 * words:
            assert r.doc_id in kept


def test_one_of_each_near_duplicate_group(stages):
    docs = sorted((r.doc_id, r.text) for r in stages["quality"].collect())
    groups = brute_components([brute_print(t) for _, t in docs])
    assert sorted(r.doc_id for r in stages["near_duplicates"].collect()) == sorted({docs[g][0] for g in groups})


def test_personal_data_is_gone_and_nothing_else(stages):
    before = {r.doc_id: r.text for r in stages["near_duplicates"].collect()}
    after = {r.doc_id: r for r in stages["personal_data"].collect()}
    assert before.keys() == after.keys()
    for i, text in before.items():
        assert after[i].n_chars == len(after[i].text)
        assert brute_spans(after[i].text) == []
        if not brute_spans(text):
            assert after[i].text == text


def test_mixture_repeats_or_drops_whole_rows(stages):
    before = {tuple(r) for r in stages["personal_data"].collect()}
    after = [tuple(r) for r in stages["mixture"].collect()]
    assert after and set(after) <= before
    good = table(stages["given"].sparkSession, SMALL, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    here = stages["personal_data"].join(good, "doc_id").count()
    left = stages["mixture"].join(good, "doc_id").select("doc_id").distinct().count()
    assert left > 0.9 * here


def test_tokens(stages):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in stages["mixture"].collect()}
    rows = stages["tokens"].collect()
    assert len(rows) == stages["mixture"].count()
    for r in rows:
        assert list(r.token_ids) == plain.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_run_gives_the_last_stage(spark, stages):
    out = c.run(spark, SMALL)
    cols = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, stages["tokens"].select(cols).collect()))


def test_edge_rows_and_no_rows(spark, tmp_path):
    labels(spark, [(4, 1, 0, "", ""), (3, 0, 1, "", "")]).write.parquet(f"{tmp_path}/labels.parquet")
    for given in (edge_docs(spark), no_docs(spark)):
        docs = settle(given, "given")
        for _, stage in c.STAGES[:-1]:
            docs = settle(stage(spark, docs, str(tmp_path)), "edge")
            assert docs.columns == given.columns
        assert c.STAGES[-1][1](spark, docs, str(tmp_path)).agg(F.count("*")).first()[0] == docs.count()
