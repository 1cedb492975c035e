from __future__ import annotations

import re
from collections import Counter

import pytest

from stocklens.llm import quality_rules as q
from stocklens.llm.common import table
from tests.llm.rows import EDGE, edge_docs, no_docs

SMALL = "/root/testdata/sf0.001"


def brute(text: str | None) -> tuple[int, ...]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dups, len(hit)


def test_query_against_brute_force(spark):
    rows = {r.doc_id: r for r in q.op7_host_quality_rules(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r, want = rows[d.doc_id], brute(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_clean_documents_stay_and_symbol_junk_goes(spark):
    rows = {r.doc_id: r for r in q.op7_host_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    labels = table(spark, "/root/testdata/sf0.01", "labels").where("toxic = 0").collect()
    good = [rows[r.doc_id].kept for r in labels if r.quality == 1 and rows[r.doc_id].n_words >= 50]
    bad = [rows[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / len(bad) < 0.1


def test_edge_rows(spark):
    judged = q.judge(edge_docs(spark))
    rows = judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert sorted(map(repr, (tuple(r) for r in rows))) == sorted(repr((r[0], *brute(r[1]))) for r in EDGE)
    assert q.judge(no_docs(spark)).count() == 0
    assert q.keep_documents(no_docs(spark)).count() == 0
    kept = q.keep_documents(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in judged.where("kept").collect()}


@pytest.mark.parametrize(("bad_of_b", "verdict"), [(0, "trusted"), (10, "suspect")])
def test_host_verdict_decides_on_advisory_failures(spark, bad_of_b, verdict):
    fine = " ".join(f"word{i} other{i}" for i in range(60))
    odd = " ".join(f"word{i} #{i}" for i in range(60))  # symbols only
    rows = [(i, fine, "a") for i in range(200)] + [(1000 + i, fine, "b") for i in range(60)]
    rows += [(2000 + i, odd, "b") for i in range(bad_of_b)] + [(3000, odd, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in q.judge(docs).collect()}
    assert got[1000].verdict == verdict and got[1000].kept
    assert got[3000].kept == (verdict == "trusted")


def test_rejected_host_loses_all(spark):
    odd = " ".join(f"word{i} #{i}" for i in range(60))
    fine = " ".join(f"word{i} other{i}" for i in range(60))
    rows = [(i, odd, "bad") for i in range(500)] + [(600, fine, "bad")] + [(700 + i, fine, "good") for i in range(500)]
    got = {r.doc_id: r.kept for r in q.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not got[600] and got[700]


def test_texts_are_measured_once_by_the_pass_that_filters(spark):
    kept = q.keep_documents(table(spark, SMALL, "documents"))
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
