from __future__ import annotations

import hashlib
import re

import pytest

from stocklens.llm import decontamination as d
from stocklens.llm.common import table
from tests.llm.rows import EDGE, LONG, PLAIN, edge_docs, no_docs

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text, items):
    """Hit words and items of a text, window by window."""
    words = WORDS.findall(lower(text))
    hit, found = set(), set()
    for item, item_text in items:
        own = WORDS.findall(lower(item_text))
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add("" if item is None else str(item))
    return words, hit, found


def digest(found):
    return hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def check(rows, docs, items):
    """Rows of ``decontaminate`` with their texts against brute force, spans included."""
    got = sorted(
        repr((r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), [tuple(s) for s in r.spans])) for r in rows
    )
    want = []
    for key, text in docs:
        words, hit, found = brute(text, items)
        places = [m.span() for m in WORDS.finditer(lower(text))]
        starts = sorted(n for n in hit if n - 1 not in hit)
        ends = sorted(n for n in hit if n + 1 not in hit)
        spans = [(places[a][0], places[b][1]) for a, b in zip(starts, ends, strict=True)]
        want.append(repr((key, len(words), len(hit), sorted(found), spans)))
    assert got == sorted(want)


@pytest.mark.parametrize("block_rows", [d.BLOCK_ROWS, 700])
def test_whole_tables_against_brute_force(spark, block_rows):
    docs, items = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    found = d.decontaminate(docs, items, block_rows=block_rows)
    rows = found.withColumn("n_hit", d.n_hit(found.hit_words)).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert any(r.n_hit for r in rows) and not all(r.n_hit for r in rows)


ITEMS = [
    (1, "Alpha0 beta0; GAMMA alpha1 beta1 gamma alpha2 beta2 gamma alpha3 beta3 gamma"),
    (1, "Alpha0 beta0; GAMMA alpha1 beta1 gamma alpha2 beta2 gamma alpha3 beta3 gamma"),
    (10, "one--two"),
    (2, "Ohne Übung ß keine"),
    (3, None),
    (4, " ,;. "),
    (None, "gamma alpha5 beta5"),
    (5, " ".join(LONG.split()[20_000:20_040])),
    (6, "beta5 gamma"),
]


@pytest.mark.parametrize("block_rows", [d.BLOCK_ROWS, 3])
def test_edge_rows(spark, block_rows):
    more = [(20, "x ONE,two? ohne übung ß keine", None, None), (21, "Ohne Übung ß keine 😀 one two", "", "")]
    docs = edge_docs(spark)
    extra = spark.createDataFrame([(*r, None, *([None] * 15)) for r in more], docs.schema)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS words", "2 AS h")
    found = d.decontaminate(docs.unionAll(extra), items, block_rows=block_rows)
    rows = found.withColumn("n_hit", d.n_hit(found.hit_words)).collect()
    check(rows, [r[:2] for r in EDGE + more], ITEMS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[21]["items"] == ["10", "2"] and by_id[20]["items"] == ["10"]  # É, Ü are not lower-cased
    assert by_id[4]["items"] == ["", "1", "6"] and by_id[3]["items"] == ["5"]


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.decontaminate(no_docs(spark), items).count() == 0
    clean = d.decontaminate(edge_docs(spark), items.limit(0))
    assert clean.where("size(hit_words) > 0 or size(items) > 0").count() == 0
    assert clean.count() == len(EDGE)
    kept = d.keep_clean(edge_docs(spark), items)
    assert kept.columns == edge_docs(spark).columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 6, 7, 10}


def test_questions_and_answers_of_an_item(spark):
    items = spark.createDataFrame([(7, "Who was it", "the third man")], "item_id long, q string, a string")
    docs = spark.createDataFrame([(1, "who was it? THE third man"), (2, "was it the third")], "doc_id long, text string")
    rows = {r.doc_id: r for r in d.decontaminate(docs, items, item_texts=("q", "a")).collect()}
    assert rows[1].hit_words == [0, 5] and rows[1]["items"] == ["7"] and rows[2].hit_words == []


def test_runs_of_long_texts(monkeypatch):
    """Windows across the borders of runs are found, whatever the runs' size."""
    items = [(" ".join(PLAIN.split()[i : i + 10]).encode(), str(i)) for i in (0, 7, 60, 61, 120)]
    items += [(b"gamma", "x"), (b"beta3 gamma", "y")]
    text = (PLAIN + " ; " + "y" * 300 + " " + PLAIN).encode()
    want = d.Automaton(items).scan(text)
    assert want[1] and len(want[2]) == 7
    for size in (1, 7, 50, 333):
        monkeypatch.setattr(d, "RUN_BYTES", size)
        assert d.Automaton(items).scan(text) == want
