from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from stocklens.llm import suffix_dedup as s
from stocklens.llm.common import table
from tests.llm.rows import EDGE, edge_docs, no_docs


def brute(texts: list[str | None], length: int) -> list[tuple]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def check(spark, rows, length, gram=s.GRAM):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, t string")
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in s.remove_repeats(docs, length=length, gram=gram).collect())
    assert found == [(i, *x) for i, x in enumerate(brute(rows, length))]


def test_query_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect())
    want = {i: x[:4] for (i, _), x in zip(docs, brute([t for _, t in docs], 400), strict=True)}
    rows = s.op5_bucket_refined_repeats(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages_periods_and_near_copies(spark, seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdeé", k=rnd.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rnd.randint(30, 300))) for _ in range(6)]
    rows: list[str | None] = [None, "", "a" * 399, "a" * 400, "a" * 1500, "ab" * 900, "xyz " * 150, passages[0], passages[0]]
    for _ in range(25):
        parts = [" ".join(word() for _ in range(rnd.randint(0, 60))) for _ in range(3)]
        p = rnd.choice(passages)
        a = rnd.randrange(len(p))
        parts.insert(rnd.randrange(4), p[a : a + rnd.randint(100, 1500)])
        rows.append("\n".join(parts))
    base = " ".join(word() for _ in range(400))
    for _ in range(12):  # near copies, one change each
        i = rnd.randrange(len(base))
        rows.append(base[:i] + "ZZ" + base[i + rnd.randrange(3) :])
    check(spark, rows, 400)


def test_chunks_do_not_change_the_anchors(monkeypatch):
    rnd = random.Random(4)
    text = bytes(rnd.choices(b"abc ", k=9000)) + b"q" * 3000 + bytes(rnd.choices(b"ab", k=4000))
    whole = list(s.Anchors(400, 50).runs(text))
    monkeypatch.setattr(s, "CHUNK", 700)
    parts = list(s.Anchors(400, 50).runs(text))
    assert whole == parts
    covered = [p for m, lo, hi, _ in whole for p in range(lo, hi + 1)]
    assert covered == list(range(len(text) - 399))


def test_edge_rows(spark):
    rows = s.remove_repeats(edge_docs(spark)).collect()
    want = [(r[0], *x) for r, x in zip(EDGE, brute([r[1] for r in EDGE], 400), strict=True)]
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in rows]
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    assert s.remove_repeats(no_docs(spark)).count() == 0
