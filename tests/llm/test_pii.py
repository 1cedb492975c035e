from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from stocklens.llm import pii
from stocklens.llm.common import table
from tests.llm.rows import EDGE, edge_docs, no_docs

SMALL = "/root/testdata/sf0.01"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text: str | None) -> list[tuple[int, int, int]]:
    spans = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), k, m.end()))
    return sorted(spans)


def joined(spans) -> str:
    return ",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b in spans)


def test_query_against_brute_force(spark):
    rows = {r.doc_id: r for r in pii.op6_information_sanitised(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r, spans = rows[d.doc_id], brute(d.text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in spans) for i in range(4))
        assert r.base_sha256 == hashlib.sha256(joined(spans).encode()).hexdigest()
        if not spans:
            assert r.spans == ""


TRICKY = [
    "a@b.c_x@y.z and x@@y.zz a.b@c-d.e.f@g.h @a.b c@d",
    "1.2.3.4.5.6.7.8 256.1.1.1 00001.2.3.0255 1.2.3 1..2.3.4 9.9.9.9.",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111111 4111  1111 5 6",
    "+1 (555) 123-4567 +12 +1.2 +1-234-567-8901-2345-6789 ++49 30 123456 78 +1(",
    "é😀 mail@x.yz 😀é 10.0.0.1 +44 20 7946 0958x",
    "@" * 300 + "1." * 300 + "+" * 100 + "a" * 3000,
]


def test_patterns_and_positions_on_tricky_texts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    for r in docs.select("text", pii.span_text(pii.base_spans(F.col("text"))).alias("got")).collect():
        assert r.got == joined(brute(r.text)), r.text[:80]


def corpus():
    """A project name that goes with one address, and a common word near it."""
    rows = [(i, f"Common words and more {i} here. Note the Common talk goes on.") for i in range(40)]
    rows += [(100 + i, f"Note {i}: Falconproject is led by jane.roe@corp.example.com and Common sense. End {i}.") for i in range(4)]
    return rows


def test_disclosing_terms_go_and_others_stay(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    texts = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert texts[100] == "Note 0:  is led by [EMAIL] and Common sense. End 0."
    assert texts[5] == corpus()[5][1]
    loose = {r.doc_id: r.text for r in pii.sanitise(docs, remove_at=1.1, generalise_at=0.9).collect()}
    assert loose[100].startswith("Note 0: [NAME] is led by [EMAIL]")
    told = pii.disclosing_terms(docs).collect()
    assert len(told) == 4 and all(r.removed == ["Falconproject"] and r.generalised == [] for r in told)


def test_copies_are_one_text(spark):
    rows = [(i, "Plain text here.") for i in range(20)] + [(50 + i, "Falconproject by a@b.com now") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.disclosing_terms(docs).count() == 0


def test_edge_rows(spark):
    clean = pii.sanitise(edge_docs(spark))
    assert clean.columns == edge_docs(spark).columns
    rows = sorted((repr(r.doc_id), repr(r.text)) for r in clean.collect())
    want = []
    for i, text, *_ in EDGE:
        out, at = "", 0
        for a, k, b in brute(text):
            if a >= at:
                out += text[at:a] + pii.TAGS[k]
            at = max(at, b)
        want.append((repr(i), repr(text if text is None else out + text[at:])))
    assert rows == sorted(want)
    assert pii.sanitise(no_docs(spark)).count() == 0
