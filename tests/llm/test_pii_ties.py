"""Disclosing terms against plain Python, and the three ties: near, part of an address, kind."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import regex

from stocklens.llm import pii
from stocklens.llm.common import table
from tests.llm.test_pii import SMALL, brute

L = r"[\p{L}\p{M}\p{N}]"
WORD = regex.compile(rf"(?<!{L})\p{{L}}{L}+")
NAMES = regex.compile(rf"(?<!{L})\p{{Lu}}{L}*(?: \p{{Lu}}{L}*)+(?!{L})")


def window(text: str, a: int, b: int) -> set[str]:
    before, after = text[max(a - pii.REACH, 0) : a], text[b : b + pii.REACH]
    if a > pii.REACH:
        before = regex.sub(r"^[^ \t\n\x0b\f\r]+", "", before)
    if len(text) > b + pii.REACH:
        after = regex.sub(r"[^ \t\n\x0b\f\r]+\Z", "", after)
    return set(WORD.findall(f"{before} {after}"))


def plain(texts: list[str], remove_at=0.9, generalise_at=0.6, min_texts=2, least_bits=20.0) -> dict[str, dict[str, bool]]:
    """For each text its terms; True: removed."""
    total, n_t, n_e, n_et = len(texts), Counter(), Counter(), Counter()
    part, held = set(), defaultdict(set)
    for text in texts:
        spans, rest, at = brute(text), "", 0
        for a, _, b in spans:
            rest += text[at:a] + " " * (b - max(a, at))
            at = max(at, b)
        rest += text[at:]
        words = set(WORD.findall(rest))
        n_t.update(set(WORD.findall(text)))
        ties = set()
        for a, k, b in spans:
            datum = (k, text[a:b].lower())
            held[text] |= {(datum, None), (k, None)}
            near = window(rest, a, b)
            ties |= {(k, w) for w in near} | {(datum, w) for w in near if regex.match(rf"\p{{Lu}}{L}{{3}}", w)}
            if k == 0:
                pieces = {p for p in regex.split("[^a-z0-9]+", datum[1].rpartition(".")[0]) if len(p) > 2 and regex.search("[a-z]", p)}
                own = {w for w in words if w.lower() in pieces}
                for name in NAMES.findall(rest):
                    run = name.split(" ")
                    for x, y in zip(run, run[1:], strict=False):
                        own |= ({y} if x.lower() in pieces else set()) | ({x} if y.lower() in pieces else set())
                ties |= {(datum, w) for w in own}
                part |= {(datum, w) for w in own}
        n_e.update({e for e, w in held[text]})
        held[text] = ties
        n_et.update(ties)
    grade = {}
    for (e, w), n in n_et.items():
        ic = math.log2(total / n_e[e])
        if ic <= 0 or w not in n_t:
            continue
        pmi = math.log2(n * total / (n_e[e] * n_t[w]))
        if isinstance(e, int):
            own, rate = n / n_t[w], n_e[e] / total
            bits = n * math.log2(own / rate) + ((n_t[w] - n) * math.log2((1 - own) / (1 - rate)) if own < 1 else 0)
            if pmi < 1 or bits < least_bits:
                continue
        elif n < min_texts and (e, w) not in part:
            continue
        if pmi / ic >= generalise_at:
            grade[e, w] = pmi / ic >= remove_at
    out = defaultdict(dict)
    for text in texts:
        for tie in held[text] & grade.keys():
            out[text][tie[1]] = out[text].get(tie[1], False) or grade[tie]
    return out


def compare(docs):
    want = plain(sorted({r.text or "" for r in docs.collect()}))
    got = {bytes(r.text_id): {w: gone for gone in (True, False) for w in (r.generalised, r.removed)[gone]}
           for r in pii.disclosing_terms(docs).collect()}
    assert got == {hashlib.md5(t.encode()).digest(): terms for t, terms in want.items() if terms}
    return want


def test_whole_table_against_plain_python(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    assert sum(map(len, compare(docs).values())) > 5


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


FILL = [f"Contact us at any time {i}, or call soon, as the firm sends info and mail to all." for i in range(60)]


def test_one_text_is_enough_for_parts_of_an_address(spark):
    docs = frame(spark, [
        *FILL,
        "Contact Johannes Brandt at j.brandt@firm.example or call soon.",
        "Ask zoltan, not Zoltanov, or info: info.zoltan@mail.example.org; ZOLTAN knows Quincy",
        "Ürün Şen Anna: anna.b@x.org",
    ])
    texts = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert texts[60] == "Contact   at [EMAIL] or call soon."
    assert texts[61] == "Ask , not Zoltanov, or info: [EMAIL];  knows Quincy"
    assert texts[62] == "Ürün  : [EMAIL]"  # beside the part only, one text shows no tie for the third
    assert [texts[i] for i in range(60)] == FILL
    compare(docs)


def test_a_term_of_any_case_that_goes_with_a_kind(spark):
    docs = frame(spark, [
        *FILL,
        *[f"Nr {i}: durchwahl +49 30 1234{i:04d} and the firm sends mail" for i in range(8)],
        *[f"Nr {i}: rufen +49 30 9876{i:04d} and the firm sends mail. " + "far " * 40 + "weitab" for i in range(2)],
    ])
    texts = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert texts[60] == " 0:  [PHONE] and the firm sends mail"  # "Nr" and "durchwahl": near phones only
    assert texts[68].startswith(" 0: rufen [PHONE] and")  # two texts are not evidence enough
    assert texts[68].endswith("weitab")
    assert [texts[i] for i in range(60)] == FILL
    compare(docs)


def test_a_kind_in_nearly_all_texts_takes_no_words(spark):
    docs = frame(spark, ["No address here"] + [f"List {i} words of a.{i}@list.example.org" for i in range(200)])
    assert {r.text for r in pii.sanitise(docs).where("doc_id > 0").collect()} == {f"List {i} words of [EMAIL]" for i in range(200)}
    compare(docs)
