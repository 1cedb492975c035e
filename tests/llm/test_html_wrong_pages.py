"""Pages whose markup once hid text or let frames through, hosts of near copies, and time on broken markup."""

from __future__ import annotations

import time

import pytest

from stocklens.llm import html_text as h

P = "<p>One.</p>"


def article(page: str) -> list[str]:
    return [x for k, x in h.page_lines(page) if k == h.ARTICLE]


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<form id=aspnetForm><article>{P}</article></form>", ["One."]),
        (f"<form><fieldset><main>{P}</main></fieldset></form>", ["One."]),
        (f"<article>{P}<form>Name</form></article><form><article>Reply</article></form>", ["One."]),
        (f"<article><header><h1>Title</h1><p>By X</p><nav><h2>Menu</h2></nav></header>{P}</article>", ["Title", "One."]),
        ("<article><p>one</p><svg class=i/><p>two</p><svg></svg><p>three</p></article>", ["one", "two", "three"]),
        ("<article><p>x <span class='ad'>Buy</span> y</p></article>", ["x y"]),
        ("<article><p>x<span class=ad>Buy <span>now</span> or <b>never</b></span>y</p></article>", ["x y"]),
        ("<article><p>x <a class=share>Share</p><p>y</p></article>", ["x", "y"]),
        ("<article><p>x <span class=ad>Buy<div>more</div>now</span> y</p></article>", ["x y"]),
        (f"<article><h1>Title</h1>{P}</article><article><h2>Other</h2></article>", ["Title", "One."]),
        (f"<article><h2>A</h2>{P}</article><article><h2>B</h2>{P}</article>", ["A", "One.", "B", "One."]),
        (f"<article>{P}<div class='comment-17'>Nice</div><div id=comment_3>No</div></article>", ["One."]),
        ("<main><object><p>no</p></object><p>yes</p><object>", ["yes"]),
    ],
)
def test_article(page, want):
    assert article(page) == want


PROSE = [f"Paragraph {i} of the story goes on for a good many words, as the paragraphs of stories do." for i in range(8)]


@pytest.mark.parametrize("copies, others", [(2, 0), (3, 0), (3, 12), (2, 1)])
def test_near_copies_keep_their_paragraphs(spark, copies, others):
    frame = "<div>Home</div>{}<div>Imprint of the site</div>"
    story = "".join(f"<p>{x}</p>" for x in PROSE)
    rows = [(i, f"http://a.org/s/{i}", frame.format(f"{story}<p>Edition {i}</p>")) for i in range(copies)]
    rows += [(10 + i, f"http://a.org/t/{i}", frame.format(f"<p>Note {i}</p>")) for i in range(others)]
    found = {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: "\n".join([*PROSE, f"Edition {i}"]) for i in range(copies)} | {10 + i: f"Note {i}" for i in range(others)}
    assert found == want


def test_neighbours_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK", 3)
    rows = [(i, f"http://{s}.org/n/{i:02}", f"<div>Top {s}</div><p>Story {i}</p>") for s in "ab" for i in range(10 * (s == "b"), 10 + 7 * (s == "b"))]
    found = {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"Story {i}" for i in range(17)}


@pytest.mark.parametrize("part, after", [("<div>", "</section>"), ("<object>", ""), ("<svg>", ""), ("<span class=ad>", "</p>"), ("<form>", "</b>")])
def test_broken_markup_takes_linear_time(part, after):
    def took(n: int) -> float:
        page = part * n + after * n
        best = float("inf")
        for _ in range(3):
            started = time.perf_counter()
            h.page_lines(page)
            best = min(best, time.perf_counter() - started)
        return best

    took(1000)
    assert took(16_000) < 16 * max(took(2_000), 0.002)
