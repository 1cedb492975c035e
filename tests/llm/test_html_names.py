"""Class names of ordinary themes: they hide no article, and frames still go."""

from __future__ import annotations

import pytest

from stocklens.llm import html_text as h

BODY = "<h1 class='page-header'>Title</h1><p>Text.</p>"


@pytest.mark.parametrize(
    "before, after",
    [
        ("<body class='single has-sidebar'><article>", "</article></body>"),
        ("<div id=page class='comments-open'><article>", "</article></div>"),
        ("<article class='post share-on'>", "</article>"),
        ("<html class=search><body class='widget sidebar'><main class=form>", "</main></body></html>"),
        ("<div class=widget><div class=search><article>", "</article></div></div>"),
        ("<div class=form><div class=share><div><main>", "</main></div></div></div><div class=comments><article>No</article></div>"),
    ],
)
def test_names_hide_no_article(before, after):
    lines = h.page_lines(before + BODY + after)
    assert [x for k, x in lines if k == h.ARTICLE] == ["Title", "Text."]


def test_frames_by_name_still_go():
    page = f"<article>{BODY}</article><section class=comments><article>Nice</article></section><div class='x site_footer'>End</div>"
    lines = h.page_lines(page)
    assert [x for k, x in lines if k == h.ARTICLE] == ["Title", "Text."]
    assert [x for k, x in lines if k == h.BOILER] == ["Nice", "End"]
    assert [k for k, _ in h.page_lines("<aside><article>Teaser</article></aside>")] == [h.BOILER]


def test_deep_pages_take_linear_time():
    deep = "<div class=search>" * 3000 + "<article>a</article>" * 3000
    assert [k for k, _ in h.page_lines(deep)] == [h.ARTICLE] * 3000
