"""Copies and near copies beside a page: its frame goes, its own lines stay."""

from __future__ import annotations

from stocklens.llm import html_text as h
from tests.llm.test_html_text import site


def test_a_copy_between_two_copies_loses_its_frame(spark):
    rows = [(i, f"http://a.org/n/{i}", site("a", 0)) for i in range(3)] + [(i, f"http://a.org/n/{i}", site("a", i)) for i in range(3, 7)]
    found = {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"Story {max(i, 2) if i > 2 else 0} of a\nMore of {i if i > 2 else 0}" for i in range(7)}


def test_a_near_copy_takes_no_paragraphs(spark):
    for near in (0, 3, 6):  # at the start, in the middle, at the end of the host's pages
        pages = [site("a", i) for i in range(7)]
        pages.insert(near + 1, site("a", near) + "<p>Late addition</p>")
        rows = [(i, f"http://a.org/n/{i}", p) for i, p in enumerate(pages)]
        found = {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        story = f"Story {near} of a\nMore of {near}"
        assert found[near] == story and found[near + 1] == story + "\nLate addition"
