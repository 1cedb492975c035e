from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest

from stocklens.llm import html_text as h
from stocklens.llm.common import table

SMALL = "/root/testdata/sf0.01"


def test_query_against_the_pages_markup(spark):
    rows = {r.page_id: r for r in h.op3_page_differencing(spark, SMALL).collect()}
    pages = table(spark, SMALL, "pages").collect()
    assert len(rows) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [html.unescape(re.sub("<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(" ".join(b.split()) for b in blocks if b.strip() and b.split())
        r = rows[p.page_id]
        assert (r.url, r.text, r.n_chars) == (p.url, want, len(want))


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body><div class="cookie-notice">We use cookies</div><nav><ul><li>Home</li></ul></nav>
<article class="post"><header>By X</header><h1>A &amp; B</h1><p>One<b> two</b><br>three&nbsp;four
<p id=x title="a > b">Five &lt;six&gt; &#x41;<aside>Side</aside><form>Name <input name=q></form>
<div class='ad'>Buy</div><p>Last<section class="comments"><p>Nice!</p></section></article>
<footer>End</footer></body>"""


def test_markup():
    lines = h.page_lines(PAGE)
    assert [x for k, x in lines if k == h.ARTICLE] == ["A & B", "One two three four", "Five <six> A", "Last"]
    assert not [x for k, x in lines if k == h.OPEN]
    assert h.page_lines("") == [] and h.page_lines("<p") == [(h.OPEN, "<p")]
    assert h.page_lines("a < b and c > d") == [(h.OPEN, "a < b and c > d")]
    assert h.page_lines("x<!-- <p>no</p>") == [(h.OPEN, "x")]


@pytest.mark.parametrize("seed", range(5))
def test_common_lines_are_a_longest_common_subsequence(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randrange(25))] for _ in "ab")
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        places = h.common_lines(np.array(a, np.int64), np.array(b, np.int64))
        assert len(places) == best[-1][-1] and places == sorted(set(places))
        rest = iter(b)
        assert all(a[i] in rest for i in places)


def site(name: str, n: int) -> str:
    return f"<div>Top of {name}</div><p>Story {n} of {name}</p><p>More of {n}</p><div>Bottom of {name}</div>"


def test_shared_lines_of_the_nearest_page_go(spark):
    rows = [(i, f"http://{s}.org/news/{i}?x=1", site(s, i), "q") for s in "ab" for i in range(4)]
    rows += [(50, "http://a.org/news/0", site("a", 0), "q"), (60, "http://lonely.org/", site("c", 1), "q")]
    rows += [(70, None, None, "q"), (71, "not a url", "", "q"), (None, "http://a.org/news/2?x=1", site("a", 2), "q")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    found = {(r.page_id, r.url): r for r in h.extract(pages).collect()}
    assert len(found) == len(rows)
    for s in "ab":
        for i in range(4):
            assert found[i, f"http://{s}.org/news/{i}?x=1"].text == f"Story {i} of {s}\nMore of {i}"
    assert found[50, "http://a.org/news/0"].text == "Story 0 of a\nMore of 0"
    assert found[60, "http://lonely.org/"].n_shared == 0
    assert found[60, "http://lonely.org/"].text.startswith("Top of c")
    assert found[70, None].text == "" and found[71, "not a url"].n_chars == 0
    assert h.extract(pages.where("page_id < 0")).count() == 0


def test_long_page(spark):
    body = "".join(f"<p>line {i}</p>" for i in range(3000))
    pages = spark.createDataFrame(
        [(1, "http://a.org/1", body), (2, "http://a.org/2", body + "<p>own</p>")], "page_id long, url string, html string"
    )
    found = {r.page_id: r.text for r in h.extract(pages).collect()}
    assert found == {1: "", 2: "own"}
