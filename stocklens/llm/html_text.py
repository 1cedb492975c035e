"""Main text of web pages by nearest-URL page differencing.

A page is cut into text lines, one for each block of its markup. The different pages of a host (pages
with the very same lines count once, at their first path) are put in the order of URL path; the
nearer of the two neighbours in that order (longer common path, then the page before) is the
page's partner. The lines of both are aligned by a longest common subsequence, and lines that the page
shares with its partner are deleted if they are the host's frame: if SHARE of the host's different pages
hold them, three pages at least (both, on a host of two). What a site repeats from page to page is its
frame, what a few near copies share is not. Shared prose (two lines or more in a row of PROSE_WORDS words
and more that end as sentences do) stays, so a host of near copies keeps its articles.

Differencing alone cannot give the contract's text: a frame's advert or footer can differ on each
page, and passages that articles share are articles all the same. So markup has a say as well:
lines inside ``article`` or ``main`` are never deleted; if a page has such an element, no other
lines are its text; and lines inside elements that name themselves menus, headers, footers, sidebars,
notices, adverts, forms or comments go, shared or not. Only a whole class, id or role, without a number at its
end, is such a name: "has-sidebar" or "comments-open" is none. ``html``, ``body``, ``article``, ``main``, ``h1``
and what holds a ``main`` are never frame by name; nor is what holds an ``article``, unless the page has an
article elsewhere (comments and teasers are often articles of their own). A ``form`` or ``fieldset`` around
them counts like a name. Headings in an article's own ``header`` are text. An advert inside a line is cut out
of it, and the line goes on. Of several articles, if one alone holds an ``h1`` and is the longest, it is the
page's and the others are teasers.

Lines travel as hashes for the alignment, and equal pages as one. Pages are numbered in URL order and
meet their neighbours inside blocks of BLOCK numbers that overlap by a page on each side: one shuffle, and
a host with a third of all pages is no hot key. The frame of a host has at most 1 / SHARE times the lines
of a mean page of it.

Defined results: a null or empty page has the empty text; a null url has no host and pairs with other
such pages; a page without neighbours keeps its lines, as far as markup lets them; repeated rows get
equal results; unclosed tags end with their parent; a very long page is read once, in time that its length
sets, and aligned in memory that its lines set; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_right
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, table, text_column
from .sharding import numbered

#: Elements whose content is no text of the page, elements of the frame, elements
#: inside a line of text, elements without an end, whole names (class, id or role) of a frame's part,
#: elements that no name makes one, frame elements that may go round a whole page, and headings.
NO_TEXT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "title", "textarea"}
FRAME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset"}
MAIN = {"article", "main"}
AROUND_PAGES = {"form", "fieldset"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FRAME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar",
    "aside", "complementary", "contentinfo", "cookie", "cookies", "consent", "notice", "notices", "alert", "popup",
    "modal", "newsletter", "subscribe", "share", "sharing", "social", "related", "comment", "comments", "reply",
    "replies", "respond", "disqus", "login", "search", "form", "pagination", "widget",
    "cookie-notice", "cookie-banner", "cookie-bar", "cookie-consent", "site-header", "site-footer", "page-footer",
    "main-nav", "main-menu", "main-navigation", "site-nav", "site-navigation", "nav-menu", "top-menu", "top-nav",
    "left-sidebar", "right-sidebar", "sidebar-left", "sidebar-right", "widget-area", "ad-banner", "ad-container",
    "ad-slot", "ad-unit", "share-buttons", "social-links", "social-share", "related-articles", "related-posts",
    "comment-form", "comment-list", "comments-area", "login-form", "search-form", "newsletter-signup", "skip-link",
}
NEVER_BY_NAME = {"html", "body", "h1"} | MAIN
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*+)>|<[!?][^<>]*+>",
    re.S,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NUMBERED = re.compile(r"-?[0-9]+\Z")
SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)]*\Z")
OPEN, ARTICLE, BOILER = 0, 1, 2
SHARE = 0.3
PROSE_WORDS = 12
BLOCK = 1024


def names_frame(attributes: str) -> bool:
    for m in NAMED.finditer(attributes):
        value = (m[1] or m[2] or m[3] or "").lower()
        if any(NUMBERED.sub("", name) in FRAME_WORDS for name in value.replace("_", "-").split()):
            return True
    return False


def page_lines(html: str) -> list[tuple[int, str]]:
    """(kind, text) of each line of a page, in page order."""
    lines, around = walked(html, {})
    if "main" in around.values():
        lines, around = walked(html, {at: held for at, held in around.items() if held == "main"})
    if around and not any(kind == ARTICLE for kind, _ in lines):
        lines, _ = walked(html, around)
    return lines


class End:
    """Places after the end tags of an element, found once for each page and element."""

    def __init__(self, html: str):
        self.html = html
        self.found: dict[str, list[int]] = {}

    def after(self, name: str, at: int) -> int | None:
        if name not in self.found:
            ends = re.compile(rf"</{re.escape(name)}\b[^<>]*+>", re.I)
            self.found[name] = [m.end() for m in ends.finditer(self.html)]
        ends = self.found[name]
        i = bisect_right(ends, at)
        return ends[i] if i < len(ends) else None


class Element(NamedTuple):
    """An open element: the kind of its lines, where it starts, how many around it (itself included) are frame by
    name, the outermost article, whether it is in an article's own header, and what the line around it held."""

    name: str
    kind: int = OPEN
    place: int = -1
    by_name: int = 0
    article: int = 0
    heading: bool = False
    held: list[str] | None = None


def walked(html: str, around: dict[int, str]) -> tuple[list[tuple[int, str]], dict[int, str]]:
    """The lines, where no name makes the elements that start at ``around`` a part of the frame; and,
    if a name hid a ``main`` or ``article``, the places of the elements around it and which it was."""
    lines: list[tuple[int, str]] = []
    owners: list[int] = []  # the outermost article of each line, 0 for none
    titled: set[int] = set()  # articles with an h1
    page = Element("")
    stack: list[Element] = [page]
    opened: Counter[str] = Counter()
    found = dict(around)
    hidden = False
    run: list[str] = []
    end = End(html)

    def end_line() -> None:
        text = " ".join(entities.unescape("".join(run)).split())
        run.clear()
        if text:
            lines.append((stack[-1].kind, text))
            owners.append(stack[-1].article)

    def start(element: Element) -> None:
        stack.append(element)
        opened[element.name] += 1

    def close() -> None:
        if stack[-1].held is not None:  # a frame inside a line: the line goes on after it
            end_line()
            run[:] = stack[-1].held
        elif stack[-1].name not in INLINE:
            end_line()
        opened[stack.pop().name] -= 1

    at, size = 0, len(html)
    while at < size:
        m = TAG.search(html, at)
        run.append(html[at : m.start()] if m else html[at:])
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if opened[name]:
                while stack[-1].name != name:
                    close()
                close()
            elif name not in INLINE:
                end_line()
            continue
        attributes = m[3] or m[6] or ""
        closed = attributes.rstrip().endswith("/")
        if name in NO_TEXT:
            if not (closed and name in ("svg", "math")):
                at = end.after(name, at) or (size if name in ("script", "style") else at)
            continue
        top = stack[-1]
        if name in INLINE:
            if name == "br":
                run.append(" ")
            if name in VOID or closed:
                continue
            if top.kind == BOILER:  # so that its end tag is not taken for another's
                start(top._replace(name=name, held=None))
            elif m.start() not in around and names_frame(attributes):
                start(top._replace(name=name, kind=BOILER, place=m.start(), by_name=top.by_name + 1, heading=False, held=[*run, " "]))
                run.clear()
            continue
        end_line()
        if top.name == "p":  # a block ends a paragraph that was left open
            close()
            top = stack[-1]
        if name in VOID:
            continue
        if name in MAIN and top.by_name:
            hidden = True
            for outer in reversed(stack):
                if found.get(outer.place) in (name, "main"):  # so have those around it
                    break
                if outer.place >= 0:
                    found[outer.place] = name
        new = top._replace(name=name, place=m.start(), held=None)
        spared = m.start() in around
        if top.kind != BOILER:
            if name in AROUND_PAGES and not spared:
                new = new._replace(kind=BOILER, by_name=top.by_name + 1)
            elif name in FRAME - AROUND_PAGES:
                new = new._replace(kind=BOILER, heading=name == "header" and top.kind == ARTICLE)
            elif name not in NEVER_BY_NAME and not spared and names_frame(attributes):
                new = new._replace(kind=BOILER, by_name=top.by_name + 1)
            elif name in MAIN:
                new = new._replace(kind=ARTICLE)
            if name == "article" and not top.article:
                new = new._replace(article=m.start() + 1)
        elif top.heading and name in HEADINGS:
            new = new._replace(kind=ARTICLE)
        elif name in FRAME or names_frame(attributes):
            new = new._replace(heading=False)
        if name == "h1" and new.kind == ARTICLE:
            titled.add(new.article)
        start(new)
    end_line()
    while stack[-1] is not page:
        close()
    end_line()
    return without_teasers(lines, owners, titled), found if hidden else {}


def without_teasers(lines: list[tuple[int, str]], owners: list[int], titled: set[int]) -> list[tuple[int, str]]:
    sizes: Counter[int] = Counter()
    for (kind, text), owner in zip(lines, owners, strict=True):
        if kind == ARTICLE and owner:
            sizes[owner] += len(text)
    if len(titled) != 1 or len(sizes) < 2:
        return lines
    (own,) = titled
    if not own or any(n >= sizes[own] for a, n in sizes.items() if a != own):
        return lines
    return [(BOILER if k == ARTICLE and a not in (0, own) else k, x) for (k, x), a in zip(lines, owners, strict=True)]


def prose_places(lines: list[tuple[int, str]]) -> list[int]:
    """Places of lines that read as prose and have such a line beside them."""
    reads = [k == OPEN and len(x.split()) >= PROSE_WORDS and SENTENCE.search(x) is not None for k, x in lines]
    beside = zip(reads, [False, *reads], [*reads[1:], False], strict=False)
    return [i for i, (own, before, after) in enumerate(beside) if own and (before or after)]


PAGE = T.StructType(
    [
        T.StructField("kinds", T.ArrayType(T.IntegerType())),
        T.StructField("lines", T.ArrayType(T.StringType())),
        T.StructField("prose", T.ArrayType(T.IntegerType())),
        T.StructField("hashes", T.ArrayType(T.LongType())),
        T.StructField("digest", T.StringType()),
    ]
)


def line_hash(kind: int, line: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind == ARTICLE:d}{line}".encode(), digest_size=8).digest(), "little", signed=True)


@F.arrow_udf(PAGE)
def parsed(pages: pa.Array) -> pa.Array:
    """Lines of the pages. Lines that markup keeps out of the text are hashed, their text stays behind."""
    out = []
    for page in pages.to_pylist():
        lines = page_lines(page)
        hashes = [line_hash(*x) for x in lines]
        wanted = ARTICLE if any(k == ARTICLE for k, _ in lines) else OPEN
        out.append(
            {
                "kinds": [k for k, _ in lines],
                "lines": [x if k == wanted else None for k, x in lines],
                "prose": prose_places(lines),
                "hashes": hashes,
                "digest": hashlib.sha256(np.array(hashes, "<i8").tobytes()).hexdigest(),
            }
        )
    kinds = pa.list_(pa.int32())
    return pa.array(out, pa.struct([("kinds", kinds), ("lines", pa.list_(pa.string())), ("prose", kinds), ("hashes", pa.list_(pa.int64())), ("digest", pa.string())]))


def lcs_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def common_lines(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places in ``a`` of a longest common subsequence, in space that is linear (Hirschberg)."""
    mine, theirs = np.isin(a, b), np.isin(b, a)
    places, a, b = np.flatnonzero(mine), a[mine], b[theirs]

    def walk(lo: int, hi: int, left: int, right: int) -> list[int]:
        while lo < hi and left < right and a[lo] == b[left]:
            found.append(lo)
            lo, left = lo + 1, left + 1
        if lo == hi or left == right:
            return []
        if hi - lo == 1:
            if (b[left:right] == a[lo]).any():
                found.append(lo)
            return []
        mid = (lo + hi) // 2
        before = lcs_lengths(a[lo:mid], b[left:right])
        after = lcs_lengths(a[mid:hi][::-1], b[left:right][::-1])[::-1]
        cut = left + int(np.argmax(before + after))
        walk(lo, mid, left, cut)
        walk(mid, hi, cut, right)
        return []

    found: list[int] = []
    walk(0, len(a), 0, len(b))
    return [int(places[i]) for i in found]


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def shared_places(own: pa.Array, partner: pa.Array, frame: pa.Array) -> pa.Array:
    """Places of the lines that are shared with the partner and belong to the host's frame."""
    rows = []
    for x, y, z in zip(own.to_pylist(), partner.to_pylist(), frame.to_pylist(), strict=True):
        held = set(z or ())
        places = common_lines(np.array(x, np.int64), np.array(y, np.int64)) if y is not None and held else []
        rows.append([i for i in places if x[i] in held])
    return pa.array(rows, pa.list_(pa.int32()))


def common_start(a, b):
    """How many path segments two paths have in common at their start."""
    same = F.zip_with(F.split(a, "/"), F.split(b, "/"), lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1)


def host_frames(ordered: DataFrame) -> DataFrame:
    """For each block of pages, a map from its hosts to the lines that SHARE of the host's pages hold."""
    pages = ordered.groupBy("host").agg(F.count("*").alias("pages"))
    enough = F.least("pages", F.greatest(F.lit(3), F.ceil(F.col("pages") * SHARE)))
    held = (
        ordered.select("host", F.explode(F.array_distinct("hashes")).alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("n")).where("n > 1")
    )
    frames = held.join(pages, "host").where(F.col("n") >= enough).groupBy("host").agg(F.collect_list("line").alias("frame"))
    return (
        ordered.select("host", "block").distinct().join(frames, "host")
        .groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("host", "frame"))).alias("frames"))
    )


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars and n_shared (lines deleted by differencing) of every row."""
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).alias("page_id"),
        F.col(url).alias("url"),
        F.lower(F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(address, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"),
        parsed(text_column(pages, html)).alias("p"),
    )
    page = ["host", "digest"]
    distinct = (
        rows.select("host", "path", F.col("p.digest").alias("digest"), F.col("p.hashes").alias("hashes"))
        .groupBy(page).agg(F.min("path").alias("path"), F.any_value("hashes").alias("hashes"))
    )
    ordered, _ = numbered(distinct, ["host", "path", "digest"])
    ordered = settle(ordered, "ordered")
    own_block = F.floor(F.col("number") / BLOCK)
    first_of, last_of = F.col("number") % BLOCK == 0, F.col("number") % BLOCK == BLOCK - 1
    blocks = F.array_compact(F.array(own_block, F.when(first_of, own_block - 1), F.when(last_of, own_block + 1)))
    in_order = Window.partitionBy("block").orderBy("number")
    side = F.struct("host", "path", "hashes")
    near = (
        ordered.withColumn("block", F.explode(blocks))
        .withColumns({"before": F.lag(side).over(in_order), "after": F.lead(side).over(in_order)})
        .where(F.col("block") == own_block)
    )
    near = near.join(host_frames(ordered.withColumn("block", own_block)), "block", "left")

    def worth(name: str):  # -1: no partner
        fits = F.col(f"{name}.host") == F.col("host")
        return F.when(fits, common_start(F.col("path"), F.col(f"{name}.path"))).otherwise(-1)

    best = F.greatest(worth("before"), worth("after"))
    partner = F.when(best < 0, None).when(worth("before") == best, F.col("before.hashes")).otherwise(F.col("after.hashes"))
    frame = F.try_element_at("frames", F.col("host"))
    shared = settle(near.select(*page, shared_places("hashes", partner, frame).alias("shared")), "shared")
    found = rows.withColumn("digest", F.col("p.digest")).join(shared, page)
    has_main = F.array_contains("p.kinds", ARTICLE)
    kept = F.filter(
        F.col("p.lines"),
        lambda line, i: F.when(has_main, F.get("p.kinds", i) == ARTICLE).otherwise(
            (F.get("p.kinds", i) == OPEN) & (~F.array_contains("shared", i) | F.array_contains("p.prose", i))
        ),
    )
    gone = F.size(F.filter("shared", lambda i: (F.get("p.kinds", i) != ARTICLE) & ~F.array_contains("p.prose", i)))
    return found.select("page_id", "url", F.array_join(kept, "\n").alias("text"), gone.cast("long").alias("n_shared")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared"
    )


def op3_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
