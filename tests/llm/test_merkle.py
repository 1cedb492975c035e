from __future__ import annotations

import hashlib
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from stocklens.llm import merkle as m
from stocklens.llm.common import table
from tests.llm.rows import edge_docs, no_docs

SMALL = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    values = ["" if row[c] is None else str(row[c]) for c in FIELDS]
    return h("".join("-" if row[c] is None else f"{len(v.encode())}:{v}" for c, v in zip(FIELDS, values, strict=True)))


def climb(nodes, fan):
    """The root of nodes and for each the digests left and right of it, level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(places):
            first = at // fan * fan
            paths[k].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fan])))
            places[k] = at // fan
        nodes = [h("".join(nodes[i : i + fan])) for i in range(0, len(nodes), fan)]
    return nodes[0] if nodes else None, paths


def brute(rows, fan):
    order = sorted(rows, key=lambda r: ((r["lang"] is not None, (r["lang"] or "").encode()), (r["doc_id"] is not None, r["doc_id"] or 0), plain_leaf(r)))
    groups = [list(g) for _, g in groupby(order, key=lambda r: r["lang"])]
    trees = [climb([plain_leaf(r) for r in g], fan) for g in groups]
    root, over = climb([t[0] for t in trees], fan)
    return [
        (r["doc_id"], plain_leaf(r), subroot, root, path + above)
        for g, (subroot, paths), above in zip(groups, trees, over, strict=True)
        for r, path in zip(g, paths, strict=True)
    ]


def compare(docs, **options):
    fan = options.get("fan", m.FAN)
    got = [
        (r.doc_id, r.leaf, r.subroot, r.root, [*zip(r.left, r.right, strict=True)])
        for r in m.manifest(docs, **options).collect()
    ]
    want = brute([r.asDict() for r in docs.select(*FIELDS).collect()], fan)
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("fan, levels", [(8, 4), (8, 1), (3, 2), (2, 1)])
def test_whole_table_against_plain_python(spark, fan, levels):
    """Also with blocks so small that several rounds of block roots are appended."""
    compare(table(spark, SMALL, "documents"), fan=fan, levels=levels)


@pytest.mark.parametrize("levels", [1, 4])
def test_edge_rows(spark, levels):
    compare(edge_docs(spark), fan=2, levels=levels)
    same = spark.range(70).select(F.lit(5).alias("doc_id"), F.lit(None).cast("string").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("a").alias("text"))
    compare(same, fan=8, levels=levels)
    compare(same.limit(1), levels=levels)
    assert m.manifest(no_docs(spark), levels=levels).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 63, 64, 65, 300, 512, 513])
def test_appender(size):
    nodes = [h(str(random.Random(size).random() + i)) for i in range(size)]
    appender = m.Appender()
    witnesses = [appender.append(n) for n in nodes]
    root = appender.close(None)
    assert (root, witnesses) == climb(nodes, 8)
    aligned = m.Appender()
    for n in nodes:
        aligned.append(n)
    for _ in range(4):  # one of several blocks goes up all its levels
        nodes = [h("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    assert aligned.close(4) == nodes[0]


def test_open_subtrees_hold_partial_witnesses():
    appender = m.Appender(4)
    for n in "abcdef":
        appender.append(n)
    closed, run = appender.open[1], appender.open[0]
    assert [s.digest for s in closed] == [h("abcd")] and [len(w) for w in closed[0].witnesses] == [1] * 4
    assert [(s.left, s.right) for s in run] == [("", "f"), ("e", "")]


def test_tampering_is_found(spark):
    docs = table(spark, SMALL, "documents")
    rows = m.op12_incremental_witnesses(spark, SMALL).collect()
    changed = {
        r.doc_id for r in docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("c")).collect()
        if r.c % 3 == 0 and r.text and any("A" <= x <= "Z" for x in r.text)
    }
    assert {r.doc_id for r in rows if not r.verified} == changed and 0 < len(changed) < len(rows)
    assert all((r.folded_root == r.root) == r.verified for r in rows)
