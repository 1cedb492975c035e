from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from stocklens.llm import components, simhash
from stocklens.llm.common import settle, table
from tests.llm.rows import EDGE, edge_docs, no_docs

SMALL = "/root/testdata/sf0.001"


def brute_print(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], radius: int = 3) -> list[int]:
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_query_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect())
    prints = [brute_print(t) for _, t in docs]
    groups = brute_components(prints)
    want = {(docs[i][0], f"{prints[i]:016x}", docs[groups[i]][0]) for i in range(len(docs))}
    assert {tuple(r) for r in simhash.op9_simhash_components(spark, SMALL).collect()} == want


def test_edge_rows(spark):
    rows = simhash.near_duplicates(edge_docs(spark)).collect()
    assert len(rows) == len(EDGE)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert {r.component_id for r in by_id[None]} == {None}
    assert by_id[1][0].fingerprint == "0" * 16 and by_id[1][0].component_id == 1
    assert by_id[2][1].component_id == 1 and by_id[6][0].component_id == 1
    assert by_id[4][0].component_id == by_id[5][0].component_id == 4
    assert by_id[8][0].fingerprint == f"{brute_print('one two'):016x}"
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_keep_one(spark):
    kept = simhash.keep_one(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None and i != 9) == [1, 3, 4, 7, 8, 10]
    assert ids.count(None) == 1
    assert simhash.keep_one(no_docs(spark)).count() == 0


def test_masks_cover_all_pairs_within_the_radius():
    rnd = random.Random(1)
    for free in ((1 << 64) - 1, (1 << 30) - 1, 0x5555555555555555):
        masks = simhash.covering_masks(free)
        places = [i for i in range(64) if free >> i & 1]
        for _ in range(2000):
            differ = sum(1 << p for p in rnd.sample(places, 3))
            assert any(not m & differ for m in masks)
        assert all(m & ~free == 0 for m in masks)


@pytest.mark.parametrize("spread", [6, 12])
def test_large_buckets_are_split_and_lose_no_link(spark, spread):
    rnd = random.Random(spread)
    start = rnd.getrandbits(64)
    prints = {start}
    while len(prints) < 1200:  # a cloud of near fingerprints, many to a bucket
        value = start
        for _ in range(rnd.randint(1, spread)):
            value ^= 1 << rnd.randrange(64)
        prints.add(value)
    prints |= {rnd.getrandbits(64) for _ in range(300)}
    ordered = sorted(prints)
    rnd.shuffle(ordered)
    rows = [(i, simhash.signed(p)) for i, p in enumerate(ordered)]
    nodes = settle(spark.createDataFrame(rows, "doc_id long, print long"), "cloud")
    found = simhash.with_components(nodes, "doc_id").collect()
    groups = brute_components(ordered)
    assert {(r.doc_id, r.component_id) for r in found} == set(enumerate(groups))
    links = simhash.links(nodes.select("print"), 128).collect()
    assert all(((r.a ^ r.b) & simhash.FULL).bit_count() <= 64 for r in links)


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame([*chain, *star, (5, 5)], "a long, b long")
    found = dict(map(tuple, components.smallest_reachable(links).collect()))
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)}
    assert components.smallest_reachable(links.where("a < 0")).count() == 0


def test_masks_need_no_python_worker(spark):
    masks = simhash.masks_after(spark, [0, -1 << 8])
    assert [f.simpleString() for f in masks.schema] == ["before:bigint", "masks:array<bigint>"]
    assert "LocalTableScan" in masks._jdf.queryExecution().executedPlan().toString()
    for r in masks.collect():
        assert [m & simhash.FULL for m in r.masks] == [
            r.before & simhash.FULL | m for m in simhash.covering_masks(simhash.FULL & ~r.before)
        ]
