"""Snapshot issues against plain Python, and one shuffle of the snapshot's rows."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

from stocklens.operators import planning

FIRST = date(2001, 1, 1)
ROW = "snapshot_date date, warehouse_id string, sku_id string"


def day(n):
    return None if n is None else FIRST + timedelta(days=n)


def expected(rows, sites, goods, span):
    """Issues as the contract has them: a row for each, a pair's keys as often as the other dimension has them."""
    held = {}
    for n, w, s in rows:
        if n is not None and 0 <= n < span:
            held.setdefault((w, s), Counter())[n] += 1
    found = []
    for (w, s), days in held.items():
        gap = []
        for n in range(span + 1):
            if n < span and n not in days:
                gap.append(n)
            elif gap:
                found.append((w, s, "gap", day(gap[0]), day(gap[-1]), len(gap)))
                gap = []
        found += [(w, s, "duplicate", day(n), day(n), k - 1) for n, k in days.items() if k > 1]
        known = sites.count(w) if w is not None else 0
        named = [c for k, c in goods if k == s and s is not None and c]
        ends = day(min(days)), day(max(days)), sum(days.values())
        found += [(w, s, "no warehouse", *ends)] * (0 if known else max(1, len(named)))
        found += [(w, s, "no category", *ends)] * (0 if named else max(1, known))
    return sorted(found, key=str)


def test_issues_equal_plain_python(spark):
    rng = random.Random(5)
    sites = ["W1", "W2", "W2", None]
    goods = [("A", "x"), ("B", ""), ("C", None), ("D", "y"), ("D", "y"), (None, "z")]
    for span in (1, 2, 63, 64, 65, 121, 130):
        rows = [(n, w, s) for w in ("W1", "W3") for s in "AD" for n in range(span)]  # one row on each day
        rows += [(n, "W2", "D") for n in range(span) if n != span // 2]
        rows += [(n, "W1", "C") for n in range(64, span)]  # nothing in the first chunk
        rows += [(n, "W2", "C") for n in range(span) for _ in range(2)]
        rows += [(span // 2, "W2", "E")] * 70_000  # more than 16 bits hold
        for _ in range(300):
            rows.append((rng.choice([None, -1, span, rng.randrange(span)]), rng.choice(["W1", "W2", "W9", None]), rng.choice(["A", "B", None])))
        snapshot = spark.createDataFrame([(day(n), w, s) for n, w, s in rows], ROW)
        site = spark.createDataFrame([(w,) for w in sites], "warehouse_id string")
        good = spark.createDataFrame(goods, "sku_id string, category string")
        found = planning.snapshot_issues(snapshot, site, good, FIRST, day(span - 1))
        assert found.columns == [*planning.PAIR, "issue", "first_day", "last_day", "row_count"]
        assert sorted(map(tuple, found.collect()), key=str) == expected(rows, sites, goods, span)


def test_rows_are_shuffled_once(spark):
    snapshot = spark.range(1000).selectExpr("date_add(DATE '2001-01-01', int(id % 9)) AS snapshot_date", "'W1' AS warehouse_id", "string(id) AS sku_id")
    site, good = snapshot.select("warehouse_id").distinct(), snapshot.selectExpr("sku_id", "'x' AS category")
    found = planning.snapshot_issues(snapshot, site, good, FIRST, day(8))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("REPARTITION_BY_COL") == 1
    assert "ENSURE_REQUIREMENTS" not in plan[plan.index("REPARTITION_BY_COL") :].split("Project")[0]
