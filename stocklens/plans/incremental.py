"""A mart at a fixed path that is brought up to date with what has landed since.

Movements are appended to their months. The daily snapshot is rebuilt only from the first day that
changes: from the balance at the end of the day before, which is the stored opening balance of the window
plus the movements of the window's days in between, so history is not read again. When the window
moves on, the opening balance takes over the days that leave it. Fact lines and counts are upserted by key
in the months that changed rows have. Every table is versioned (``plans.manifest``).

A refresh that stops half-way leaves each table at its old or its new version; the snapshot's mark names
the movement version it holds, so the next refresh rebuilds the whole window if they differ.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stocklens.operators.derive import PAIR, clipped, closing_balances, fill_days, stock_runs
from stocklens.plans import manifest as m
from stocklens.plans.layout import BLOCK_DAYS, TASK_RUNS, placed_days, with_month
from stocklens.sources import extract

MOVES, SNAPSHOT, OPENING = "fact_inventory_movement", "fact_inventory_snapshot_daily", "opening_balance"
RUNS = "snapshot_runs"
BALANCES = StructType(
    [StructField(c, StringType()) for c in PAIR] + [StructField("balance", LongType())]
)
MONTHS_DAYS = 62  # days of a block in a table by month
MIN_DAYS = 7  # shortest span that the snapshot builder takes


class IncrementalMart:
    """``moves`` are clean movements (event_time, event_date, warehouse_id, sku_id, qty_change, ...)."""

    def __init__(
        self, spark: SparkSession, root: str, costs: DataFrame, days: int = 120,
        shelf_rule: dict[str, Column] | None = None,
    ):
        self.spark, self.root, self.costs, self.days, self.rule = spark, root, costs, days, shelf_rule

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def held(self, name: str) -> m.Manifest | None:
        return m.read_manifest(self.spark, self.path(name))

    def table(self, name: str, schema: StructType | None = None) -> DataFrame:
        return m.read_table(self.spark, self.path(name), schema)

    # --- movements and snapshot ------------------------------------------------------------------

    def refresh(self, moves: DataFrame, as_of: date) -> None:
        """Add movements that landed since the last refresh, and bring the snapshot to ``as_of``.

        ``moves`` is read several times: pass a written table.
        """
        schema = with_month(moves, "event_date").schema
        sort = ["event_date", *PAIR]
        first_time = self.held(MOVES) is None
        known = None if first_time else self.held(MOVES)
        if first_time:
            m.publish(with_month(moves, "event_date"), self.path(MOVES), "month", "event_date", sort)
        else:
            new_pairs = moves.select(*PAIR).distinct().join(self._pairs(schema), PAIR, "left_anti")
            m.publish(new_pairs, self.path("new_pairs"))  # before the movements are added
            m.append(with_month(moves, "event_date"), self.path(MOVES), schema, "event_date", sort)
        stored = self.held(MOVES)
        first = as_of - timedelta(days=self.days)
        snapshot = self.held(SNAPSHOT)
        whole = first_time or snapshot is None or snapshot.mark != self._mark(known, snapshot)
        everything = self.table(MOVES, schema)
        opening = self._opening(everything, moves, first, rebuild=whole)
        mark = f"{stored.version} {as_of.isoformat()}"
        if whole or not snapshot.rows:
            rows = self._placed(self._built(everything, opening, first, as_of))
            m.publish(rows, self.path(SNAPSHOT), "snapshot_date", "snapshot_date", PAIR, mark=mark, placed=True)
            return
        oldest = moves.agg(F.min("event_date")).first()[0]
        day = min(snapshot.last_day + timedelta(days=1), as_of - timedelta(days=MIN_DAYS), oldest or as_of)
        day = max(day, first)
        runs = self._built(everything, opening, first, as_of, day)
        schema_of_days = fill_days(runs).schema
        days = [(day + timedelta(days=n)).isoformat() for n in range((as_of - day).days + 1)]
        gone = [v for v in snapshot.parts if v < first.isoformat()]
        if day > first:
            # A pair that has never moved before has empty days ahead of its first movement.
            pairs = m.read_table(self.spark, self.path("new_pairs"), moves.select(*PAIR).schema)
            ahead = self._built(everything.join(pairs, PAIR, "left_semi"), None, first, as_of)
            ahead = self._placed(clipped(ahead, last=day - timedelta(days=1)))
            m.append(ahead, self.path(SNAPSHOT), schema_of_days, "snapshot_date", PAIR, placed=True)
        rows = self._placed(runs)
        m.replace_values(rows, self.path(SNAPSHOT), schema_of_days, days, "snapshot_date", PAIR, gone, mark, placed=True)

    def _placed(self, runs: DataFrame, *blocks: int) -> DataFrame:
        """The days of runs, ready to be written. Runs are written first, since the layout reads them three times."""
        held = m.publish(runs, self.path(RUNS))
        return placed_days(m.read_table(self.spark, self.path(RUNS), runs.schema, manifest=held), *blocks)

    @staticmethod
    def _mark(moves: m.Manifest | None, snapshot: m.Manifest) -> str | None:
        """The mark a snapshot has that holds all movements stored so far."""
        return f"{moves.version} {snapshot.last}" if moves else None

    def _pairs(self, schema: StructType) -> DataFrame:
        """Pairs that have moved: those with an opening balance, and those of the days since."""
        held = self.held(OPENING)
        moved = self.table(MOVES, schema)
        if held is None:
            return moved.select(*PAIR).distinct()
        since = _since(moved, date.fromisoformat(held.mark)).select(*PAIR)
        return self.table(OPENING, BALANCES).select(*PAIR).unionAll(since).distinct()

    def _opening(self, everything: DataFrame, moves: DataFrame, first: date, rebuild: bool) -> DataFrame:
        """Balances at the end of the day before the window, brought forward and with late movements."""
        path, last = self.path(OPENING), first - timedelta(days=1)
        held = m.read_manifest(self.spark, path)
        if held is None or rebuild or held.mark > last.isoformat():
            balances = closing_balances(_until(everything, last), last)
        else:
            since = date.fromisoformat(held.mark)
            old = m.read_table(self.spark, path, BALANCES, manifest=held)
            late = moves.filter(F.col("event_date") <= F.lit(since))
            left = everything.filter(F.col("event_date").between(F.lit(since + timedelta(days=1)), F.lit(last)))
            left = left.filter(F.col("month").between(since.strftime("%Y-%m"), last.strftime("%Y-%m")))
            both = late.select(*PAIR, "event_time", "qty_change").unionByName(left.select(*PAIR, "event_time", "qty_change"))
            balances = closing_balances(both, last, earlier=old)
        m.publish(balances.select(*PAIR, F.col("balance").cast("bigint")), path, mark=last.isoformat())
        return m.read_table(self.spark, path, BALANCES)

    def _built(
        self, everything: DataFrame, opening: DataFrame | None, first: date, as_of: date, day: date | None = None
    ) -> DataFrame:
        """Runs of the snapshot from ``day`` (the window's first by default) to ``as_of``."""
        start = day or first
        window = _since(everything, first)
        if start > first:
            before = window.filter(F.col("event_date") < F.lit(start))
            before = before.filter(F.col("month") <= start.strftime("%Y-%m"))
            opening = closing_balances(before, start - timedelta(days=1), earlier=opening)
            window = _since(everything, start)
        span = (as_of - start).days
        given = opening if opening is not None else "zero"
        return stock_runs(window, self.costs, as_of, span, self.rule, opening=given)

    # --- lines, counts and dimensions -------------------------------------------------------------

    def upsert(
        self, name: str, rows: DataFrame, key: Sequence[str], day: str,
        latest: Callable[[DataFrame], DataFrame] | None = None, settled: bool = False, placed: bool = False,
    ) -> None:
        """Add or replace rows of a fact by key. ``latest`` picks one row a key of those that landed;
        ``settled``: the key of a row never moves to another month (``manifest.upsert``); ``placed``: rows are not
        put in order (``manifest.write_rows``)."""
        rows = with_month(latest(rows) if latest else rows, day)
        if self.held(name) is None:
            m.publish(rows, self.path(name), "month", day, list(key), placed=placed)
        else:
            m.upsert(rows, self.path(name), rows.schema, key, day, list(key), settled=settled, placed=placed)

    def upsert_days(self, name: str, runs: DataFrame, day: str) -> None:
        """``upsert`` of the days of runs by the key of a whole row, laid out by months as ``_placed`` does by days."""
        texts = extract.runs_with_row_text(runs, day)
        days = self._placed(texts, TASK_RUNS * BLOCK_DAYS // MONTHS_DAYS, MONTHS_DAYS)
        self.upsert(name, extract.days_with_row_key(days, day), extract.ROW_KEY, day, settled=True, placed=True)

    def replace(self, name: str, rows: DataFrame) -> None:
        """A dimension as a whole."""
        m.publish(rows, self.path(name))


def _since(moves: DataFrame, first: date) -> DataFrame:
    return moves.filter(F.col("event_date") >= F.lit(first)).filter(F.col("month") >= first.strftime("%Y-%m"))


def _until(moves: DataFrame, last: date) -> DataFrame:
    return moves.filter(F.col("event_date") <= F.lit(last)).filter(F.col("month") <= last.strftime("%Y-%m"))
