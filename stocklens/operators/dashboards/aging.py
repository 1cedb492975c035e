"""Aging, dead stock and count accuracy panels."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions import count_where, ratio, sum_long, sum_money
from stocklens.operators.filters import (
    NO_FILTERS, Filters, or_key, or_unknown, rolled_up, with_dims,
)
from stocklens.operators.mart import Tables
from stocklens.plans.layout import since

ALL = "WRCBK"
PAIR = ["warehouse_id", "sku_id"]
COUNT_DAYS = 60

# Aging buckets in order, each up to its last day; the last one is open.
BUCKETS = [("0-30 days", 30), ("31-60 days", 60), ("61-90 days", 90), ("90+ days", None)]


def aging_base(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    """Stocked pairs of the latest snapshot with the days since their last movement.

    A pair that never moved takes the snapshot date as its last movement.
    """
    last = F.coalesce("last_event_date", "snapshot_date")
    return (
        with_dims(t.latest_snapshot(), t, f, ALL)
        .filter(F.col("available_qty") > 0)
        .join(t.last_moves(), PAIR, "left")
        .select(
            *PAIR, "available_qty", "damaged_qty", "in_transit_qty", "inventory_value",
            last.alias("last_movement_date"),
            F.datediff("snapshot_date", last).alias("days_since_movement"),
        )
    )


def bucket_of(days: Column) -> Column:
    out = F
    for name, last in BUCKETS:
        out = out.otherwise(F.lit(name)) if last is None else out.when(days <= last, name)
    return out


def _counted(
    t: Tables, f: Filters, as_of: date, keys: tuple[str, ...] = (), need: tuple[str, ...] = ()
) -> DataFrame:
    """Count results of the window, summed before dimensions are joined."""
    rows = since(t.stock_counts, "count_date", as_of - timedelta(days=COUNT_DAYS))
    measures = [
        F.count(F.lit(1)).alias("events"),
        count_where(F.col("variance_qty") == 0).alias("exact"),
        sum_long(F.abs("variance_qty")).alias("variance"),
    ]
    return rolled_up(rows, t, f, ALL, keys, measures, need)


def _events() -> Column:
    return sum_long("events")


def _accuracy() -> Column:
    return ratio(sum_long("exact") * 100, _events())


def _mean_variance() -> Column:
    return ratio(sum_long("variance"), _events())


def count_accuracy(t: Tables, f: Filters, as_of: date) -> DataFrame:
    return _counted(t, f, as_of).agg(_accuracy().alias("value"))


def avg_abs_variance(t: Tables, f: Filters, as_of: date) -> DataFrame:
    return _counted(t, f, as_of).agg(_mean_variance().alias("value"))


def _value_where(t: Tables, condition: Column) -> DataFrame:
    value = sum_money(F.when(condition, F.col("inventory_value")))
    return aging_base(t).agg(value.alias("value"))


def dead_stock_value(t: Tables) -> DataFrame:
    return _value_where(t, F.col("days_since_movement") > 90)


def slow_moving_value(t: Tables) -> DataFrame:
    return _value_where(t, F.col("days_since_movement").between(31, 90))


def _bucket_values(t: Tables) -> DataFrame:
    return (
        aging_base(t)
        .groupBy(bucket_of(F.col("days_since_movement")).alias("aging_bucket"))
        .agg(
            sum_money("inventory_value").alias("aging_value"),
            F.min("days_since_movement").alias("youngest"),
        )
    )


def aging_buckets(t: Tables) -> DataFrame:
    """Value per bucket; all four buckets are listed, in order."""
    names = F.posexplode(F.array(*[F.lit(n) for n, _ in BUCKETS]))
    listed = t.product.sparkSession.range(1).select(names.alias("position", "aging_bucket"))
    zero = F.lit(0).cast("decimal(38,2)")
    return (
        listed.join(_bucket_values(t), "aging_bucket", "left")
        .orderBy("position")
        .select("aging_bucket", F.coalesce("aging_value", zero).alias("aging_value"))
    )


def aging_buckets_present(t: Tables) -> DataFrame:
    return _bucket_values(t).orderBy("youngest").select("aging_bucket", "aging_value")


def variance_trend(t: Tables, f: Filters, as_of: date) -> DataFrame:
    return (
        _counted(t, f, as_of, ("count_date",))
        .groupBy(F.col("count_date").alias("time"))
        .agg(_mean_variance().alias("avg_abs_variance"), _accuracy().alias("accuracy_pct"))
        .orderBy("time")
    )


def _named_aging(rows: DataFrame, t: Tables) -> DataFrame:
    return with_dims(rows, t, NO_FILTERS, "", ["sku_name", "category", "warehouse_name"]).select(
        or_key("warehouse_name", "warehouse_id").alias("warehouse"), "sku_id",
        or_key("sku_name", "sku_id").alias("sku_name"), or_unknown("category").alias("category"),
        "available_qty", "inventory_value", "last_movement_date", "days_since_movement",
        "warehouse_id",
    )


def _by_age() -> list[Column]:
    """Oldest first; thirty days and more come before the rest by themselves."""
    return [
        F.desc("days_since_movement"), F.desc("inventory_value"),
        F.asc("warehouse_id"), F.asc("sku_id"),
    ]


def top_dead_slow(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    # Names are added to the rows that made the list.
    top = aging_base(t, f).orderBy(*_by_age()).limit(25)
    slow = F.col("days_since_movement") >= 30
    return (
        _named_aging(top, t)
        .withColumn(
            "slow_moving_bucket",
            F.when(slow, "Dead/Slow >=30d").otherwise("Top slow recent movers"),
        )
        .orderBy(*_by_age())
        .drop("warehouse_id")
    )


def dead_slow_only(t: Tables) -> DataFrame:
    rows = aging_base(t).filter(F.col("days_since_movement") >= 30)
    top = rows.orderBy(*_by_age()).limit(25)
    return _named_aging(top, t).orderBy(*_by_age()).drop("warehouse_id")


def _warehouse() -> Column:
    return or_key("warehouse_name", "warehouse_id").alias("warehouse")


def variance_by_warehouse(t: Tables, f: Filters, as_of: date) -> DataFrame:
    return (
        _counted(t, f, as_of, ("warehouse_id",), ("warehouse_name",))
        .groupBy(_warehouse())
        .agg(
            _events().alias("count_events"),
            _mean_variance().alias("avg_abs_variance"),
            sum_long("variance").alias("total_abs_variance"),
            _accuracy().alias("accuracy_pct"),
        )
        .orderBy("accuracy_pct", F.desc("total_abs_variance"), "warehouse")
    )


def accuracy_by_warehouse(t: Tables, as_of: date) -> DataFrame:
    return (
        _counted(t, NO_FILTERS, as_of, ("warehouse_id",), ("warehouse_name",))
        .groupBy(_warehouse())
        .agg(_accuracy().alias("accuracy_pct"))
        .orderBy("accuracy_pct", "warehouse")
    )
