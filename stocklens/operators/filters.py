"""Dashboard variables: option lists and the predicates they put on a report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.operators.mart import Tables
from stocklens.plans.layout import between

# Status options, in order of precedence.
STOCKOUT, LOW, HEALTHY, OVERSTOCK = "Stockout", "Low stock", "Healthy", "Overstock"
STATUS_OPTIONS = [STOCKOUT, LOW, HEALTHY, OVERSTOCK]
DEFAULT_RANGE_DAYS = 45

Choice = tuple[str, ...] | None


@dataclass(frozen=True)
class Filters:
    """Chosen values per variable; ``None`` means all."""

    region: Choice = None
    warehouse: Choice = None
    category: Choice = None
    brand: Choice = None
    sku: Choice = None
    supplier: Choice = None
    stock_status: Choice = None
    time_from: date | None = None
    time_to: date | None = None

    def time_range(self, as_of: date) -> tuple[date, date]:
        last = self.time_to or as_of
        return self.time_from or last - timedelta(days=DEFAULT_RANGE_DAYS), last


NO_FILTERS = Filters()


def chosen(column: str, values: Choice) -> Column:
    """``column in values``; true for everything when nothing is chosen."""
    return F.lit(True) if values is None else F.col(column).isin(*values)


def in_range(df: DataFrame, date_col: str, f: Filters, as_of: date) -> DataFrame:
    first, last = f.time_range(as_of)
    return between(df, date_col, first, last)


def _dims_of(fact: DataFrame, t: Tables, f: Filters, applies: str, need: Sequence[str]):
    """Tests on dimension columns, and the dimensions to join as (frame, key, columns)."""
    chosen_values = {
        "region": f.region if "R" in applies else None,
        "category": f.category if "C" in applies else None,
        "brand": f.brand if "B" in applies else None,
    }
    tests = {c: values for c, values in chosen_values.items() if values is not None}
    wanted = set(need) | set(tests)
    joins = []
    for dim, key in ((t.product, "sku_id"), (t.warehouse, "warehouse_id")):
        taken = [c for c in dim.columns if c in wanted and c not in fact.columns]
        if taken:
            joins.append((dim, key, taken))
    return tests, joins


def _on_keys(fact: DataFrame, f: Filters, applies: str) -> DataFrame:
    out = fact
    if "W" in applies and f.warehouse is not None:
        out = out.filter(chosen("warehouse_id", f.warehouse))
    if "K" in applies and f.sku is not None:
        out = out.filter(chosen("sku_id", f.sku))
    return out


def with_dims(
    fact: DataFrame, t: Tables, f: Filters, applies: str, need: Sequence[str] = ()
) -> DataFrame:
    """Filter a fact and add the dimension columns a report needs.

    ``applies`` names the variables the report obeys: W warehouse, R region, C category,
    B brand, K SKU. A dimension is joined only when the report shows it or a chosen value
    tests it. The join keeps facts without a dimension row; a chosen value then drops them.
    """
    tests, joins = _dims_of(fact, t, f, applies, need)
    out = _on_keys(fact, f, applies)
    for dim, key, taken in joins:
        out = out.join(dim.select(key, *taken), key, "left")
    for column, values in tests.items():
        out = out.filter(chosen(column, values))
    return out


def rolled_up(
    fact: DataFrame,
    t: Tables,
    f: Filters,
    applies: str,
    keys: Sequence[str],
    measures: Sequence[Column],
    need: Sequence[str] = (),
) -> DataFrame:
    """``with_dims`` over a fact that is summed before any dimension is joined.

    The sums are per ``keys`` and per key of a joined dimension. A hot key is one row per task
    by then, so neither the shuffle nor the joins see its size. Without a dimension to join the
    fact is summed per ``keys`` alone.
    """
    _, joins = _dims_of(fact, t, f, applies, need)
    group = list(dict.fromkeys([*keys, *(key for _, key, _ in joins)]))
    sums = _on_keys(fact, f, applies).groupBy(*group).agg(*measures)
    only_dims = "".join(c for c in applies if c not in "WK")
    return with_dims(sums, t, f, only_dims, need)


def or_key(name: str, key: str) -> Column:
    return F.coalesce(name, key)


def or_unknown(name: str) -> Column:
    return F.coalesce(name, F.lit("Unknown"))


def _options(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("value")).distinct().orderBy("value")


def region_options(t: Tables) -> DataFrame:
    return _options(t.warehouse.filter(F.col("region") != ""), "region")


def warehouse_options(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    rows = t.warehouse.filter(chosen("region", f.region))
    return rows.select(F.col("warehouse_id").alias("value")).orderBy("value")


def category_options(t: Tables) -> DataFrame:
    return _options(t.product.filter(F.col("category") != ""), "category")


def brand_options(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    rows = t.product.filter(chosen("category", f.category) & (F.col("brand") != ""))
    return _options(rows, "brand")


def sku_options(t: Tables, f: Filters = NO_FILTERS) -> DataFrame:
    rows = t.product.filter(chosen("category", f.category) & chosen("brand", f.brand))
    return _options(rows, "sku_id")


def supplier_options(t: Tables) -> DataFrame:
    return _options(t.supplier.filter(F.col("supplier_name") != ""), "supplier_name")


def status_options(t: Tables) -> DataFrame:
    spark = t.product.sparkSession
    values = F.posexplode(F.array(*[F.lit(s) for s in STATUS_OPTIONS])).alias("position", "value")
    return spark.range(1).select(values).orderBy("position").select("value")


def filter_options(t: Tables, f: Filters = NO_FILTERS) -> dict[str, DataFrame]:
    return {
        "region": region_options(t),
        "warehouse": warehouse_options(t, f),
        "category": category_options(t),
        "brand": brand_options(t, f),
        "sku": sku_options(t, f),
        "supplier": supplier_options(t),
        "stock_status": status_options(t),
    }
