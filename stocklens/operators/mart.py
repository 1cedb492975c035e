"""Star schema: facts and dimensions read from staging."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.schemas import MART


@dataclass(frozen=True)
class Tables:
    """The mart as lazy frames. Reports take this and nothing else."""

    movement: DataFrame
    snapshot: DataFrame
    po_lines: DataFrame
    sales_lines: DataFrame
    stock_counts: DataFrame
    product: DataFrame
    warehouse: DataFrame
    supplier: DataFrame
    customer: DataFrame
    date: DataFrame

    def latest_snapshot(self) -> DataFrame:
        """Rows of the newest snapshot date.

        The date is a scalar subquery: on a table laid out by date it prunes to one partition.
        """
        return latest_rows(self.snapshot)

    def newest_day(self) -> Column:
        """The newest snapshot date, NULL without a snapshot."""
        return self.snapshot.agg(F.max("snapshot_date")).scalar()

    def row_count(self, field: str) -> Column:
        return getattr(self, field).agg(F.count(F.lit(1))).scalar()

    def newest_landing(self, field: str) -> Column:
        """When the newest row of a fact landed, NULL without rows."""
        return getattr(self, field).agg(F.max("ingestion_time")).scalar()

    def last_moves(self) -> DataFrame:
        """Date of the last movement of every warehouse and SKU."""
        return last_moves(self.movement)


# Field of Tables -> mart table name.
TABLE_NAMES: dict[str, str] = {
    "movement": "fact_inventory_movement",
    "snapshot": "fact_inventory_snapshot_daily",
    "po_lines": "fact_purchase_order_lines",
    "sales_lines": "fact_sales_order_lines",
    "stock_counts": "fact_stock_counts",
    "product": "dim_product",
    "warehouse": "dim_warehouse",
    "supplier": "dim_supplier",
    "customer": "dim_customer",
    "date": "dim_date",
}


def mart_frames(t: Tables) -> dict[str, DataFrame]:
    return {TABLE_NAMES[f.name]: getattr(t, f.name) for f in fields(Tables)}


def latest_rows(snapshot: DataFrame) -> DataFrame:
    newest = snapshot.agg(F.max("snapshot_date")).scalar()
    return snapshot.filter(F.col("snapshot_date") == newest)


def one_row(t: Tables, *columns: Column) -> DataFrame:
    """One row of values that hold for whole tables."""
    return t.date.sparkSession.range(1).select(*columns)


def mart_counts(t: Tables) -> DataFrame:
    """One row with the row count of every mart table."""
    return one_row(t, *[t.row_count(field).alias(name) for field, name in TABLE_NAMES.items()])


def last_moves(movement: DataFrame) -> DataFrame:
    newest = F.max("event_date").alias("last_event_date")
    return movement.groupBy("warehouse_id", "sku_id").agg(newest)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project a staged frame onto the declared columns and types of a mart table."""
    pairs = [column.split(" ", 1) for column in MART[table].split(", ")]
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in pairs])


def fact_movement(stg: DataFrame) -> DataFrame:
    return conform(stg, "fact_inventory_movement")


def fact_snapshot(stg: DataFrame) -> DataFrame:
    return conform(stg, "fact_inventory_snapshot_daily")


def fact_po_lines(stg: DataFrame) -> DataFrame:
    return conform(stg, "fact_purchase_order_lines")


def fact_sales_lines(stg: DataFrame) -> DataFrame:
    return conform(stg, "fact_sales_order_lines")


def fact_stock_counts(stg: DataFrame) -> DataFrame:
    return conform(stg, "fact_stock_counts")


def dim_product(stg: DataFrame) -> DataFrame:
    return conform(stg, "dim_product")


def dim_warehouse(stg: DataFrame) -> DataFrame:
    return conform(stg, "dim_warehouse")


def dim_supplier(stg: DataFrame) -> DataFrame:
    return conform(stg, "dim_supplier")


def dim_customer(stg: DataFrame) -> DataFrame:
    return conform(stg, "dim_customer")


def dim_date(stg: DataFrame) -> DataFrame:
    return conform(stg, "dim_date")
