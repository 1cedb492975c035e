"""Row-level restriction: the mart as one user may see it."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.operators.mart import Tables

#: user_name, scope ('all', 'region' or 'warehouse'), value
ACCESS = "user_name string, scope string, value string"


def allowed_sites(warehouse: DataFrame, access: DataFrame, user: str) -> DataFrame:
    """Warehouses that a user's rows of the access table name, by key, by region, or all."""
    given = access.filter(F.col("user_name") == user)
    scopes = F.array(
        F.struct(F.lit("all").alias("scope"), F.lit("").alias("value")),
        F.struct(F.lit("region").alias("scope"), F.col("region").alias("value")),
        F.struct(F.lit("warehouse").alias("scope"), F.col("warehouse_id").alias("value")),
    )
    sites = warehouse.select("warehouse_id", F.explode(scopes).alias("s")).select("warehouse_id", "s.*")
    rights = given.select("scope", F.when(F.col("scope") == "all", "").otherwise(F.col("value")).alias("value"))
    return sites.join(rights, ["scope", "value"], "left_semi").select("warehouse_id").distinct()


def restricted(
    t: Tables, access: DataFrame, user: str, sales_orders: DataFrame | None = None, purchase_orders: DataFrame | None = None
) -> Tables:
    """The mart with only the rows of the user's warehouses; every report and panel over it inherits that.

    Each fact is semi-joined once with the few allowed warehouses. Order lines name no warehouse: they
    follow their order's, and without the orders none of them are shown. A user without rights sees
    no rows of warehouses, facts or lines; products, suppliers, customers and dates have no site.
    """
    sites = allowed_sites(t.warehouse, access, user)

    def of_site(df: DataFrame) -> DataFrame:
        return df.join(sites, "warehouse_id", "left_semi")

    def of_order(lines: DataFrame, orders: DataFrame | None, key: str) -> DataFrame:
        if orders is None:
            return lines.filter(F.lit(False))
        return lines.join(of_site(orders.select(key, "warehouse_id")), key, "left_semi")

    whole = Tables(**{name: getattr(t, name) for name in Tables.__dataclass_fields__})
    return replace(
        whole, warehouse=of_site(t.warehouse), movement=of_site(t.movement), snapshot=of_site(t.snapshot),
        stock_counts=of_site(t.stock_counts), sales_lines=of_order(t.sales_lines, sales_orders, "order_id"),
        po_lines=of_order(t.po_lines, purchase_orders, "po_id"),
    )
