"""Declared schemas: messages on the wire, raw, staging and mart tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic name -> message columns. Dates travel as text, money as double.
MESSAGES: dict[str, str] = {
    "inventory_topic": "warehouse_id string, sku_id string, qty_change int, event_time timestamp",
    "po_lines_topic": (
        "po_line_id bigint, po_id bigint, line_no int, sku_id string, qty_ordered int, "
        "qty_received int, unit_cost double, line_status string, created_at string"
    ),
    "sales_lines_topic": (
        "so_line_id bigint, order_id bigint, line_no int, sku_id string, qty int, "
        "unit_price double, created_at string"
    ),
    "snapshot_topic": (
        "snapshot_date string, warehouse_id string, sku_id string, on_hand_qty int, "
        "reserved_qty int, damaged_qty int, in_transit_qty int, available_qty int, "
        "unit_cost double, inventory_value double, created_at string"
    ),
    "stock_counts_topic": (
        "count_id bigint, count_date string, warehouse_id string, sku_id string, "
        "system_qty int, counted_qty int, variance_qty int, created_at string"
    ),
    "dim_skus_topic": (
        "sku_id string, sku_name string, category string, subcategory string, brand string, "
        "uom string, unit_cost double, selling_price double, status string, reorder_point int, "
        "safety_stock int, max_stock int, shelf_life_days int, abc_class string, created_at string"
    ),
    "dim_warehouses_topic": (
        "warehouse_id string, warehouse_name string, city string, region string, created_at string"
    ),
    "dim_suppliers_topic": (
        "supplier_id string, supplier_name string, country string, lead_time_days int, "
        "rating double, payment_terms_days int, created_at string"
    ),
    "dim_customers_topic": (
        "customer_id string, customer_name string, segment string, city string, region string, "
        "created_at string"
    ),
}

# Mart table -> columns.
MART: dict[str, str] = {
    "fact_inventory_movement": (
        "event_date date, event_time timestamp, warehouse_id string, sku_id string, "
        "event_type string, qty_change int, qty_in int, qty_out int, ingestion_time timestamp"
    ),
    "fact_inventory_snapshot_daily": (
        "snapshot_date date, warehouse_id string, sku_id string, on_hand_qty int, "
        "reserved_qty int, damaged_qty int, in_transit_qty int, available_qty int, "
        "inventory_value decimal(18,2), unit_cost decimal(18,2), created_at timestamp, "
        "ingestion_time timestamp"
    ),
    "fact_purchase_order_lines": (
        "created_date date, po_id bigint, po_line_id bigint, line_no int, sku_id string, "
        "qty_ordered int, qty_received int, qty_open int, unit_cost decimal(18,2), "
        "line_status string, created_at timestamp, ingestion_time timestamp"
    ),
    "fact_sales_order_lines": (
        "created_date date, order_id bigint, so_line_id bigint, line_no int, sku_id string, "
        "qty int, unit_price decimal(18,2), sales_amount decimal(18,2), created_at timestamp, "
        "ingestion_time timestamp"
    ),
    "fact_stock_counts": (
        "count_date date, warehouse_id string, sku_id string, system_qty int, counted_qty int, "
        "variance_qty int, created_at timestamp, ingestion_time timestamp"
    ),
    "dim_product": (
        "sku_id string, sku_name string, category string, subcategory string, brand string, "
        "uom string, unit_cost decimal(18,2), selling_price decimal(18,2), status string, "
        "reorder_point int, safety_stock int, max_stock int, shelf_life_days int, "
        "abc_class string, created_at timestamp"
    ),
    "dim_warehouse": (
        "warehouse_id string, warehouse_name string, city string, region string, "
        "created_at timestamp"
    ),
    "dim_supplier": (
        "supplier_id string, supplier_name string, country string, lead_time_days int, "
        "rating decimal(4,2), payment_terms_days int, created_at timestamp"
    ),
    "dim_customer": (
        "customer_id string, customer_name string, segment string, city string, region string, "
        "created_at timestamp"
    ),
    "dim_date": (
        "date_key int, full_date date, calendar_year int, calendar_quarter int, "
        "calendar_month int, month_name string, day_of_month int, day_of_week int, "
        "day_name string, is_weekend int"
    ),
}


def message_schema(topic: str) -> T.StructType:
    return T.StructType.fromDDL(MESSAGES[topic])


def mart_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(MART[table])
