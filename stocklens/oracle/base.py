"""Common table expressions shared by the check queries, and the text that composes them."""

from __future__ import annotations

import re

from stocklens.operators.filters import Filters

AS_OF = "DATE '2001-08-01'"
NOW = "TIMESTAMP '2001-08-01 12:30:00'"
INGESTED = "TIMESTAMP '2001-08-01 06:00:00'"


def _sku(c: str) -> str:
    return f"concat('SKU_', lpad(cast({c} AS varchar), 6, '0'))"


def _wh(c: str) -> str:
    return f"concat('WH', lpad(cast({c} AS varchar), 2, '0'))"


def _dirty(number: str, key: str) -> str:
    return f"CASE WHEN {number} % 7 = 0 THEN concat(' ', lower({key}), ' ') ELSE {key} END"


def _latest(key: str, table: str, columns: dict[str, str]) -> str:
    """Newest row per key; ties by the columns in order, as one whole row."""
    shaped = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    ties = ", ".join(f"{name} DESC NULLS LAST" for name in columns)
    names = ", ".join(columns)
    return f"""
    SELECT {key}, {names}, created_at FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY created_at DESC, {ties}) AS rn
      FROM (SELECT upper(trim({key})) AS {key}, {shaped},
                   coalesce(try_cast(created_at AS timestamp), TIMESTAMP '1970-01-01') AS created_at
            FROM {table} WHERE trim({key}) <> '') shaped) ranked WHERE rn = 1"""


def _text(*names: str) -> dict[str, str]:
    return {n: f"trim({n})" for n in names}


def _clamped(*names: str) -> dict[str, str]:
    return {n: f"cast(greatest({n}, 0) AS int)" for n in names}


def _price(*names: str) -> dict[str, str]:
    return {n: f"cast(greatest(cast({n} AS decimal(18,2)), 0) AS decimal(18,2))" for n in names}


CTES: dict[str, str] = {
    "map_line": f"""
    SELECT {_wh('n_regionkey + 1')} AS warehouse_id, {_sku('l_partkey')} AS sku_id,
           l_partkey, l_orderkey, l_linenumber, l_returnflag, l_linestatus,
           cast(l_quantity AS int) AS q, cast(l_shipdate AS date) AS ship_date,
           cast(o_orderdate AS date) AS order_date
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "raw_tx": f"""
    SELECT warehouse_id, {_dirty('l_partkey', 'sku_id')} AS sku_id,
           CASE l_returnflag WHEN 'A' THEN 'RECEIPT' WHEN 'R' THEN 'RETURN'
             ELSE CASE WHEN l_linenumber = 7 THEN 'ADJUSTMENT' ELSE 'SHIPMENT' END
           END AS event_type,
           CASE l_returnflag WHEN 'A' THEN 2 * q WHEN 'R' THEN q ELSE -2 * q END AS qty_change,
           cast(ship_date AS timestamp) AS event_time, {INGESTED} AS ingestion_time
    FROM map_line""",
    "raw_skus": f"""
    SELECT {_dirty('p_partkey', f"replace({_sku('p_partkey')}, '_', CASE WHEN p_partkey % 50 = 49 THEN '-' ELSE '_' END)")} AS sku_id,
           concat(' ', p_name, CASE WHEN v = 2 THEN ' v2' ELSE '' END) AS sku_name,
           p_type AS category, concat('Sub ', cast(p_size % 5 AS varchar)) AS subcategory,
           CASE WHEN p_partkey % 25 = 4 THEN '' ELSE p_brand END AS brand, 'EA' AS uom,
           p_retailprice AS unit_cost, p_retailprice + 100 AS selling_price, 'ACTIVE' AS status,
           cast(CASE WHEN p_partkey % 40 = 3 THEN 0 ELSE 25 + p_partkey % 80 END AS int)
             AS reorder_point,
           cast(10 + p_partkey % 40 AS int) AS safety_stock,
           cast(150 + p_partkey % 600 AS int) AS max_stock,
           cast(CASE WHEN p_partkey % 6 = 1 THEN 180 ELSE 0 END AS int) AS shelf_life_days,
           CASE WHEN p_partkey % 10 < 2 THEN 'A' WHEN p_partkey % 10 < 5 THEN 'B' ELSE 'C' END
             AS abc_class,
           CASE v WHEN 1 THEN '2001-01-01 00:00:00' WHEN 2 THEN '2001-06-01 00:00:00'
             ELSE 'n/a' END AS created_at
    FROM part, (VALUES (1), (2), (3)) versions(v)
    WHERE (v = 1 OR (v = 2 AND p_partkey % 10 = 0) OR (v = 3 AND p_partkey % 20 = 5))""",
    "raw_warehouses": f"""
    SELECT {_wh('r_regionkey + 1')} AS warehouse_id,
           concat('Warehouse ', lpad(cast(r_regionkey + 1 AS varchar), 2, '0')) AS warehouse_name,
           concat('City ', cast(r_regionkey AS varchar)) AS city, r_name AS region,
           '2001-01-01 00:00:00' AS created_at
    FROM region""",
    "raw_suppliers": """
    SELECT concat('SUP-', lpad(cast(s_suppkey AS varchar), 6, '0')) AS supplier_id,
           s_name AS supplier_name, n_name AS country,
           cast(3 + s_suppkey % 16 AS int) AS lead_time_days,
           cast(cast(s_suppkey % 51 AS decimal(4,0)) / 10 AS decimal(4,2)) AS rating,
           cast(15 * (1 + s_suppkey % 4) AS int) AS payment_terms_days,
           '2001-01-01 00:00:00' AS created_at
    FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "raw_customers": """
    SELECT concat('CUS-', lpad(cast(c_custkey AS varchar), 6, '0')) AS customer_id,
           c_name AS customer_name, c_mktsegment AS segment, n_name AS city, r_name AS region,
           '2001-01-01 00:00:00' AS created_at
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey""",
    "raw_sales_lines": f"""
    SELECT l_orderkey * 8 + l_linenumber AS so_line_id, l_orderkey AS order_id,
           l_linenumber AS line_no, sku_id, q AS qty,
           cast(p_retailprice + 100 AS decimal(18,2)) AS unit_price,
           cast(order_date AS timestamp) AS created_at, {INGESTED} AS ingestion_time
    FROM map_line JOIN part ON p_partkey = l_partkey""",
    "raw_po_lines": f"""
    SELECT l_orderkey * 8 + l_linenumber AS po_line_id, l_orderkey AS po_id,
           l_linenumber AS line_no, sku_id, q AS qty_ordered,
           cast(CASE l_returnflag WHEN 'A' THEN q WHEN 'R' THEN floor(q / 2) ELSE 0 END AS int)
             AS qty_received,
           cast(p_retailprice AS decimal(18,2)) AS unit_cost,
           CASE WHEN l_linenumber = 6 THEN ' ' ELSE
             CASE l_returnflag WHEN 'A' THEN 'CLOSED' WHEN 'R' THEN 'PARTIAL' ELSE 'OPEN' END
           END AS line_status,
           cast(order_date AS timestamp) AS created_at, {INGESTED} AS ingestion_time
    FROM map_line JOIN part ON p_partkey = l_partkey WHERE l_linestatus = 'O'""",
    "raw_counts": f"""
    SELECT l_orderkey AS count_id, ship_date AS count_date, warehouse_id, sku_id,
           cast(10 + l_partkey % 220 AS int) AS system_qty,
           cast(10 + l_partkey % 220 + (l_orderkey * 7 + l_partkey) % 7 - 3 AS int) AS counted_qty,
           cast((l_orderkey * 7 + l_partkey) % 7 - 3 AS int) AS variance_qty,
           cast(ship_date AS timestamp) AS created_at, {INGESTED} AS ingestion_time
    FROM map_line WHERE l_linenumber = 1""",
    "sales_orders": f"""
    SELECT o_orderkey AS order_id, concat('SO-', cast(o_orderkey AS varchar)) AS order_number,
           concat('CUS-', lpad(cast(o_custkey AS varchar), 6, '0')) AS customer_id,
           {_wh('o_orderkey % 5 + 1')} AS warehouse_id, cast(o_orderdate AS date) AS order_date,
           CASE o_orderstatus WHEN 'F' THEN 'SHIPPED' WHEN 'O' THEN 'OPEN' ELSE 'CANCELLED' END
             AS status
    FROM orders""",
    "purchase_orders": f"""
    SELECT o_orderkey AS po_id, concat('PO-', cast(o_orderkey AS varchar)) AS po_number,
           concat('SUP-', lpad(cast(o_orderkey % 10 AS varchar), 6, '0')) AS supplier_id,
           {_wh('o_orderkey % 5 + 1')} AS warehouse_id, cast(o_orderdate AS date) AS order_date,
           CASE WHEN o_orderkey % 7 = 0 THEN 'CLOSED' WHEN o_orderkey % 7 = 1 THEN 'PARTIAL'
             ELSE 'OPEN' END AS status,
           cast(o_orderdate AS date) + cast(3 + o_orderkey % 10 AS int) AS expected_delivery_date,
           'VND' AS currency
    FROM orders""",
    "transfers": f"""
    SELECT o_orderkey AS transfer_id, concat('TRF-', cast(o_orderkey AS varchar)) AS transfer_ref,
           {_wh('o_orderkey % 5 + 1')} AS from_warehouse_id,
           {_wh('(o_orderkey + 2) % 5 + 1')} AS to_warehouse_id,
           CASE WHEN o_orderkey % 3 = 0 THEN 'RECEIVED' ELSE 'IN_TRANSIT' END AS status,
           cast(cast(o_orderdate AS date) AS timestamp) AS requested_at,
           CASE WHEN o_orderkey % 3 = 0 THEN
             cast(cast(o_orderdate AS date) + cast(1 + o_orderkey % 9 AS int) AS timestamp)
           END AS completed_at
    FROM orders""",
    "transfer_lines": """
    SELECT l_orderkey * 8 + l_linenumber AS transfer_line_id, l_orderkey AS transfer_id, sku_id,
           q AS qty
    FROM map_line""",
    "clean_tx": """
    SELECT upper(trim(warehouse_id)) AS warehouse_id, upper(trim(sku_id)) AS sku_id, event_type,
           qty_change, event_time, ingestion_time
    FROM raw_tx WHERE trim(warehouse_id) <> '' AND trim(sku_id) <> ''""",
    "movement": """
    SELECT cast(event_time AS date) AS event_date, event_time, warehouse_id, sku_id,
           CASE WHEN qty_change > 0 THEN 'inbound' WHEN qty_change < 0 THEN 'outbound'
             ELSE 'adjustment' END AS event_type, qty_change,
           cast(CASE WHEN qty_change > 0 THEN qty_change ELSE 0 END AS int) AS qty_in,
           cast(CASE WHEN qty_change < 0 THEN abs(qty_change) ELSE 0 END AS int) AS qty_out,
           ingestion_time
    FROM clean_tx""",
    "day_grid": f"""
    SELECT cast(d AS date) AS snapshot_date
    FROM generate_series({AS_OF} - 120, {AS_OF}, INTERVAL 1 DAY) days(d)""",
    "balances": f"""
    SELECT snapshot_date, pairs.warehouse_id, pairs.sku_id,
           sum(coalesce(net.n, 0)) OVER (PARTITION BY pairs.warehouse_id, pairs.sku_id
             ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING) + pairs.opening AS balance
    FROM (SELECT warehouse_id, sku_id,
                 sum(CASE WHEN event_date < {AS_OF} - 120 THEN qty_change ELSE 0 END) AS opening
          FROM movement WHERE event_date <= {AS_OF} GROUP BY 1, 2) pairs
    CROSS JOIN day_grid
    LEFT JOIN (SELECT event_date, warehouse_id, sku_id, sum(qty_change) AS n FROM movement
               WHERE event_date >= {AS_OF} - 120 GROUP BY 1, 2, 3) net
      ON net.event_date = snapshot_date AND net.warehouse_id = pairs.warehouse_id
      AND net.sku_id = pairs.sku_id""",
    "snapshot": f"""
    SELECT snapshot_date, warehouse_id, sku_id, on_hand_qty, reserved_qty, damaged_qty,
           in_transit_qty,
           cast(greatest(on_hand_qty - reserved_qty - damaged_qty, 0) AS int) AS available_qty,
           cast(on_hand_qty * unit_cost AS decimal(18,2)) AS inventory_value, unit_cost,
           {INGESTED} AS created_at, {INGESTED} AS ingestion_time
    FROM (SELECT snapshot_date, warehouse_id, sku_id,
                 cast(greatest(balance, 0) AS int) AS on_hand_qty,
                 cast(CASE WHEN balance > 0 THEN p_partkey % 8 ELSE 0 END AS int) AS reserved_qty,
                 cast(CASE WHEN balance > 0 THEN p_partkey % 3 ELSE 0 END AS int) AS damaged_qty,
                 cast(p_partkey % 12 AS int) AS in_transit_qty,
                 cast(p_retailprice AS decimal(18,2)) AS unit_cost
          FROM balances JOIN part ON {_sku('p_partkey')} = sku_id) shelf""",
    "po_lines": """
    SELECT cast(created_at AS date) AS created_date, po_id, po_line_id, line_no,
           upper(trim(sku_id)) AS sku_id, cast(greatest(qty_ordered, 0) AS int) AS qty_ordered,
           cast(greatest(qty_received, 0) AS int) AS qty_received,
           cast(greatest(greatest(qty_ordered, 0) - greatest(qty_received, 0), 0) AS int)
             AS qty_open,
           cast(greatest(unit_cost, 0) AS decimal(18,2)) AS unit_cost,
           CASE WHEN trim(line_status) = '' THEN 'unknown' ELSE trim(line_status) END
             AS line_status, created_at, ingestion_time
    FROM raw_po_lines WHERE trim(sku_id) <> ''""",
    "sales_lines": """
    SELECT cast(created_at AS date) AS created_date, order_id, so_line_id, line_no,
           upper(trim(sku_id)) AS sku_id, cast(greatest(qty, 0) AS int) AS qty,
           cast(greatest(unit_price, 0) AS decimal(18,2)) AS unit_price,
           cast(greatest(qty, 0) * greatest(unit_price, 0) AS decimal(18,2)) AS sales_amount,
           created_at, ingestion_time
    FROM raw_sales_lines WHERE trim(sku_id) <> ''""",
    "stock_counts": """
    SELECT count_date, upper(trim(warehouse_id)) AS warehouse_id, upper(trim(sku_id)) AS sku_id,
           system_qty, counted_qty, cast(counted_qty - system_qty AS int) AS variance_qty,
           created_at, ingestion_time
    FROM raw_counts WHERE trim(warehouse_id) <> '' AND trim(sku_id) <> ''""",
    "product": _latest("sku_id", "raw_skus", {
        **_text("sku_name", "category", "subcategory", "brand", "uom"),
        **_price("unit_cost", "selling_price"), **_text("status"),
        **_clamped("reorder_point", "safety_stock", "max_stock", "shelf_life_days"),
        **_text("abc_class")}),
    "warehouse": _latest(
        "warehouse_id", "raw_warehouses", _text("warehouse_name", "city", "region")),
    "supplier_dim": _latest("supplier_id", "raw_suppliers", {
        **_text("supplier_name", "country"), **_clamped("lead_time_days"),
        "rating": "cast(greatest(rating, 0) AS decimal(4,2))", **_clamped("payment_terms_days")}),
    "customer_dim": _latest(
        "customer_id", "raw_customers", _text("customer_name", "segment", "city", "region")),
    "dates": """
    SELECT cast(strftime(d, '%Y%m%d') AS int) AS date_key, d AS full_date,
           cast(year(d) AS int) AS calendar_year, cast(quarter(d) AS int) AS calendar_quarter,
           cast(month(d) AS int) AS calendar_month, monthname(d) AS month_name,
           cast(day(d) AS int) AS day_of_month, cast(isodow(d) AS int) AS day_of_week,
           left(dayname(d), 3) AS day_name,
           cast(CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS int) AS is_weekend
    FROM (SELECT newest - 800 + cast(n AS int) AS d
          FROM (SELECT max(cast(o_orderdate AS date)) AS newest FROM orders) o,
               generate_series(0, 860) s(n)) days""",
    "latest": """
    SELECT * FROM snapshot WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshot)""",
    "aging": """
    SELECT s.warehouse_id, s.sku_id, s.available_qty, s.damaged_qty, s.in_transit_qty,
           s.inventory_value, coalesce(m.moved, s.snapshot_date) AS last_movement_date,
           cast(date_diff('day', coalesce(m.moved, s.snapshot_date), s.snapshot_date) AS int)
             AS days_since_movement
    FROM latest s
    LEFT JOIN (SELECT warehouse_id, sku_id, max(event_date) AS moved FROM movement GROUP BY 1, 2) m
      ON m.warehouse_id = s.warehouse_id AND m.sku_id = s.sku_id
    WHERE s.available_qty > 0""",
    "daily": """
    SELECT cast(event_time AS date) AS movement_date, warehouse_id, sku_id,
      cast(sum(CASE WHEN event_type = 'RECEIPT' AND qty_change > 0 THEN qty_change ELSE 0 END)
        AS bigint) AS gross_receipt_qty,
      cast(sum(CASE WHEN event_type = 'SHIPMENT' THEN abs(qty_change) ELSE 0 END) AS bigint)
        AS shipment_qty,
      cast(sum(CASE WHEN event_type = 'RETURN' AND qty_change > 0 THEN qty_change ELSE 0 END)
        AS bigint) AS return_qty,
      cast(sum(CASE WHEN event_type = 'ADJUSTMENT' THEN qty_change ELSE 0 END) AS bigint)
        AS adjustment_net_qty,
      cast(sum(qty_change) AS bigint) AS net_qty_change, count(*) AS transaction_rows
    FROM clean_tx GROUP BY 1, 2, 3""",
    "msgs": """
    SELECT conv_id AS conversation_id, turn, role AS sender, text AS message
    FROM conversations""",
}


def query(body: str) -> str:
    """A statement with the shared expressions that its text names, in order of dependency."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    return f"WITH {parts}\n{body}"


def ratio(a: str, b: str, places: int = 2) -> str:
    """Half-even ratio of integers, for a not negative; NULL unless b is positive."""
    scale = 10**places
    top = f"({2 * scale} * ({a}) + ({b}))"
    bottom = f"(2 * ({b}))"
    units = (
        f"({top} // {bottom} - CASE WHEN {top} % {bottom} = 0 AND ({top} // {bottom}) % 2 = 1 "
        f"THEN 1 ELSE 0 END)"
    )
    return f"(CASE WHEN ({b}) > 0 THEN cast({units} AS bigint) / {scale}.0::double END)"


def long(expr: str) -> str:
    return f"cast(coalesce(sum({expr}), 0) AS bigint)"


def cash(expr: str) -> str:
    return f"cast(coalesce(sum({expr}), 0) AS decimal(38,2))"


def count_if(condition: str) -> str:
    return f"cast(count(*) FILTER (WHERE {condition}) AS bigint)"


LOW = "(coalesce(p.reorder_point, 0) > 0 AND s.available_qty < coalesce(p.reorder_point, 0))"
OVER = "(coalesce(p.max_stock, 0) > 0 AND s.available_qty > coalesce(p.max_stock, 0))"
STATUS = (
    f"CASE WHEN s.available_qty <= 0 THEN 'Stockout' WHEN {LOW} THEN 'Low stock' "
    f"WHEN {OVER} THEN 'Overstock' ELSE 'Healthy' END"
)
DIMS = """LEFT JOIN product p ON p.sku_id = s.sku_id
    LEFT JOIN warehouse w ON w.warehouse_id = s.warehouse_id"""
SKU_NAME = "coalesce(p.sku_name, s.sku_id) AS sku_name"
CATEGORY = "coalesce(p.category, 'Unknown') AS category"
WAREHOUSE = "coalesce(w.warehouse_name, s.warehouse_id) AS warehouse"


def where(f: Filters, applies: str, alias: str = "s") -> str:
    """Conditions of the chosen values, starting with AND; empty when nothing is chosen."""
    columns = {
        "W": (f"{alias}.warehouse_id", f.warehouse), "R": ("w.region", f.region),
        "C": ("p.category", f.category), "B": ("p.brand", f.brand), "K": (f"{alias}.sku_id", f.sku),
    }
    parts = []
    for letter in applies:
        column, values = columns[letter]
        if values is not None:
            listed = ", ".join(f"'{v}'" for v in values)
            parts.append(f" AND {column} IN ({listed})")
    return "".join(parts)


def status_in(f: Filters, column: str = "stock_status") -> str:
    if f.stock_status is None:
        return ""
    listed = ", ".join(f"'{v}'" for v in f.stock_status)
    return f" AND {column} IN ({listed})"
