"""Check queries of staging, mart, derivations, quality, extract and message log."""

from __future__ import annotations

from stocklens.oracle.base import AS_OF, INGESTED, query

# Intent and its words, first fit wins.
INTENTS = {
    "overview": ["tong quan", "overview", "hien tai", "current inventory", "gia tri ton kho"],
    "low_stock": ["sap het", "thieu hang", "low stock", "stockout", "reorder"],
    "overstock": ["overstock", "vuot max", "ton qua muc", "du hang"],
    "warehouse": ["warehouse", "kho nao", "theo kho", "tung kho"],
    "movement": ["movement", "nhap xuat", "bien dong", "xuat nhap", "giao dich kho"],
    "replenishment": ["po", "mua hang", "replenishment", "inbound", "don mua"],
}

# KPI, threshold, state below it, state from it on.
ALERT_RULES = """
    ('low_stock_count', 1, 'ok', 'alert'), ('overstock_count', 1, 'ok', 'alert'),
    ('below_reorder_count', 1, 'ok', 'alert'), ('negative_available_count', 1, 'ok', 'alert'),
    ('damaged_total', 1, 'ok', 'alert'), ('in_transit_total', 1, 'ok', 'alert'),
    ('avg_lead_time', 7, 'ok', 'alert'), ('suggested_reorder_qty', 1, 'ok', 'alert'),
    ('supplier_sla', 0.95, 'alert', 'ok'), ('count_accuracy', 80, 'alert', 'ok'),
    ('avg_abs_variance', 1, 'ok', 'alert'), ('dead_stock_value', 1, 'ok', 'alert'),
    ('slow_moving_value', 1, 'ok', 'alert'), ('negative_stock_rows', 1, 'ok', 'alert'),
    ('snapshot_lag_hours', 24, 'ok', 'alert')"""

NAMES = {
    "raw_inventory_transactions": "raw_tx",
    "raw_inventory_snapshot_daily": "snapshot",
    "raw_purchase_order_lines": "raw_po_lines",
    "raw_sales_order_lines": "raw_sales_lines",
    "raw_stock_counts": "raw_counts",
    "raw_dim_skus": "raw_skus",
    "raw_dim_warehouses": "raw_warehouses",
    "raw_dim_suppliers": "raw_suppliers",
    "raw_dim_customers": "raw_customers",
    "stg_inventory_transactions_clean": "movement",
    "stg_inventory_snapshot_daily_clean": "snapshot",
    "stg_purchase_order_lines_clean": "po_lines",
    "stg_sales_order_lines_clean": "sales_lines",
    "stg_stock_counts_clean": "stock_counts",
    "stg_dim_product_latest": "product",
    "stg_dim_warehouse_latest": "warehouse",
    "stg_dim_supplier_latest": "supplier_dim",
    "stg_dim_customer_latest": "customer_dim",
    "stg_dim_date": "dates",
    "fact_inventory_movement": "movement",
    "fact_inventory_snapshot_daily": "snapshot",
    "fact_purchase_order_lines": "po_lines",
    "fact_sales_order_lines": "sales_lines",
    "fact_stock_counts": "stock_counts",
    "dim_product": "product",
    "dim_warehouse": "warehouse",
    "dim_supplier": "supplier_dim",
    "dim_customer": "customer_dim",
    "dim_date": "dates",
    "inventory_transactions": "raw_tx",
    "inventory_snapshot_daily": "snapshot",
    "purchase_order_lines": "raw_po_lines",
    "sales_order_lines": "raw_sales_lines",
    "stock_counts": "raw_counts",
}


def whole(cte: str) -> str:
    return query(f"SELECT * FROM {cte}")


def counts_row(names: list[str]) -> str:
    return query("SELECT " + ", ".join(f"(SELECT count(*) FROM {NAMES[n]}) AS {n}" for n in names))


def counts_rows(names: list[str], populated: bool = False) -> str:
    extra = ", count(*) > 0 AS populated" if populated else ""
    parts = [f"SELECT '{n}' AS tbl, count(*) AS cnt{extra} FROM {NAMES[n]}" for n in names]
    return query(" UNION ALL ".join(parts))


def reconcile(tables: dict[str, tuple[str, str, str]]) -> str:
    parts = [
        f"""SELECT '{n}' AS "table", (SELECT count(*) FROM {a}) AS source_rows,
        (SELECT count(*) FROM {b}) AS raw_rows, (SELECT count(*) FROM {c}) AS mart_rows,
        (SELECT count(*) FROM {a}) - (SELECT count(*) FROM {c}) AS difference"""
        for n, (a, b, c) in tables.items()
    ]
    return query(" UNION ALL ".join(parts))


def alerts(kpis: dict[str, str]) -> str:
    """States of KPIs whose queries are given; each is a statement of one value."""
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS kpi, cast((SELECT * FROM ({sql}) q) AS double) AS value"
        for n, sql in kpis.items()
    )
    return f"""SELECT k.kpi, k.value, r.threshold::double AS threshold,
      CASE WHEN k.value IS NULL THEN 'no data' WHEN k.value >= r.threshold THEN r.from_here
        ELSE r.below END AS state
    FROM ({rows}) k JOIN (VALUES {ALERT_RULES}) r(kpi, threshold, below, from_here) ON r.kpi = k.kpi"""


def violations() -> str:
    clean_po = "(SELECT *, upper(trim(sku_id)) AS k FROM raw_po_lines)"
    parts: list[tuple[str, str, str]] = []

    def rows(table: str, source: str, rule: str, broken: str) -> None:
        parts.append((table, rule, f"SELECT count(*) FROM {source} t WHERE {broken}"))

    def parent(table: str, source: str, key: str, other: str, other_key: str, rule: str) -> None:
        broken = f"NOT EXISTS (SELECT 1 FROM {other} o WHERE o.{other_key} = t.{key})"
        rows(table, source, rule, broken)

    def unique(table: str, source: str, keys: str, rule: str) -> None:
        again = f"SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1"
        parts.append((table, rule, f"SELECT count(*) FROM ({again}) d"))

    tx, snap, po, so = (
        "inventory_transactions", "inventory_snapshot_daily", "purchase_order_lines",
        "sales_order_lines",
    )
    rows(tx, "clean_tx", "quantity is not zero", "qty_change = 0")
    rows(tx, "clean_tx", "type is known",
         "event_type NOT IN ('RECEIPT', 'SHIPMENT', 'RETURN', 'ADJUSTMENT')")
    rows(snap, "snapshot", "quantities are not negative",
         "least(on_hand_qty, reserved_qty, damaged_qty, in_transit_qty, available_qty) < 0")
    rows(po, clean_po, "ordered quantity is positive", "qty_ordered <= 0")
    rows(po, clean_po, "received is between zero and ordered",
         "qty_received < 0 OR qty_received > qty_ordered")
    rows(po, clean_po, "line status is known",
         "line_status NOT IN ('OPEN', 'PARTIAL', 'CLOSED', 'CANCELLED')")
    rows(so, "raw_sales_lines", "quantity is positive", "qty <= 0")
    rows("sales_orders", "sales_orders", "status is known",
         "status NOT IN ('OPEN', 'SHIPPED', 'CANCELLED')")
    rows("suppliers", "raw_suppliers", "lead time is not negative", "lead_time_days < 0")
    rows("suppliers", "raw_suppliers", "rating is between 0 and 5", "rating < 0 OR rating > 5")
    rows("inventory_transfers", "transfers", "warehouses differ",
         "from_warehouse_id = to_warehouse_id")
    rows("inventory_transfers", "transfers", "status is known",
         "status NOT IN ('REQUESTED', 'PICKING', 'IN_TRANSIT', 'RECEIVED', 'CANCELLED')")
    rows("purchase_orders", "purchase_orders", "status is known",
         "status NOT IN ('DRAFT', 'OPEN', 'PARTIAL', 'RECEIVED', 'CLOSED', 'CANCELLED')")
    rows("inventory_transfer_lines", "transfer_lines", "quantity is positive", "qty <= 0")
    for name, source in (("stock_counts", "stock_counts"), ("daily_movements", "daily")):
        parent(name, source, "sku_id", "product", "sku_id", "sku exists")
        parent(name, source, "warehouse_id", "raw_warehouses", "warehouse_id", "warehouse exists")
    for name, source in ((snap, "snapshot"), ("purchase_orders", "purchase_orders")):
        parent(name, source, "warehouse_id", "raw_warehouses", "warehouse_id", "warehouse exists")
    for side, word in (("from", "source"), ("to", "target")):
        parent("inventory_transfers", "transfers", f"{side}_warehouse_id", "raw_warehouses",
               "warehouse_id", f"{word} warehouse exists")
    parent("inventory_transfer_lines", "transfer_lines", "sku_id", "product", "sku_id",
           "sku exists")
    unique("daily_movements", "daily", "movement_date, warehouse_id, sku_id", "key is unique")
    unique("calendar", "dates", "full_date", "day is unique")
    parent(tx, "clean_tx", "warehouse_id", "raw_warehouses", "warehouse_id", "warehouse exists")
    parent(tx, "clean_tx", "sku_id", "product", "sku_id", "sku exists")
    parent(snap, "snapshot", "sku_id", "product", "sku_id", "sku exists")
    parent(po, clean_po, "po_id", "purchase_orders", "po_id", "order exists")
    parent(po, clean_po, "k", "product", "sku_id", "sku exists")
    parent(so, "raw_sales_lines", "order_id", "sales_orders", "order_id", "order exists")
    parent(so, "raw_sales_lines", "sku_id", "product", "sku_id", "sku exists")
    parent("sales_orders", "sales_orders", "customer_id", "raw_customers", "customer_id",
           "customer exists")
    parent("sales_orders", "sales_orders", "warehouse_id", "raw_warehouses", "warehouse_id",
           "warehouse exists")
    parent("purchase_orders", "purchase_orders", "supplier_id", "raw_suppliers", "supplier_id",
           "supplier exists")
    parent("inventory_transfer_lines", "transfer_lines", "transfer_id", "transfers",
           "transfer_id", "transfer exists")
    unique(so, "raw_sales_lines", "order_id, line_no", "order and line are unique")
    unique(po, "raw_po_lines", "po_id, line_no", "order and line are unique")
    unique(snap, "snapshot", "snapshot_date, warehouse_id, sku_id", "key is unique")
    unique("sales_orders", "sales_orders", "order_number", "number is unique")
    unique("purchase_orders", "purchase_orders", "po_number", "number is unique")
    unique("inventory_transfers", "transfers", "transfer_ref", "reference is unique")
    unique("skus", "(SELECT upper(trim(sku_id)) AS sku_id FROM raw_skus)", "sku_id",
           "key is unique")
    unique("suppliers", "raw_suppliers", "supplier_id", "key is unique")
    return query(" UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{r}' AS rule, ({sql}) AS violations""" for t, r, sql in parts
    ))


ITEM = """s.sku_name, s.category AS sku_category"""
ITEM_WIDE = f"{ITEM}, s.subcategory AS sku_subcategory, s.brand AS sku_brand"


def v_transactions() -> str:
    return query(f"""SELECT t.event_time, cast(t.event_time AS date) AS event_date, dd.date_key,
      t.warehouse_id, w.warehouse_name, w.city AS warehouse_city, w.region AS warehouse_region,
      t.sku_id, {ITEM}, s.unit_cost AS sku_unit_cost, t.event_type, t.qty_change,
      cast(CASE WHEN t.qty_change > 0 THEN t.qty_change ELSE 0 END AS int) AS qty_in,
      cast(CASE WHEN t.qty_change < 0 THEN abs(t.qty_change) ELSE 0 END AS int) AS qty_out_abs,
      cast(t.qty_change * s.unit_cost AS decimal(18,4)) AS value_change_estimated
    FROM clean_tx t JOIN warehouse w ON w.warehouse_id = t.warehouse_id
    JOIN product s ON s.sku_id = t.sku_id
    LEFT JOIN dates dd ON dd.full_date = cast(t.event_time AS date)""")


PO_TOTALS = """(SELECT po.*, agg.total_amount FROM purchase_orders po LEFT JOIN
  (SELECT po_id, cast(sum(cast(qty_ordered * unit_cost AS decimal(18,2))) AS decimal(18,2))
     AS total_amount FROM raw_po_lines GROUP BY 1) agg ON agg.po_id = po.po_id)"""


def po_totals() -> str:
    return query(f"SELECT * FROM {PO_TOTALS} t")


def v_po_lines() -> str:
    return query(f"""SELECT l.po_line_id, l.po_id, po.po_number, po.order_date,
      po.status AS po_status, po.expected_delivery_date, po.currency,
      po.total_amount AS po_total_amount, v.supplier_id, v.supplier_name,
      v.country AS supplier_country, v.rating AS supplier_rating, v.lead_time_days,
      w.warehouse_id, w.warehouse_name, w.region AS warehouse_region, l.line_no, l.sku_id, {ITEM},
      l.qty_ordered, l.qty_received, l.unit_cost,
      cast(l.qty_ordered * l.unit_cost AS decimal(18,2)) AS line_amount, l.line_status,
      l.qty_ordered - l.qty_received AS qty_open
    FROM raw_po_lines l JOIN {PO_TOTALS} po ON po.po_id = l.po_id
    JOIN supplier_dim v ON v.supplier_id = po.supplier_id
    JOIN warehouse w ON w.warehouse_id = po.warehouse_id
    JOIN product s ON s.sku_id = l.sku_id""")


def v_transfers() -> str:
    return query(f"""SELECT t.transfer_id, t.transfer_ref, t.status AS transfer_status,
      t.requested_at, t.completed_at, a.warehouse_id AS from_warehouse_id,
      a.warehouse_name AS from_warehouse_name, a.region AS from_region,
      b.warehouse_id AS to_warehouse_id, b.warehouse_name AS to_warehouse_name,
      b.region AS to_region, l.transfer_line_id, l.sku_id, {ITEM}, l.qty AS transfer_qty
    FROM transfers t JOIN warehouse a ON a.warehouse_id = t.from_warehouse_id
    JOIN warehouse b ON b.warehouse_id = t.to_warehouse_id
    JOIN transfer_lines l ON l.transfer_id = t.transfer_id
    JOIN product s ON s.sku_id = l.sku_id""")


def v_daily() -> str:
    return query(f"""SELECT f.movement_date, dd.date_key, f.warehouse_id, w.warehouse_name,
      w.region AS warehouse_region, f.sku_id, {ITEM}, f.gross_receipt_qty, f.shipment_qty,
      f.return_qty, f.adjustment_net_qty, f.net_qty_change, f.transaction_rows
    FROM daily f JOIN warehouse w ON w.warehouse_id = f.warehouse_id
    JOIN product s ON s.sku_id = f.sku_id LEFT JOIN dates dd ON dd.full_date = f.movement_date""")


def v_sales_lines() -> str:
    return query(f"""SELECT so.order_id, so.order_number, so.order_date, dd.date_key,
      so.status AS order_status, so.customer_id, c.customer_name, c.segment AS customer_segment,
      c.region AS customer_region, so.warehouse_id, w.warehouse_name,
      w.region AS warehouse_region, l.so_line_id, l.line_no, l.sku_id, {ITEM_WIDE}, l.qty,
      l.unit_price, cast(l.qty * l.unit_price AS decimal(18,2)) AS line_amount
    FROM sales_orders so JOIN raw_sales_lines l ON l.order_id = so.order_id
    JOIN customer_dim c ON c.customer_id = so.customer_id
    JOIN warehouse w ON w.warehouse_id = so.warehouse_id
    JOIN product s ON s.sku_id = l.sku_id LEFT JOIN dates dd ON dd.full_date = so.order_date""")


def v_stock_counts() -> str:
    return query(f"""SELECT t.count_id, t.count_date, dd.date_key, t.warehouse_id,
      w.warehouse_name, w.region AS warehouse_region, t.sku_id, {ITEM_WIDE}, t.system_qty,
      t.counted_qty, t.variance_qty,
      cast(t.variance_qty * s.unit_cost AS decimal(18,4)) AS variance_value_estimated
    FROM raw_counts t JOIN warehouse w ON w.warehouse_id = t.warehouse_id
    JOIN product s ON s.sku_id = t.sku_id LEFT JOIN dates dd ON dd.full_date = t.count_date""")


def v_snapshot() -> str:
    return query(f"""SELECT t.snapshot_date, dd.date_key, t.warehouse_id, w.warehouse_name,
      w.region AS warehouse_region, t.sku_id, {ITEM_WIDE}, s.uom, s.reorder_point,
      s.safety_stock, s.max_stock, t.on_hand_qty, t.reserved_qty, t.available_qty, t.damaged_qty,
      t.in_transit_qty, t.inventory_value
    FROM snapshot t JOIN warehouse w ON w.warehouse_id = t.warehouse_id
    JOIN product s ON s.sku_id = t.sku_id LEFT JOIN dates dd ON dd.full_date = t.snapshot_date""")


def text_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def wire_snapshot() -> str:
    return query(f"""SELECT strftime(t.snapshot_date, '%Y-%m-%d') AS snapshot_date,
      t.warehouse_id, t.sku_id, t.on_hand_qty, t.reserved_qty, t.damaged_qty, t.in_transit_qty,
      t.available_qty, cast(s.unit_cost AS double) AS unit_cost,
      cast(t.inventory_value AS double) AS inventory_value, {text_time('t.created_at')}
        AS created_at
    FROM snapshot t LEFT JOIN product s ON s.sku_id = t.sku_id""")


EVENT_ROWS = f"""SELECT concat('WH0', cast(user_id % 5 + 1 AS varchar)) AS warehouse_id,
      concat('SKU_', lpad(json_extract_string(props, '$.k'), 6, '0')) AS sku_id,
      cast(CASE WHEN event_type IN ('signup', 'view') THEN ceil(value) ELSE -ceil(value) END
        AS int) AS qty_change,
      date_trunc('second', ts) AS event_time, {INGESTED} AS ingestion_time
    FROM events WHERE event_type <> 'error'"""


def event_totals() -> str:
    return f"""SELECT warehouse_id, sku_id, cast(event_time AS date) AS event_date,
      count(*) AS movement_count, cast(sum(qty_change) AS bigint) AS net_qty_change
    FROM ({EVENT_ROWS}) e GROUP BY 1, 2, 3"""


def list_conversations(limit: int, offset: int) -> str:
    return query(f"""SELECT conversation_id, min(turn) AS started_at,
      coalesce(arg_min(message, turn), '') AS first_message
    FROM msgs GROUP BY 1 ORDER BY max(turn) DESC, conversation_id LIMIT {limit} OFFSET {offset}""")


def history_page(page: int, size: int) -> str:
    first = (page - 1) * size
    return query(f"""SELECT conversation_id, cast(position AS int) AS position, turn, sender,
      message, total > {first + size} AS has_more,
      cast(CASE WHEN total > {first + size} THEN {first + size} END AS int) AS next_offset
    FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY turn) AS position,
                 count(*) OVER (PARTITION BY conversation_id) AS total FROM msgs) m
    WHERE position BETWEEN {first + 1} AND {first + size}""")


SPACE = (
    "[\\t\\n\\x0B\\f\\r \\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}"
    "\\x{205F}\\x{3000}\\x{FEFF}]+"
)


def compact(column: str) -> str:
    return f"trim(regexp_replace(coalesce({column}, ''), '{SPACE}', ' ', 'g'))"


def context_tail(n: int) -> str:
    text = f"regexp_replace(coalesce(message, ''), '^{SPACE}|{SPACE}$', '', 'g')"
    return query(f"""SELECT conversation_id, turn,
      CASE lower(sender) WHEN 'user' THEN 'user' ELSE 'assistant' END AS role, {text} AS content
    FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY turn DESC) AS age
          FROM msgs) m
    WHERE age <= {n} AND lower(sender) IN ('user', 'assistant', 'bot') AND {text} <> ''""")


def label_intent() -> str:
    folded = "strip_accents(lower(coalesce(message, '')))"
    whens = "".join(
        " WHEN " + " OR ".join(f"contains(folded, '{w}')" for w in words) + f" THEN '{name}'"
        for name, words in INTENTS.items()
    )
    return query(f"""SELECT conversation_id, turn, CASE{whens} ELSE 'help' END AS intent
    FROM (SELECT conversation_id, turn, {folded} AS folded FROM msgs) m""")


def extract_ids() -> str:
    def first(pattern: str, prefix: str) -> str:
        edge = r"[^\pL\pN_]"
        found = f"regexp_extract(coalesce(message, ''), '(?i)(^|{edge}){pattern}($|{edge})', 2)"
        return f"CASE WHEN {found} <> '' THEN concat('{prefix}', {found}) END"

    return query(f"""SELECT conversation_id, turn,
      {first(r'SKU[_-]?(\d{3})', 'SKU_')} AS sku_id, {first(r'WH(\d{2})', 'WH')} AS warehouse_id
    FROM msgs""")


def snippets() -> str:
    return query(f"""SELECT conversation_id, turn,
      CASE WHEN length(text) > 88 THEN concat(substring(text, 1, 87), '...')
        WHEN text = '' THEN 'New chat' ELSE text END AS snippet
    FROM (SELECT conversation_id, turn, {compact('message')} AS text FROM msgs) m""")


def calendar_full_names() -> str:
    return query("SELECT * REPLACE (dayname(full_date) AS day_name) FROM dates")


def snapshot_zero_opening() -> str:
    """Daily balances that start at zero, for pairs that moved inside the window."""
    return query(f"""SELECT snapshot_date, b.warehouse_id, b.sku_id,
      cast(greatest(balance, 0) AS int) AS on_hand_qty,
      cast(greatest(balance, 0) * cast(p_retailprice AS decimal(18,2)) AS decimal(18,2))
        AS inventory_value
    FROM (SELECT snapshot_date, pairs.warehouse_id, pairs.sku_id,
            sum(coalesce(net.n, 0)) OVER (PARTITION BY pairs.warehouse_id, pairs.sku_id
              ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING) AS balance
          FROM (SELECT DISTINCT warehouse_id, sku_id FROM movement
                WHERE event_date BETWEEN {AS_OF} - 120 AND {AS_OF}) pairs
          CROSS JOIN (SELECT cast(d AS date) AS snapshot_date
                      FROM generate_series({AS_OF} - 120, {AS_OF}, INTERVAL 1 DAY) g(d)) days
          LEFT JOIN (SELECT event_date, warehouse_id, sku_id, sum(qty_change) AS n FROM movement
                     GROUP BY 1, 2, 3) net
            ON net.event_date = snapshot_date AND net.warehouse_id = pairs.warehouse_id
            AND net.sku_id = pairs.sku_id) b
    JOIN part ON concat('SKU_', lpad(cast(p_partkey AS varchar), 6, '0')) = b.sku_id""")


def prune_tail_duplicates() -> str:
    """Walk every conversation in order and carry the last kept message along."""
    text = compact("text")
    duplicate = """m.sender = 'assistant' AND w.kept_sender = 'assistant'
      AND length(m.body) >= 8 AND length(w.kept) > length(m.body) + 8
      AND ends_with(w.kept, m.body)"""
    return f"""WITH RECURSIVE m AS (
      SELECT conv_id, turn, role AS sender, text AS message, {text} AS body,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
    w AS (
      SELECT conv_id, n, sender AS kept_sender, body AS kept, true AS keep FROM m WHERE n = 1
      UNION ALL
      SELECT m.conv_id, m.n,
        CASE WHEN {duplicate} THEN w.kept_sender ELSE m.sender END,
        CASE WHEN {duplicate} THEN w.kept ELSE m.body END,
        NOT coalesce({duplicate}, false)
      FROM w JOIN m ON m.conv_id = w.conv_id AND m.n = w.n + 1)
    SELECT m.conv_id AS conversation_id, m.turn, m.sender, m.message
    FROM m JOIN w ON w.conv_id = m.conv_id AND w.n = m.n WHERE w.keep"""
