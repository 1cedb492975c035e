"""Check queries of the planning figures, the roll-up stream and the restricted mart."""

from __future__ import annotations

from stocklens.oracle.base import AS_OF, query, ratio

#: Deliveries of the event log: number, day of the log, and the last two of each five days.
DELIVERED = """
  e AS (SELECT *, least(date_diff('day', (SELECT min(cast(ts AS date)) FROM events), cast(ts AS date)), 29) AS d FROM events),
  sent AS (SELECT *, event_id % 10 = 2 AND d // 5 + 3 <= 5 AS too_late FROM e WHERE event_type <> 'error')"""


def rollup() -> str:
    """Totals of all events but the too late ones, of days that end two days before the newest event."""
    return f"""WITH {DELIVERED}
    SELECT * FROM (SELECT cast(date_trunc('day', ts) AS timestamp) AS window_start,
      concat('WH0', cast(user_id % 5 + 1 AS varchar)) AS warehouse_id,
      concat('SKU_', lpad(json_extract_string(props, '$.k'), 6, '0')) AS sku_id, count(*) AS movement_count,
      cast(sum(CASE WHEN event_type IN ('signup', 'view') THEN 1 ELSE -1 END * cast(ceil(value) AS int)) AS bigint)
        AS net_qty_change
    FROM sent WHERE NOT too_late GROUP BY 1, 2, 3) t
    WHERE window_start + INTERVAL 3 DAY <= (SELECT max(ts) FROM sent)"""


def turnover() -> str:
    per_category = f"""SELECT coalesce(p.category, 'Unknown') AS category,
        cast(sum(coalesce(sold, 0) * cents) AS bigint) AS cogs, cast(sum(coalesce(held, 0) * cents) AS bigint) AS value_days
      FROM (SELECT sku_id, sum(on_hand_qty) AS held FROM snapshot GROUP BY 1) s
      FULL JOIN (SELECT sku_id, sum(qty) AS sold FROM sales_lines
                 WHERE created_date BETWEEN {AS_OF} - 120 AND {AS_OF} GROUP BY 1) l USING (sku_id)
      JOIN (SELECT concat('SKU_', lpad(cast(p_partkey AS varchar), 6, '0')) AS sku_id,
                   cast(round(cast(p_retailprice AS decimal(18,2)) * 100) AS bigint) AS cents FROM part) c USING (sku_id)
      LEFT JOIN product p USING (sku_id) GROUP BY 1"""
    return query(f"""SELECT category, cast(cast(cogs AS decimal(38,0)) / 100 AS decimal(38,2)) AS cogs,
      {ratio('value_days::hugeint', '12100::hugeint')} AS avg_inventory_value,
      {ratio('cogs::hugeint * 121', 'value_days::hugeint', 4)} AS turnover,
      {ratio('value_days::hugeint', 'cogs::hugeint')} AS days_of_inventory
    FROM ({per_category})""")


def transfer_turnaround() -> str:
    return query("""SELECT from_warehouse_id, to_warehouse_id, count(days) AS completed,
      count(*) - count(days) AS open, cast(quantile_disc(days, 0.5) AS int) AS p50_days,
      cast(quantile_disc(days, 0.9) AS int) AS p90_days, CASE WHEN count(days) > 0 THEN true END AS within_bound
    FROM (SELECT *, date_diff('day', requested_at, completed_at) AS days FROM transfers) GROUP BY 1, 2""")


def month_over_month() -> str:
    pct = ratio("abs(cast(change * 10000 AS hugeint))", "cast(previous_value * 100 AS hugeint)")
    return query(f"""SELECT month, snapshot_date, inventory_value, previous_value, change,
      CASE WHEN change < 0 THEN -1 ELSE 1 END * {pct} AS change_pct
    FROM (SELECT *, cast(inventory_value - previous_value AS decimal(38,2)) AS change
      FROM (SELECT *, lag(inventory_value) OVER (ORDER BY month) AS previous_value
        FROM (SELECT cast(date_trunc('month', snapshot_date) AS date) AS month, snapshot_date,
                cast(sum(inventory_value) AS decimal(38,2)) AS inventory_value
              FROM snapshot
              WHERE snapshot_date IN (SELECT max(snapshot_date) FROM snapshot GROUP BY date_trunc('month', snapshot_date))
              GROUP BY 1, 2)))""")


def movement_margins() -> str:
    return query("""SELECT m.warehouse_id, coalesce(p.category, 'Unknown') AS category,
      cast(grouping(m.warehouse_id, coalesce(p.category, 'Unknown')) AS int) AS level,
      cast(sum(qty_in) AS bigint) AS qty_in, cast(sum(qty_out) AS bigint) AS qty_out, count(*) AS movement_rows
    FROM movement m LEFT JOIN product p ON p.sku_id = m.sku_id
    GROUP BY CUBE (m.warehouse_id, coalesce(p.category, 'Unknown'))""")


#: Days taken out of the snapshot and days written twice, by the number of the SKU.
NUMBER = "cast(substr(sku_id, 5) AS int)"
MISSING = f"warehouse_id = 'WH01' AND ({NUMBER} + dayofyear(snapshot_date)) % 17 < 3"
TWICE = f"{NUMBER} % 23 = 5 AND day(snapshot_date) = 15"


def snapshot_issues() -> str:
    """Gaps as runs of absent days of the whole grid, which the operator does not build."""
    return query(f"""
    SELECT * FROM (
      WITH planted AS (
        SELECT warehouse_id, sku_id, snapshot_date FROM snapshot WHERE NOT ({MISSING})
        UNION ALL SELECT warehouse_id, sku_id, snapshot_date FROM snapshot WHERE {TWICE}),
      pairs AS (SELECT warehouse_id, sku_id, min(snapshot_date) AS a, max(snapshot_date) AS b, count(*) AS n
                FROM planted GROUP BY 1, 2),
      absent AS (
        SELECT warehouse_id, sku_id, g.snapshot_date,
               g.snapshot_date - cast(row_number() OVER (PARTITION BY warehouse_id, sku_id ORDER BY g.snapshot_date) AS int) AS run
        FROM pairs CROSS JOIN day_grid g ANTI JOIN planted USING (warehouse_id, sku_id, snapshot_date))
      SELECT warehouse_id, sku_id, 'gap' AS issue, min(snapshot_date) AS first_day, max(snapshot_date) AS last_day, count(*) AS row_count
      FROM absent GROUP BY warehouse_id, sku_id, run
      UNION ALL SELECT warehouse_id, sku_id, 'duplicate', snapshot_date, snapshot_date, count(*) - 1
      FROM planted GROUP BY ALL HAVING count(*) > 1
      UNION ALL SELECT warehouse_id, sku_id, 'no warehouse', a, b, n FROM pairs ANTI JOIN warehouse USING (warehouse_id)
      UNION ALL SELECT warehouse_id, sku_id, 'no category', a, b, n FROM pairs
      ANTI JOIN (SELECT sku_id FROM product WHERE category <> '') USING (sku_id))""")


def receipt_ratio() -> str:
    return query(f"""SELECT coalesce(o.supplier_id, 'Unknown') AS supplier_id, count(*) AS line_count,
      cast(sum(l.qty_ordered) AS bigint) AS qty_ordered, cast(sum(l.qty_received) AS bigint) AS qty_received,
      cast(sum(l.qty_ordered) - sum(l.qty_received) AS bigint) AS variance_qty,
      {ratio('sum(l.qty_received) * 100', 'sum(l.qty_ordered)')} AS receipt_pct
    FROM po_lines l LEFT JOIN purchase_orders o ON o.po_id = l.po_id GROUP BY 1""")


def overdue_orders() -> str:
    return query(f"""SELECT o.supplier_id, count(DISTINCT o.po_id) AS overdue_orders,
      count(*) FILTER (WHERE l.qty_open > 0) AS open_lines, cast(coalesce(sum(l.qty_open), 0) AS bigint) AS open_qty,
      min(o.expected_delivery_date) AS oldest_expected_date,
      cast({AS_OF} - min(o.expected_delivery_date) AS int) AS max_days_overdue
    FROM purchase_orders o LEFT JOIN po_lines l ON l.po_id = o.po_id
    WHERE o.expected_delivery_date < {AS_OF} AND o.status IN ('OPEN', 'PARTIAL') GROUP BY 1""")


def aging_by(dimension: str) -> str:
    """Bucket names are written out, so that they do not come from the operator."""
    return query(f"""SELECT coalesce({dimension}, 'Unknown') AS {dimension.split('.')[-1]},
      CASE WHEN s.days_since_movement <= 30 THEN '0-30 days' WHEN s.days_since_movement <= 60 THEN '31-60 days'
        WHEN s.days_since_movement <= 90 THEN '61-90 days' ELSE '90+ days' END AS aging_bucket,
      count(*) AS pair_count, cast(sum(s.inventory_value) AS decimal(38,2)) AS aging_value
    FROM aging s LEFT JOIN product p ON p.sku_id = s.sku_id GROUP BY 1, 2""")
