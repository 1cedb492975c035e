"""Check queries of dashboard panels and reports."""

from __future__ import annotations

from stocklens.operators.dashboards.aging import BUCKETS
from stocklens.operators.filters import NO_FILTERS, Filters
from stocklens.oracle.base import (
    AS_OF, CATEGORY, DIMS, LOW, NOW, OVER, SKU_NAME, STATUS, WAREHOUSE, cash, count_if, long,
    query, ratio, status_in, where,
)

ALL = "WRCBK"


def options(column: str, table: str, condition: str = "true") -> str:
    return query(f"SELECT DISTINCT {column} AS value FROM {table} WHERE {condition}")


def kpi(value: str, f: Filters = NO_FILTERS, name: str = "value") -> str:
    return query(f"SELECT {value} AS {name} FROM latest s {DIMS} WHERE true{where(f, ALL)}")


def value_by_warehouse(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT {WAREHOUSE}, {cash('s.inventory_value')} AS inventory_value
    FROM latest s {DIMS} WHERE true{where(f, ALL)} GROUP BY 1""")


def status_rows(f: Filters) -> str:
    return f"""(SELECT s.warehouse_id, s.sku_id, {WAREHOUSE}, {SKU_NAME}, {CATEGORY},
      coalesce(p.brand, 'Unknown') AS brand, s.on_hand_qty, s.available_qty, s.reserved_qty,
      p.reorder_point, p.max_stock, s.inventory_value, {STATUS} AS stock_status
    FROM latest s {DIMS} WHERE true{where(f, ALL)}) st"""


def stock_status(f: Filters = NO_FILTERS) -> str:
    return query(f"SELECT * FROM {status_rows(f)}")


def status_distribution(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT stock_status, count(*) AS sku_count FROM {status_rows(f)}
    WHERE true{status_in(f)} GROUP BY 1""")


def low_stock_by_warehouse(f: Filters = NO_FILTERS) -> str:
    shown = "true" if f.stock_status is None or "Low stock" in f.stock_status else "false"
    site = where(Filters(warehouse=f.warehouse, region=f.region), "WR", "w")
    return query(f"""SELECT coalesce(w.warehouse_name, w.warehouse_id) AS warehouse,
      {count_if(f'{shown} AND {LOW}')} AS low_stock_items
    FROM warehouse w LEFT JOIN latest s ON s.warehouse_id = w.warehouse_id
    LEFT JOIN product p ON p.sku_id = s.sku_id
    WHERE true{site}{where(f, 'CBK')} GROUP BY 1""")


def below_reorder_count(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT count(*) AS value FROM {status_rows(f)}
    WHERE reorder_point > 0 AND available_qty < reorder_point{status_in(f)}""")


def exception_matrix(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT warehouse, sku_id, sku_name, category, brand, on_hand_qty,
      available_qty, reserved_qty, reorder_point, max_stock, stock_status, inventory_value
    FROM {status_rows(f)} WHERE stock_status <> 'Healthy'{status_in(f)}
    ORDER BY CASE stock_status WHEN 'Stockout' THEN 0 WHEN 'Low stock' THEN 1 ELSE 2 END,
      inventory_value DESC, warehouse_id, sku_id LIMIT 200""")


def zero_stock_with_demand(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT warehouse, st.sku_id, sku_name, category, available_qty, sold_qty_30d
    FROM {status_rows(f)}
    JOIN (SELECT sku_id, {long('qty')} AS sold_qty_30d FROM sales_lines
          WHERE created_date >= {AS_OF} - 30 GROUP BY 1) d ON d.sku_id = st.sku_id
    WHERE available_qty <= 0 ORDER BY sold_qty_30d DESC, st.sku_id, warehouse_id LIMIT 30""")


def largest_overstock(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT warehouse, sku_id, sku_name, category, available_qty, max_stock,
      available_qty - max_stock AS excess_qty, inventory_value
    FROM {status_rows(f)} WHERE stock_status = 'Overstock'
    ORDER BY excess_qty DESC, inventory_value DESC, warehouse_id, sku_id LIMIT 30""")


def avg_daily_sold(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT {ratio('coalesce(sum(s.qty), 0)', '30')} AS value FROM sales_lines s
    LEFT JOIN product p ON p.sku_id = s.sku_id
    WHERE s.created_date >= {AS_OF} - 30{where(f, 'CBK')}""")


def inbound_outbound(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT s.event_date AS time, {long('s.qty_in')} AS inbound_qty,
      {long('s.qty_out')} AS outbound_qty
    FROM movement s {DIMS} WHERE s.event_date >= {AS_OF} - 90{where(f, ALL)} GROUP BY 1""")


def receiving_dispatch(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT {WAREHOUSE}, {long('s.qty_in')} AS received_qty,
      {long('s.qty_out')} AS dispatched_qty
    FROM movement s {DIMS} WHERE s.event_date >= {AS_OF} - 30{where(f, ALL)} GROUP BY 1""")


def top_movers(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT s.sku_id, {SKU_NAME}, {CATEGORY}, {long('s.qty_in')} AS qty_in,
      {long('s.qty_out')} AS qty_out, {long('abs(s.qty_change)')} AS movement_volume,
      {cash('abs(s.qty_change) * p.unit_cost')} AS movement_value_proxy
    FROM movement s {DIMS} WHERE s.event_date >= {AS_OF} - 30{where(f, ALL)}
    GROUP BY 1, 2, 3 ORDER BY movement_volume DESC, s.sku_id LIMIT 20""")


def slow_movers(f: Filters = NO_FILTERS) -> str:
    days = "date_diff('day', coalesce(m.moved, s.snapshot_date), s.snapshot_date)"
    return query(f"""SELECT s.warehouse_id, s.sku_id, {SKU_NAME}, {CATEGORY},
      cast(s.available_qty AS bigint) AS available_qty,
      cast(s.inventory_value AS decimal(38,2)) AS inventory_value, m.moved AS last_event_date,
      cast({days} AS int) AS days_since_last_movement,
      CASE WHEN {days} >= 30 THEN 'No movement >=30d' ELSE 'Slowest recent movers' END
        AS movement_flag
    FROM latest s {DIMS}
    LEFT JOIN (SELECT warehouse_id, sku_id, max(event_date) AS moved FROM movement GROUP BY 1, 2) m
      ON m.warehouse_id = s.warehouse_id AND m.sku_id = s.sku_id
    WHERE s.available_qty > 0{where(f, ALL)}
    ORDER BY CASE WHEN {days} >= 30 THEN 0 ELSE 1 END, {days} DESC, s.inventory_value DESC,
      s.warehouse_id, s.sku_id LIMIT 20""")


def open_po(value: str, f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT {value} AS value FROM po_lines s
    LEFT JOIN product p ON p.sku_id = s.sku_id WHERE s.qty_open > 0{where(f, 'CBK')}""")


def avg_lead_time() -> str:
    return query(
        f"SELECT {ratio('sum(lead_time_days)', 'count(lead_time_days)')} AS value FROM supplier_dim"
    )


def suggested_reorder_qty(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT {long('greatest(p.max_stock - s.available_qty, 0)')} AS value
    FROM latest s {DIMS} WHERE {LOW}{where(f, ALL)}""")


def supplier_sla(f: Filters = NO_FILTERS) -> str:
    chosen = ""
    if f.supplier is not None:
        chosen = f" AND supplier_name IN ({', '.join(repr(v) for v in f.supplier)})"
    fast = "count(*) FILTER (WHERE lead_time_days <= 7)"
    return query(f"""SELECT coalesce({ratio(fast, 'count(*)', 4)}, 0.0::double)
      AS supplier_on_time_sla_rate FROM supplier_dim WHERE true{chosen}""")


def _plan_rows(f: Filters) -> str:
    units = ratio("sum(qty)", "30").replace("/ 100.0::double", "")
    return f"""(SELECT s.sku_id, {SKU_NAME}, {CATEGORY}, s.available_qty, p.reorder_point,
      p.max_stock, coalesce(d.units, 0) AS units,
      cast(greatest(p.max_stock - s.available_qty, 0) AS bigint) AS recommended_reorder_qty
    FROM (SELECT s.sku_id, {long('s.available_qty')} AS available_qty FROM latest s {DIMS}
          WHERE true{where(f, ALL)} GROUP BY 1) s
    LEFT JOIN product p ON p.sku_id = s.sku_id
    LEFT JOIN (SELECT sku_id, {units} AS units FROM sales_lines
               WHERE created_date >= {AS_OF} - 30 GROUP BY 1) d ON d.sku_id = s.sku_id) plan"""


def replenishment_plan(f: Filters = NO_FILTERS) -> str:
    urgent = "(reorder_point > 0 AND available_qty < reorder_point)"
    cover = ratio("available_qty * 100", "units")
    return query(f"""SELECT sku_id, sku_name, category, available_qty, reorder_point, max_stock,
      units / 100.0::double AS avg_daily_demand, recommended_reorder_qty,
      CASE WHEN {urgent} THEN 'Urgent' ELSE 'Watch' END AS recommendation_priority,
      coalesce({cover}, 9999.0::double) AS days_of_cover
    FROM {_plan_rows(f)} WHERE reorder_point > 0 OR max_stock > 0
    ORDER BY CASE WHEN {urgent} THEN 0 ELSE 1 END, recommended_reorder_qty DESC, units DESC, sku_id
    LIMIT 50""")


def stock_cover(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT sku_id, sku_name, category, available_qty, units / 100.0::double AS avg_daily_demand,
      {ratio("available_qty * 100", "units")} AS days_of_cover FROM {_plan_rows(f)}""")


def urgent_replenishment() -> str:
    return query(f"""SELECT sku_id, sku_name, category, available_qty, reorder_point, max_stock,
      units / 100.0::double AS avg_daily_demand, recommended_reorder_qty
    FROM {_plan_rows(NO_FILTERS)} WHERE reorder_point > 0 AND available_qty < reorder_point
    ORDER BY recommended_reorder_qty DESC, units DESC, sku_id LIMIT 50""")


def _range(column: str, f: Filters) -> str:
    last = f"DATE '{f.time_to}'" if f.time_to else AS_OF
    first = f"DATE '{f.time_from}'" if f.time_from else f"{last} - 45"
    return f"{column} >= {first} AND {column} <= {last}"


def po_trend(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT cast(s.created_date AS timestamp) AS time,
      {long('s.qty_open')} AS open_qty, {long('s.qty_received')} AS received_qty
    FROM po_lines s LEFT JOIN product p ON p.sku_id = s.sku_id
    WHERE {_range('s.created_date', f)}{where(f, 'CBK')} GROUP BY 1""")


def _bucket() -> str:
    whens = "".join(
        f" WHEN days_since_movement <= {last} THEN '{name}'" for name, last in BUCKETS if last
    )
    return f"CASE{whens} ELSE '{BUCKETS[-1][0]}' END"


def aging_buckets() -> str:
    names = ", ".join(f"('{name}')" for name, _ in BUCKETS)
    return query(f"""SELECT b.aging_bucket,
      cast(coalesce(v.aging_value, 0) AS decimal(38,2)) AS aging_value
    FROM (VALUES {names}) b(aging_bucket)
    LEFT JOIN (SELECT {_bucket()} AS bucket, sum(inventory_value) AS aging_value FROM aging
               GROUP BY 1) v ON v.bucket = b.aging_bucket""")


def aging_buckets_present() -> str:
    return query(f"""SELECT {_bucket()} AS aging_bucket, {cash('inventory_value')} AS aging_value
    FROM aging GROUP BY 1""")


def aging_value(condition: str) -> str:
    value = f"CASE WHEN {condition} THEN inventory_value END"
    return query(f"SELECT {cash(value)} AS value FROM aging")


def _counts(f: Filters) -> str:
    return f"FROM stock_counts s {DIMS} WHERE s.count_date >= {AS_OF} - 60{where(f, ALL)}"


ACCURACY = ratio("100 * count(*) FILTER (WHERE s.variance_qty = 0)", "count(*)")
MEAN_VARIANCE = ratio("sum(abs(s.variance_qty))", "count(*)")


def count_accuracy(f: Filters = NO_FILTERS) -> str:
    return query(f"SELECT {ACCURACY} AS value {_counts(f)}")


def avg_abs_variance(f: Filters = NO_FILTERS) -> str:
    return query(f"SELECT {MEAN_VARIANCE} AS value {_counts(f)}")


def variance_trend(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT s.count_date AS time, {MEAN_VARIANCE} AS avg_abs_variance,
      {ACCURACY} AS accuracy_pct {_counts(f)} GROUP BY 1""")


def variance_by_warehouse(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT {WAREHOUSE}, count(*) AS count_events,
      {MEAN_VARIANCE} AS avg_abs_variance, {long('abs(s.variance_qty)')} AS total_abs_variance,
      {ACCURACY} AS accuracy_pct {_counts(f)} GROUP BY 1""")


def accuracy_by_warehouse() -> str:
    return query(f"SELECT {WAREHOUSE}, {ACCURACY} AS accuracy_pct {_counts(NO_FILTERS)} GROUP BY 1")


def aging_base(f: Filters = NO_FILTERS) -> str:
    return query(f"SELECT s.* FROM aging s {DIMS} WHERE true{where(f, ALL)}")


def top_dead_slow(f: Filters = NO_FILTERS, only: bool = False) -> str:
    label = ""
    if not only:
        label = """, CASE WHEN s.days_since_movement >= 30 THEN 'Dead/Slow >=30d'
          ELSE 'Top slow recent movers' END AS slow_moving_bucket"""
    condition = "s.days_since_movement >= 30" if only else "true"
    return query(f"""SELECT {WAREHOUSE}, s.sku_id, {SKU_NAME}, {CATEGORY}, s.available_qty,
      s.inventory_value, s.last_movement_date, s.days_since_movement{label}
    FROM aging s {DIMS} WHERE {condition}{where(f, ALL)}
    ORDER BY CASE WHEN s.days_since_movement >= 30 THEN 0 ELSE 1 END, s.days_since_movement DESC,
      s.inventory_value DESC, s.warehouse_id, s.sku_id LIMIT 25""")


def snapshot_lag_hours(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT
      cast(date_diff('second', max(s.ingestion_time), {NOW}) // 3600 AS bigint)
        AS snapshot_lag_hours
    FROM snapshot s {DIMS} WHERE true{where(f, ALL)}""")


def last_ingestion_millis() -> str:
    facts = ["snapshot", "movement", "po_lines", "sales_lines", "stock_counts"]
    union = " UNION ALL ".join(f"SELECT ingestion_time FROM {t}" for t in facts)
    return query(f"""SELECT cast(epoch_ms(max(ingestion_time)) AS bigint)
      AS last_mart_ingestion_time FROM ({union}) t""")


def data_quality_summary(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT count(*) AS total_rows,
      {count_if("p.category = '' OR p.category IS NULL")} AS missing_category_rows,
      {count_if("p.brand = '' OR p.brand IS NULL")} AS missing_brand_rows,
      {count_if('s.available_qty < 0')} AS negative_available_rows
    FROM latest s {DIMS} WHERE true{where(f, ALL)}""")


def sku_stock_trend(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT cast(s.snapshot_date AS timestamp) AS time,
      {long('s.available_qty')} AS available_qty, {long('s.on_hand_qty')} AS on_hand_qty
    FROM snapshot s WHERE {_range('s.snapshot_date', f)}{where(f, 'WK')} GROUP BY 1""")


def sku_sales_trend(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT cast(s.created_date AS timestamp) AS time, {long('s.qty')} AS sold_qty,
      {cash('s.sales_amount')} AS sales_amount
    FROM sales_lines s WHERE {_range('s.created_date', f)}{where(f, 'K')} GROUP BY 1""")


def sku_detail(f: Filters = NO_FILTERS) -> str:
    return query(f"""SELECT s.warehouse_id, s.sku_id, p.sku_name, p.category, p.brand,
      s.on_hand_qty, s.available_qty, p.reorder_point, p.max_stock, s.inventory_value
    FROM latest s {DIMS} WHERE true{where(f, 'WK')}
    ORDER BY s.inventory_value DESC, s.warehouse_id, s.sku_id LIMIT 50""")


def value_by_category() -> str:
    return query(f"""SELECT {CATEGORY}, {cash('s.inventory_value')} AS inventory_value
    FROM latest s {DIMS} GROUP BY 1""")


def top_gap(policy: str, condition: str, gap: str, name: str) -> str:
    return query(f"""SELECT {WAREHOUSE}, s.sku_id, {SKU_NAME}, {CATEGORY}, s.available_qty,
      p.{policy}, {gap} AS {name}, s.inventory_value
    FROM latest s {DIMS} WHERE {condition}
    ORDER BY {name} DESC, s.inventory_value DESC, s.warehouse_id, s.sku_id LIMIT 10""")


def idle_skus() -> str:
    return query(f"""SELECT s.sku_id, {SKU_NAME}, {CATEGORY}, s.available_qty, s.inventory_value,
      m.moved AS last_event_date
    FROM (SELECT sku_id, {long('available_qty')} AS available_qty,
                 {cash('inventory_value')} AS inventory_value FROM latest GROUP BY 1) s
    LEFT JOIN (SELECT sku_id, max(event_date) AS moved FROM movement GROUP BY 1) m
      ON m.sku_id = s.sku_id
    LEFT JOIN product p ON p.sku_id = s.sku_id
    WHERE s.available_qty > 0 AND (m.moved IS NULL OR m.moved < {AS_OF} - 30)
    ORDER BY s.inventory_value DESC, s.available_qty DESC, s.sku_id LIMIT 20""")


def inventory_overview() -> str:
    return query(f"""SELECT s.snapshot_date, {long('s.on_hand_qty')} AS total_on_hand_qty,
      {long('s.available_qty')} AS total_available_qty,
      {long('s.damaged_qty')} AS total_damaged_qty,
      {long('s.in_transit_qty')} AS total_in_transit_qty,
      {cash('s.inventory_value')} AS total_inventory_value,
      count(DISTINCT s.warehouse_id) AS warehouse_count, count(DISTINCT s.sku_id) AS sku_count,
      {count_if(LOW)} AS low_stock_sku_count, {count_if(OVER)} AS overstock_sku_count
    FROM latest s {DIMS} GROUP BY 1""")


def warehouse_summary(limit: int) -> str:
    return query(f"""SELECT s.warehouse_id,
      coalesce(w.warehouse_name, s.warehouse_id) AS warehouse_name, w.city, w.region,
      {long('s.on_hand_qty')} AS on_hand_qty, {long('s.available_qty')} AS available_qty,
      {cash('s.inventory_value')} AS inventory_value, {long('s.damaged_qty')} AS damaged_qty,
      {long('s.in_transit_qty')} AS in_transit_qty, {count_if(LOW)} AS low_stock_sku_count
    FROM latest s {DIMS} GROUP BY 1, 2, 3, 4
    ORDER BY inventory_value DESC, available_qty DESC, s.warehouse_id LIMIT {limit}""")


def alert_rows(policy: list[str], condition: str, gap: str, share: str, limit: int) -> str:
    shown = ", ".join(f"p.{c}" for c in policy)
    return query(f"""SELECT s.warehouse_id,
      coalesce(w.warehouse_name, s.warehouse_id) AS warehouse_name, s.sku_id, {SKU_NAME},
      p.category, p.brand, s.available_qty, {shown},
      {ratio('s.available_qty', f'p.{policy[0]}')} AS {share}, s.inventory_value
    FROM latest s {DIMS} WHERE {condition}
    ORDER BY {gap} DESC, s.inventory_value DESC, s.warehouse_id, s.sku_id LIMIT {limit}""")


def recent_movements(days: int, limit: int, condition: str = "true") -> str:
    return query(f"""SELECT event_date, warehouse_id, sku_id, count(*) AS movement_count,
      {long('qty_in')} AS qty_in, {long('qty_out')} AS qty_out,
      {long('qty_change')} AS net_qty_change, min(event_time) AS first_event_time,
      max(event_time) AS last_event_time
    FROM movement WHERE event_time >= {NOW} - INTERVAL {days} DAY AND {condition}
    GROUP BY 1, 2, 3
    ORDER BY event_date DESC, abs(net_qty_change) DESC, movement_count DESC, warehouse_id, sku_id
    LIMIT {limit}""")


def purchase_replenishment(limit: int) -> str:
    open_qty = "greatest(s.qty_ordered - s.qty_received, 0)"
    return query(f"""SELECT s.sku_id, {SKU_NAME}, p.category, p.brand,
      {long('s.qty_ordered')} AS qty_ordered, {long('s.qty_received')} AS qty_received,
      {long(open_qty)} AS qty_open, {cash(f'{open_qty} * s.unit_cost')} AS open_value,
      count(DISTINCT s.po_id) AS open_po_count, min(s.created_at) AS oldest_open_created_at
    FROM po_lines s LEFT JOIN product p ON p.sku_id = s.sku_id WHERE {open_qty} > 0
    GROUP BY 1, 2, 3, 4 ORDER BY qty_open DESC, open_value DESC, s.sku_id LIMIT {limit}""")


def health() -> str:
    return query("""SELECT true AS ok, (SELECT max(snapshot_date) FROM snapshot)
      AS latest_snapshot_date, (SELECT count(*) FROM snapshot) AS snapshot_rows,
      (SELECT count(*) FROM movement) AS movement_rows""")
