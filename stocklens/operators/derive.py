"""Derivations on the operational tables: daily snapshot, daily movements, reporting views."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIR = ["warehouse_id", "sku_id"]
DEFAULT_DAYS = 120
MIN_DAYS = 7


def build_snapshot(
    tx: DataFrame,
    skus: DataFrame,
    as_of: date,
    days_back: int | None = DEFAULT_DAYS,
    shelf_rule: dict[str, Column] | None = None,
    opening: str | DataFrame = "zero",
) -> DataFrame:
    """Dense daily stock per warehouse and SKU over ``[as_of - days_back, as_of]``: the days of ``stock_runs``."""
    return fill_days(stock_runs(tx, skus, as_of, days_back, shelf_rule, opening))


def stock_runs(
    tx: DataFrame,
    skus: DataFrame,
    as_of: date,
    days_back: int | None = DEFAULT_DAYS,
    shelf_rule: dict[str, Column] | None = None,
    opening: str | DataFrame = "zero",
) -> DataFrame:
    """Stock per warehouse and SKU as runs of days (``valid_from`` to ``valid_to``) on which it is the same,
    over ``[as_of - days_back, as_of]``. The runs of a pair do not overlap and have no gaps.

    ``opening="zero"`` starts every balance at zero and lists the pairs that moved inside the
    window; ``opening="history"`` carries the balance of all earlier movements in. A frame of
    balances (``closing_balances`` of the day before the window) gives the same as the history
    without reading it.
    ``shelf_rule`` gives reserved, damaged and in-transit quantities as columns.

    Movements are summed per day on the map side before they are shuffled, so a hot pair holds
    at most one row per day of the window. The balance after each of these days lasts until the
    next one. All values are computed per run; ``fill_days`` only repeats them.
    """
    carried = isinstance(opening, DataFrame)
    if not carried and opening not in ("zero", "history"):
        raise ValueError(f"unknown opening: {opening}")
    days = days_back if days_back is not None and days_back >= MIN_DAYS else DEFAULT_DAYS
    first, last = F.lit(as_of - timedelta(days=days)), F.lit(as_of)
    day = F.to_date("event_time")
    moves = tx.filter(day <= last).select(*PAIR, day.alias("day"), "qty_change")
    if opening != "history":
        moves = moves.filter(F.col("day") >= first)
    if carried:
        start = opening.select(*PAIR, F.date_sub(first, 1).alias("day"), "balance")
        moves = moves.unionByName(start.withColumnRenamed("balance", "qty_change"))
    # Everything before the window counts as one movement on the day before it.
    net = moves.groupBy(*PAIR, F.greatest("day", F.date_sub(first, 1)).alias("day")).agg(
        F.sum("qty_change").alias("net")
    )
    by_day = Window.partitionBy(*PAIR).orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    changes = net.select(
        *PAIR, "day",
        F.sum("net").over(so_far).alias("balance"),
        F.lag("day").over(by_day).isNull().alias("is_first"),
        F.coalesce(F.date_sub(F.lead("day").over(by_day), 1), last).alias("until"),
    )
    # A pair that first moves after the window's first day has an empty run before that.
    moved = F.struct(F.greatest("day", first).alias("valid_from"), F.col("until").alias("valid_to"), F.lit(True).alias("moved"))
    empty = F.struct(first.alias("valid_from"), F.date_sub("day", 1).alias("valid_to"), F.lit(False).alias("moved"))
    late_start = F.col("is_first") & (F.col("day") > first)
    runs = (
        changes.filter(F.col("until") >= first)
        .join(skus.select("sku_id", "unit_cost"), "sku_id")
        .withColumn("run", F.explode(F.when(late_start, F.array(empty, moved)).otherwise(F.array(moved))))
    )
    balance = F.when(F.col("run.moved"), F.col("balance")).otherwise(0)
    rule = shelf_rule or {}
    zero = F.lit(0)
    stocked = F.col("balance") > 0

    def rule_of(name: str) -> Column:
        return rule.get(name, zero)

    return (
        runs.withColumn("balance", balance)
        .withColumns(
            {
                "on_hand_qty": F.greatest("balance", zero).cast("int"),
                "reserved_qty": F.when(stocked, rule_of("reserved_qty")).otherwise(0).cast("int"),
                "damaged_qty": F.when(stocked, rule_of("damaged_qty")).otherwise(0).cast("int"),
                "in_transit_qty": rule_of("in_transit_qty").cast("int"),
                "unit_cost": F.coalesce("unit_cost", zero).cast("decimal(18,2)"),
            }
        )
        .select(
            "run.valid_from", "run.valid_to", *PAIR,
            "on_hand_qty", "reserved_qty", "damaged_qty", "in_transit_qty",
            F.greatest(F.col("on_hand_qty") - F.col("reserved_qty") - F.col("damaged_qty"), zero)
            .cast("int").alias("available_qty"),
            (F.col("on_hand_qty") * F.col("unit_cost")).cast("decimal(18,2)")
            .alias("inventory_value"),
            "unit_cost",
        )
    )


def fill_days(runs: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """One row for each day of each run, the day in place of ``valid_from`` and ``valid_to``."""
    every = F.explode(F.sequence("valid_from", "valid_to")).alias(day)
    return runs.select(*[every if c == "valid_from" else c for c in runs.columns if c != "valid_to"])


def is_runs(rows: DataFrame) -> bool:
    return {"valid_from", "valid_to"} <= set(rows.columns)


def clipped(runs: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """The part of each run from ``first`` to ``last``; runs without a day in it are left out."""
    runs = runs.filter(F.col("valid_from") <= F.col("valid_to"))
    start = F.greatest("valid_from", F.lit(first)) if first else F.col("valid_from")
    end = F.least("valid_to", F.lit(last)) if last else F.col("valid_to")
    return runs.withColumns({"valid_from": start, "valid_to": end}).filter(F.col("valid_from") <= F.col("valid_to"))


def cut_runs(runs: DataFrame, days: int) -> DataFrame:
    """Runs cut where blocks of ``days`` days meet; ``block`` numbers the blocks."""
    start = F.date_from_unix_date(F.col("block") * days)
    return runs.withColumn("block", F.explode(block_numbers(days))).withColumns(
        {
            "valid_from": F.greatest("valid_from", start),
            "valid_to": F.least("valid_to", F.date_add(start, days - 1)),
        }
    )


def block_numbers(days: int) -> Column:
    """The blocks that a run touches."""
    first, last = (F.floor(F.unix_date(c) / days).cast("int") for c in ("valid_from", "valid_to"))
    return F.sequence(first, last)


def closing_balances(tx: DataFrame, day: date, earlier: DataFrame | None = None) -> DataFrame:
    """Signed balance of every pair at the end of a day.

    ``earlier`` is an older result; then ``tx`` holds the movements since, and nothing older.
    """
    moves = tx.filter(F.to_date("event_time") <= F.lit(day)).select(*PAIR, "qty_change")
    if earlier is not None:
        moves = moves.unionByName(earlier.withColumnRenamed("balance", "qty_change"))
    return moves.groupBy(*PAIR).agg(F.sum("qty_change").alias("balance"))


def _by_true_type() -> list[Column]:
    kind, q = F.col("event_type"), F.col("qty_change")

    def total(condition: Column, value: Column, name: str) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("bigint").alias(name)

    return [
        total((kind == "RECEIPT") & (q > 0), q, "gross_receipt_qty"),
        total(kind == "SHIPMENT", F.abs(q), "shipment_qty"),
        total((kind == "RETURN") & (q > 0), q, "return_qty"),
        total(kind == "ADJUSTMENT", q, "adjustment_net_qty"),
        F.sum(q).cast("bigint").alias("net_qty_change"),
        F.count(F.lit(1)).alias("transaction_rows"),
    ]


def daily_movements(tx: DataFrame) -> DataFrame:
    """Movements per day, warehouse and SKU, split by the source's own movement type."""
    return tx.groupBy(F.to_date("event_time").alias("movement_date"), *PAIR).agg(*_by_true_type())


def line_amount(lines: DataFrame, qty: str, price: str) -> DataFrame:
    amount = (F.col(qty) * F.col(price)).cast("decimal(18,2)")
    return lines.withColumn("line_amount", amount)


def po_totals(po: DataFrame, lines: DataFrame) -> DataFrame:
    """Purchase orders with the total of their lines; NULL for an order without lines."""
    total = (
        line_amount(lines, "qty_ordered", "unit_cost")
        .groupBy("po_id")
        .agg(F.sum("line_amount").cast("decimal(18,2)").alias("total_amount"))
    )
    return po.join(total, "po_id", "left")


def _site(warehouse: DataFrame, prefix: str = "", key: str = "warehouse_id") -> DataFrame:
    return warehouse.select(
        F.col("warehouse_id").alias(key),
        F.col("warehouse_name").alias(f"{prefix}warehouse_name"),
        F.col("city").alias(f"{prefix}warehouse_city"),
        F.col("region").alias(f"{prefix}warehouse_region"),
    )


def _item(product: DataFrame) -> DataFrame:
    return product.select(
        "sku_id", "sku_name",
        F.col("category").alias("sku_category"),
        F.col("subcategory").alias("sku_subcategory"),
        F.col("brand").alias("sku_brand"),
        F.col("unit_cost").alias("sku_unit_cost"),
        "uom", "reorder_point", "safety_stock", "max_stock",
    )


def _dated(df: DataFrame, dates: DataFrame, column: str) -> DataFrame:
    key = dates.select(F.col("full_date").alias(column), "date_key")
    return df.join(key, column, "left")


def v_transactions(
    tx: DataFrame, warehouse: DataFrame, product: DataFrame, dates: DataFrame
) -> DataFrame:
    q = F.col("qty_change")
    rows = tx.withColumn("event_date", F.to_date("event_time"))
    return (
        _dated(rows, dates, "event_date")
        .join(_site(warehouse), "warehouse_id")
        .join(_item(product), "sku_id")
        .select(
            *[c for c in ("stream_seq", "transaction_id") if c in tx.columns],
            "event_time", "event_date", "date_key",
            "warehouse_id", "warehouse_name", "warehouse_city", "warehouse_region",
            "sku_id", "sku_name", "sku_category", "sku_unit_cost", "event_type", "qty_change",
            F.when(q > 0, q).otherwise(0).alias("qty_in"),
            F.when(q < 0, -q).otherwise(0).alias("qty_out_abs"),
            (q * F.col("sku_unit_cost")).cast("decimal(18,4)").alias("value_change_estimated"),
        )
    )


def v_po_lines(
    po: DataFrame, lines: DataFrame, supplier: DataFrame, warehouse: DataFrame, product: DataFrame
) -> DataFrame:
    """Purchase lines with order, supplier, warehouse and SKU; the open quantity may be negative."""
    header = po_totals(po, lines).select(
        "po_id", "po_number", "order_date", F.col("status").alias("po_status"),
        "expected_delivery_date", "currency", F.col("total_amount").alias("po_total_amount"),
        "supplier_id", "warehouse_id",
    )
    vendor = supplier.select(
        "supplier_id", "supplier_name", F.col("country").alias("supplier_country"),
        F.col("rating").alias("supplier_rating"), "lead_time_days",
    )
    return (
        line_amount(lines, "qty_ordered", "unit_cost")
        .join(header, "po_id")
        .join(vendor, "supplier_id")
        .join(_site(warehouse), "warehouse_id")
        .join(_item(product), "sku_id")
        .select(
            "po_line_id", "po_id", "po_number", "order_date", "po_status",
            "expected_delivery_date", "currency", "po_total_amount",
            "supplier_id", "supplier_name", "supplier_country", "supplier_rating",
            "lead_time_days", "warehouse_id", "warehouse_name", "warehouse_region",
            "line_no", "sku_id", "sku_name", "sku_category",
            "qty_ordered", "qty_received", "unit_cost", "line_amount", "line_status",
            (F.col("qty_ordered") - F.col("qty_received")).alias("qty_open"),
        )
    )


def v_transfers(
    transfers: DataFrame, lines: DataFrame, warehouse: DataFrame, product: DataFrame
) -> DataFrame:
    return (
        transfers.join(lines, "transfer_id")
        .join(_site(warehouse, "from_", "from_warehouse_id"), "from_warehouse_id")
        .join(_site(warehouse, "to_", "to_warehouse_id"), "to_warehouse_id")
        .join(_item(product), "sku_id")
        .select(
            "transfer_id", "transfer_ref", F.col("status").alias("transfer_status"),
            "requested_at", "completed_at",
            "from_warehouse_id", "from_warehouse_name",
            F.col("from_warehouse_region").alias("from_region"),
            "to_warehouse_id", "to_warehouse_name",
            F.col("to_warehouse_region").alias("to_region"),
            "transfer_line_id", "sku_id", "sku_name", "sku_category",
            F.col("qty").alias("transfer_qty"),
        )
    )


def v_daily_fact(
    daily: DataFrame, warehouse: DataFrame, product: DataFrame, dates: DataFrame
) -> DataFrame:
    """Stored daily movements with names and date key."""
    return (
        _dated(daily, dates, "movement_date")
        .join(_site(warehouse), "warehouse_id")
        .join(_item(product), "sku_id")
        .select(
            "movement_date", "date_key", "warehouse_id", "warehouse_name", "warehouse_region",
            "sku_id", "sku_name", "sku_category",
            "gross_receipt_qty", "shipment_qty", "return_qty", "adjustment_net_qty",
            "net_qty_change", "transaction_rows",
        )
    )


def v_daily_metrics(
    tx: DataFrame, warehouse: DataFrame, product: DataFrame, dates: DataFrame
) -> DataFrame:
    """Daily movements computed from the movements themselves.

    Names depend on the keys alone, so the roll-up comes first and the joins see far fewer rows.
    """
    return v_daily_fact(daily_movements(tx), warehouse, product, dates)


def v_customers(customer: DataFrame) -> DataFrame:
    return customer.select("customer_id", "customer_name", "segment", "city", "region")


def v_sales_lines(
    orders: DataFrame,
    lines: DataFrame,
    customer: DataFrame,
    warehouse: DataFrame,
    product: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    buyer = customer.select(
        "customer_id", "customer_name", F.col("segment").alias("customer_segment"),
        F.col("region").alias("customer_region"),
    )
    header = orders.withColumnRenamed("status", "order_status").join(buyer, "customer_id")
    return (
        line_amount(lines, "qty", "unit_price")
        .join(_dated(header, dates, "order_date"), "order_id")
        .join(_site(warehouse), "warehouse_id")
        .join(_item(product), "sku_id")
        .select(
            "order_id", "order_number", "order_date", "date_key", "order_status",
            "customer_id", "customer_name", "customer_segment", "customer_region",
            "warehouse_id", "warehouse_name", "warehouse_region", "so_line_id", "line_no",
            "sku_id", "sku_name", "sku_category", "sku_subcategory", "sku_brand",
            "qty", "unit_price", "line_amount",
        )
    )


def v_stock_counts(
    counts: DataFrame, warehouse: DataFrame, product: DataFrame, dates: DataFrame
) -> DataFrame:
    value = (F.col("variance_qty") * F.col("sku_unit_cost")).cast("decimal(18,4)")
    return (
        _dated(counts, dates, "count_date")
        .join(_site(warehouse), "warehouse_id")
        .join(_item(product), "sku_id")
        .select(
            *[c for c in ("count_id",) if c in counts.columns],
            "count_date", "date_key", "warehouse_id", "warehouse_name", "warehouse_region",
            "sku_id", "sku_name", "sku_category", "sku_subcategory", "sku_brand",
            "system_qty", "counted_qty", "variance_qty",
            value.alias("variance_value_estimated"),
        )
    )


def v_snapshot(
    snapshot: DataFrame, warehouse: DataFrame, product: DataFrame, dates: DataFrame
) -> DataFrame:
    return (
        _dated(snapshot, dates, "snapshot_date")
        .join(_site(warehouse), "warehouse_id")
        .join(_item(product), "sku_id")
        .select(
            "snapshot_date", "date_key", "warehouse_id", "warehouse_name", "warehouse_region",
            "sku_id", "sku_name", "sku_category", "sku_subcategory", "sku_brand", "uom",
            "reorder_point", "safety_stock", "max_stock",
            "on_hand_qty", "reserved_qty", "available_qty", "damaged_qty", "in_transit_qty",
            "inventory_value",
        )
    )
