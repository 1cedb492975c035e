"""Every registered question: how Spark answers it, and the SQL that checks the answer."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions import timestamp_lit
from stocklens.operators import conversations as talk
from stocklens.operators import derive, filters, planning, quality, reports, staging
from stocklens.operators.access import ACCESS, restricted
from stocklens.operators.dashboards import (
    aging,
    executive,
    movement,
    reliability,
    replenishment,
    stock,
)
from stocklens.operators.filters import NO_FILTERS, Filters
from stocklens.operators.mart import TABLE_NAMES, Tables, conform, mart_counts, mart_frames
from stocklens.oracle import extensions as ox
from stocklens.oracle import layers as ol
from stocklens.oracle import panels as op
from stocklens.oracle.base import LOW, OVER, cash, count_if, long, query
from stocklens.plans.incremental import SNAPSHOT, IncrementalMart
from stocklens.plans.layout import overwrite, read_current, replace_window, write_by_day
from stocklens.plans.layout import write_layer
from stocklens.plans.pipeline import (
    SNAPSHOT_DAYS,
    STAGED,
    STAGING_TABLES,
    PublishedMart,
    published_mart,
    raw_frame,
    raw_runs,
    raw_snapshot,
    shared_folder,
    staged_frame,
)
from stocklens.schemas import MESSAGES
from stocklens.sources import extract, topics
from stocklens.sources.trade_tables import AS_OF, INGESTED, NOW, TradeTables, sample_shelf_rule
from stocklens.streaming.landing import start_landing, start_rejects, stream_refresh
from stocklens.streaming.rollup import ROLLUP, start_rollup

Query = Callable[[SparkSession, str], DataFrame]

# Chosen values for the filtered variants of panels.
SITES = Filters(region=("ASIA", "EUROPE"), category=("ECONOMY", "PROMO"))
GOODS = Filters(warehouse=("WH01", "WH03"), brand=("Brand#2", "Brand#17"))
STATUSES = Filters(stock_status=("Stockout", "Overstock"))
ONE_SKU = Filters(sku=("SKU_000007", "SKU_000010", "SKU_000049"))
SPRING = Filters(time_from=date(2001, 3, 1), time_to=date(2001, 5, 31))
VENDORS = Filters(supplier=("Supplier#000000003", "Supplier#000000005", "Supplier#000000020"))

_entries: dict[str, tuple[Query, str | None]] = {}


def _utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _add(name: str, run: Query, sql: str | None = None) -> None:
    _entries[name] = (run, sql)


def _mart(name: str, build: Callable[[PublishedMart], DataFrame], sql: str | None) -> None:
    _add(name, lambda spark, path: build(published_mart(_utc(spark), path)), sql)


def _source(name: str, build: Callable[[TradeTables], DataFrame], sql: str | None) -> None:
    _add(name, lambda spark, path: build(published_mart(_utc(spark), path).src), sql)


def _panel(name, build, sql, *variants: tuple[str, Filters]) -> None:
    """Register a panel unfiltered and once per chosen filter."""
    for suffix, f in (("", NO_FILTERS), *variants):
        _mart(name + suffix, lambda t, f=f: build(t, f), sql(f))


BY_SITE, BY_GOODS = ("_by_site", SITES), ("_by_goods", GOODS)


def work_folder(spark: SparkSession, purpose: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/stocklens/{app}/{purpose}-{uuid.uuid4().hex}"


# --- A: extract, landing and sinks -------------------------------------------------------------

LINE_MARK = 40_000
TIME_MARK = datetime(2001, 1, 1)


def newer_lines(src: TradeTables) -> DataFrame:
    return extract.incremental_read(src.po_lines, "po_line_id", LINE_MARK)[0]


def newer_mark(src: TradeTables) -> DataFrame:
    return extract.incremental_read(src.po_lines, "po_line_id", LINE_MARK)[1]


def newer_sales(src: TradeTables) -> DataFrame:
    return extract.incremental_read(src.sales_lines, "created_at", TIME_MARK)[0]


def outgoing_runs(src: TradeTables) -> DataFrame:
    runs = raw_runs(src).drop("ingestion_time")
    return extract.extract_snapshot(runs, staging.stg_product(src.skus))


# Rows of the nine inputs as the source holds them.
OUTGOING: dict[str, Callable[[TradeTables], DataFrame]] = {
    "inventory_topic": lambda src: src.transactions.drop("event_type", "ingestion_time"),
    "po_lines_topic": lambda src: src.po_lines.drop("ingestion_time"),
    "sales_lines_topic": lambda src: src.sales_lines.drop("ingestion_time"),
    "snapshot_topic": lambda src: derive.fill_days(outgoing_runs(src)),
    "stock_counts_topic": lambda src: src.stock_counts.drop("ingestion_time"),
    "dim_skus_topic": lambda src: src.skus,
    "dim_warehouses_topic": lambda src: src.warehouses,
    "dim_suppliers_topic": lambda src: src.suppliers,
    "dim_customers_topic": lambda src: src.customers,
}


FIRST_DAY = AS_OF - timedelta(days=SNAPSHOT_DAYS)


def wire_rows(src: TradeTables, topic: str) -> DataFrame:
    if topic == "snapshot_topic":
        return extract.wire_snapshot(outgoing_runs(src), FIRST_DAY, AS_OF)
    return extract.to_wire(OUTGOING[topic](src))


def messages(src: TradeTables, topic: str) -> DataFrame:
    """``to_messages`` of the wire rows."""
    if topic == "snapshot_topic":
        return topics.run_messages(extract.wire_runs(outgoing_runs(src)), FIRST_DAY, AS_OF)
    return topics.to_messages(wire_rows(src, topic))


def landed(src: TradeTables, topic: str) -> DataFrame:
    """Publish, read back and land the rows of one input."""
    return topics.land(messages(src, topic), topic, INGESTED)


def event_messages(src: TradeTables) -> DataFrame:
    """Movement messages of the event log; an error event gives a broken line."""
    rows = src.event_movements
    fields = ["warehouse_id", "sku_id", "qty_change", "event_time"]
    form = {"timestampFormat": topics.JSON_OPTIONS["timestampFormat"]}
    good = F.to_json(F.struct(*fields), form)
    broken = F.concat(F.lit('{"warehouse_id": "'), F.col("warehouse_id"), F.lit('", "sku'))
    return rows.select(
        F.when(F.col("kind") == "error", broken).otherwise(good).alias("value"), "event_time"
    )


def publish_events(src: TradeTables) -> str:
    """Write the event messages as line files by time; returns the topic folder's parent."""
    folder = work_folder(src.spark, "topic")
    by_time = event_messages(src).repartitionByRange(4, "event_time")
    by_time.select("value").write.text(f"{folder}/inventory_topic")
    return folder


def stream_events(src: TradeTables) -> str:
    """Land the event topic as a stream; returns the folder of the raw and reject tables."""
    folder = publish_events(src)
    for start, name in ((start_landing, "raw"), (start_rejects, "rejects")):
        messages = topics.read_topic(
            src.spark, "inventory_topic", folder=folder, files_per_trigger=2
        )
        args = [messages, "inventory_topic", f"{folder}/{name}", f"{folder}/{name}-checkpoint"]
        start(*args, *([INGESTED] if name == "raw" else [])).awaitTermination()
    return folder


RAW_EVENTS = MESSAGES["inventory_topic"] + ", ingestion_time timestamp"


def stream_landing(src: TradeTables) -> DataFrame:
    folder = stream_events(src)
    return src.spark.read.schema(RAW_EVENTS).parquet(f"{folder}/raw").drop("month")


def stream_rejects(src: TradeTables) -> DataFrame:
    folder = stream_events(src)
    return src.spark.read.schema("topic string, message string").parquet(f"{folder}/rejects")


def movement_totals(raw: DataFrame) -> DataFrame:
    rows = staging.stg_transactions(raw)
    return rows.groupBy("warehouse_id", "sku_id", "event_date").agg(
        F.count(F.lit(1)).alias("movement_count"),
        F.sum("qty_change").cast("bigint").alias("net_qty_change"),
    )


def refreshed_totals(src: TradeTables) -> DataFrame:
    """Mart totals that a stream over the raw table rebuilds after every batch."""
    spark, folder = src.spark, stream_events(src)
    raw = f"{folder}/raw"
    stream = spark.readStream.schema(RAW_EVENTS).parquet(raw)
    stream_refresh(
        stream, lambda _: movement_totals(spark.read.schema(RAW_EVENTS).parquet(raw)),
        f"{folder}/totals",
        f"{folder}/totals-checkpoint", every_seconds=None,
    ).awaitTermination()
    return read_current(spark, f"{folder}/totals")


def monthly_rows(src: TradeTables) -> DataFrame:
    """Rows per month read back from a monthly layout."""
    path = work_folder(src.spark, "layout")
    write_layer(staging.stg_stock_counts(src.stock_counts), path, "count_date", ["warehouse_id"])
    return (
        src.spark.read.parquet(path)
        .groupBy(F.col("month").cast("string").alias("month"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def full_refresh(src: TradeTables) -> DataFrame:
    path = work_folder(src.spark, "refresh")
    for _ in range(2):  # a second run replaces the first
        overwrite(staging.stg_customer(src.customers), path)
    return src.spark.read.parquet(path)


def replaced_window(t: PublishedMart) -> DataFrame:
    """A snapshot whose last three days, wrong at first, are replaced."""
    spark = t.spark
    path = work_folder(spark, "window")
    rows = t.snapshot.drop("created_at", "ingestion_time")
    in_window = F.col("snapshot_date") >= F.lit(AS_OF - timedelta(days=2))
    wrong = rows.withColumn("on_hand_qty", F.when(in_window, F.col("on_hand_qty") + 9).otherwise(F.col("on_hand_qty")))
    absent = in_window & (F.col("warehouse_id") == "WH02")
    sort = ["warehouse_id", "sku_id"]  # the published snapshot has the same layout
    write_by_day(wrong.filter(~absent), path, "snapshot_date", sort, placed=True)
    replace_window(rows, path, "snapshot_date", AS_OF - timedelta(days=2), AS_OF, sort, placed=True)
    return spark.read.parquet(path)


#: Raw facts: the time that polls go by, and the staging table.
POLLED = {
    "raw_inventory_transactions": ("event_time", "stg_inventory_transactions_clean"),
    "raw_inventory_snapshot_daily": ("snapshot_date", "stg_inventory_snapshot_daily_clean"),
    "raw_purchase_order_lines": ("created_at", "stg_purchase_order_lines_clean"),
    "raw_sales_order_lines": ("created_at", "stg_sales_order_lines_clean"),
    "raw_stock_counts": ("created_at", "stg_stock_counts_clean"),
}


def overlapping_polls(src: TradeTables, raw: str) -> DataFrame:
    """A fact staged from two polls whose second reads the last days of the first again."""
    time, staged = POLLED[raw]
    rows = raw_frame(src, raw)
    by_run = raw == "raw_inventory_snapshot_daily"  # polled and keyed as runs, filled in where they are written
    source = raw_runs(src) if by_run else rows
    mark = datetime(2001, 6, 1)
    first = derive.clipped(source, last=mark.date()) if by_run else rows.filter(F.col(time) <= timestamp_lit(mark))
    second, _ = extract.incremental_read(source, time, mark, overlap_seconds=20 * 86_400)
    landed = IncrementalMart(src.spark, work_folder(src.spark, "polls"), src.sku_costs)
    for poll in (first, second):
        if by_run:
            landed.upsert_days(raw, poll, time)
        else:
            landed.upsert(raw, extract.with_row_key(poll), extract.ROW_KEY, time, settled=True)  # the key holds the time
    return STAGED[staged][1](landed.table(raw).select(*rows.columns))


def published_topic(src: TradeTables) -> DataFrame:
    """Stock counts sent to a topic and landed from it."""
    folder, topic = work_folder(src.spark, "published"), "stock_counts_topic"
    topics.write_topic(wire_rows(src, topic), topic, folder=folder)
    return topics.land(src.spark.read.text(f"{folder}/{topic}"), topic, INGESTED)


def lowered(t: PublishedMart) -> Tables:
    """The mart with forty units less of everything, so that the monitors of negative stock fire."""
    whole = Tables(**{name: getattr(t, name) for name in Tables.__dataclass_fields__})
    less = (F.col("available_qty") - 40).cast("int")
    return replace(whole, snapshot=t.snapshot.withColumn("available_qty", less))


def refreshed_snapshot(t: PublishedMart) -> DataFrame:
    """The snapshot after three refreshes: most movements up to a day ten days ago, all of the days since,
    and then the rows of some products that are late, of any day."""
    moves, cut = t.movement.drop("month"), AS_OF - timedelta(days=10)
    early = F.col("event_date") <= F.lit(cut)
    late = early & (F.pmod(F.crc32(F.col("sku_id").cast("binary")), F.lit(10)) == 3)
    mart = IncrementalMart(
        t.spark, work_folder(t.spark, "incremental"), t.src.sku_costs, SNAPSHOT_DAYS, sample_shelf_rule()
    )
    for rows, day in ((early & ~late, cut), (~early, AS_OF), (late, AS_OF)):
        mart.refresh(moves.filter(rows), day)
    landed = {"created_at": timestamp_lit(INGESTED), "ingestion_time": timestamp_lit(INGESTED)}
    return mart.table(SNAPSHOT).withColumns(landed)


def _register_a() -> None:
    _source("a1_incremental_number", newer_lines,
            query(f"SELECT * FROM raw_po_lines WHERE po_line_id > {LINE_MARK}"))
    _source("a1_new_mark", newer_mark, query(
        f"""SELECT cast(greatest(max(po_line_id), {LINE_MARK}) AS bigint) AS mark
        FROM raw_po_lines WHERE po_line_id > {LINE_MARK}"""))
    _source("a2_incremental_time", newer_sales,
            query(f"SELECT * FROM raw_sales_lines WHERE created_at > TIMESTAMP '{TIME_MARK}'"))
    _source("a3_a4_wire_snapshot", lambda s: wire_rows(s, "snapshot_topic"), ol.wire_snapshot())
    _source("a8_land_movements", lambda s: landed(s, "inventory_topic"), query(
        """SELECT warehouse_id, sku_id, qty_change, event_time, ingestion_time FROM raw_tx"""))
    _source("a9_land_po_lines", lambda s: landed(s, "po_lines_topic"), ol.whole("raw_po_lines"))
    _source("a9_land_sales_lines", lambda s: landed(s, "sales_lines_topic"),
            ol.whole("raw_sales_lines"))
    _source("a9_land_snapshot", lambda s: landed(s, "snapshot_topic"), query(
        """SELECT t.* REPLACE (s.unit_cost AS unit_cost)
        FROM snapshot t LEFT JOIN product s ON s.sku_id = t.sku_id"""))
    _source("a9_land_stock_counts", lambda s: landed(s, "stock_counts_topic"),
            ol.whole("raw_counts"))
    for topic, cte in (("skus", "raw_skus"), ("warehouses", "raw_warehouses"),
                       ("suppliers", "raw_suppliers"), ("customers", "raw_customers")):
        rating = " REPLACE (cast(rating AS double) AS rating)" if topic == "suppliers" else ""
        _source(f"a10_land_dim_{topic}", lambda s, k=f"dim_{topic}_topic": landed(s, k),
                query(f"SELECT *{rating}, {ol.INGESTED} AS ingestion_time FROM {cte}"))
    _source("a6_stream_landing", stream_landing, ol.EVENT_ROWS)
    _source("a7_stream_rejects", stream_rejects,
            """SELECT 'inventory_topic' AS topic, concat('{"warehouse_id": "WH0',
              cast(user_id % 5 + 1 AS varchar), '", "sku') AS message
            FROM events WHERE event_type = 'error'""")
    _source("a14_stream_refresh", refreshed_totals, ol.event_totals())
    _source("a11_monthly_layout", monthly_rows, query(
        """SELECT strftime(count_date, '%Y-%m') AS month, count(*) AS cnt
        FROM stock_counts GROUP BY 1"""))
    _source("a12_full_refresh", full_refresh, ol.whole("customer_dim"))
    _mart("a13_swapped_table", lambda t: read_current(
        t.spark, f"{t.root}/{TABLE_NAMES['supplier']}") if t.supplier else None,
        ol.whole("supplier_dim"))
    for raw, (_, staged) in POLLED.items():
        _source(f"a2_overlapping_polls_{raw.removeprefix('raw_')}", lambda s, k=raw: overlapping_polls(s, k),
                ol.whole(ol.NAMES[staged]))
    _source("a5_published_topic", published_topic, ol.whole("raw_counts"))
    _mart("a15_sample_of_movements", lambda t: reports.sample_rows(t.movement, 500).agg(
        F.count(F.lit(1)).alias("n")), "SELECT cast(20 AS bigint) AS n")
    _mart("a15_sample_rows", lambda t: reports.sample_rows(t.warehouse, 20), ol.whole("warehouse"))


# --- B and C: staging and mart -----------------------------------------------------------------


def _register_b_c() -> None:
    names = {
        "b2_stg_transactions": "stg_inventory_transactions_clean",
        "b3_stg_snapshot": "stg_inventory_snapshot_daily_clean",
        "b4_stg_po_lines": "stg_purchase_order_lines_clean",
        "b5_stg_sales_lines": "stg_sales_order_lines_clean",
        "b6_stg_stock_counts": "stg_stock_counts_clean",
        "b7_stg_product": "stg_dim_product_latest",
        "b8_stg_warehouse": "stg_dim_warehouse_latest",
        "b9_stg_supplier": "stg_dim_supplier_latest",
        "b10_stg_customer": "stg_dim_customer_latest",
        "b11_calendar": "stg_dim_date",
    }
    for name, table in names.items():
        _source(name, lambda s, k=table: staged_frame(s, k), ol.whole(ol.NAMES[table]))
    # The snapshot window is landed again by every refresh: staged once all the same.
    _source("b3_stg_snapshot_landed_twice", lambda s: derive.fill_days(staging.stg_snapshot(
        raw_runs(s).unionByName(raw_runs(s)))), ol.whole(ol.NAMES["stg_inventory_snapshot_daily_clean"]))
    _source("b1_normalised_keys", lambda s: staging.normalise_keys(
        s.transactions, ["warehouse_id", "sku_id"]), ol.whole("clean_tx"))
    _source("b7_product_all_versions", lambda s: staging.stg_product(s.skus, dedupe=False)
            .select("sku_id", "sku_name", "brand", "created_at"), query(
        """SELECT upper(trim(sku_id)) AS sku_id, trim(sku_name) AS sku_name, trim(brand) AS brand,
          coalesce(try_cast(created_at AS timestamp), TIMESTAMP '1970-01-01') AS created_at
        FROM raw_skus"""))
    _source("b11_calendar_full_names", lambda s: staging.calendar(
        staging.days_around(s.sales_orders, "order_date"), full_day_names=True),
        ol.calendar_full_names())
    _source("b12_staging_counts", lambda s: staging.layer_counts(
        {n: staged_frame(s, n) for n in STAGING_TABLES}), ol.counts_row(list(names.values())))
    for i, (field, table) in enumerate(TABLE_NAMES.items(), 1):
        _mart(f"c{i}_{table}", lambda t, k=field, n=table: conform(getattr(t, k), n),
              ol.whole(ol.NAMES[table]))
    _mart("c11_mart_counts", mart_counts,
          ol.counts_row(list(TABLE_NAMES.values())))


# --- D: derivations ----------------------------------------------------------------------------


def conformed(src: TradeTables) -> DataFrame:
    return staging.normalise_keys(src.transactions, ["warehouse_id", "sku_id"])


def _view(name: str, build: Callable[[TradeTables, PublishedMart], DataFrame], sql: str) -> None:
    """A reporting view over operational tables with the published dimensions."""
    _mart(name, lambda t: build(t.src, t), sql)


def _register_d() -> None:
    _source("d1_daily_snapshot", lambda s: raw_snapshot(s), ol.whole("snapshot"))
    _source("d1_snapshot_zero_opening", lambda s: derive.build_snapshot(
        conformed(s), s.sku_costs, AS_OF).select(
        "snapshot_date", "warehouse_id", "sku_id", "on_hand_qty", "inventory_value"),
        ol.snapshot_zero_opening())
    _mart("d2_replace_window", replaced_window, query(
        "SELECT * EXCLUDE (created_at, ingestion_time) FROM snapshot"))
    _mart("d1_refreshed_snapshot", refreshed_snapshot, ol.whole("snapshot"))
    _source("d3_daily_movements", lambda s: derive.daily_movements(conformed(s)),
            ol.whole("daily"))
    _source("d4_po_totals", lambda s: derive.po_totals(s.purchase_orders, s.po_lines),
            ol.po_totals())
    _view("d5_v_transactions", lambda s, t: derive.v_transactions(
        conformed(s), t.warehouse, t.product, t.date), ol.v_transactions())
    _view("d6_v_po_lines", lambda s, t: derive.v_po_lines(
        s.purchase_orders, s.po_lines, t.supplier, t.warehouse, t.product), ol.v_po_lines())
    _view("d7_v_transfers", lambda s, t: derive.v_transfers(
        s.transfers, s.transfer_lines, t.warehouse, t.product), ol.v_transfers())
    _view("d8_v_daily_metrics", lambda s, t: derive.v_daily_metrics(
        conformed(s), t.warehouse, t.product, t.date), ol.v_daily())
    _view("d9_v_daily_fact", lambda s, t: derive.v_daily_fact(
        derive.daily_movements(conformed(s)), t.warehouse, t.product, t.date), ol.v_daily())
    _mart("d10_v_customers", lambda t: derive.v_customers(t.customer), query(
        "SELECT customer_id, customer_name, segment, city, region FROM customer_dim"))
    _view("d11_v_sales_lines", lambda s, t: derive.v_sales_lines(
        s.sales_orders, s.sales_lines, t.customer, t.warehouse, t.product, t.date),
        ol.v_sales_lines())
    _view("d12_v_stock_counts", lambda s, t: derive.v_stock_counts(
        s.stock_counts, t.warehouse, t.product, t.date), ol.v_stock_counts())
    _mart("d13_v_snapshot", lambda t: derive.v_snapshot(
        t.snapshot, t.warehouse, t.product, t.date), ol.v_snapshot())


# --- E: reports --------------------------------------------------------------------------------

ADHOC = """SELECT category, count(*) AS skus, max(unit_cost) AS top_cost
FROM {product} GROUP BY category ORDER BY category"""


def _register_e() -> None:
    r = reports
    _mart("e1_latest_snapshot_date", r.latest_snapshot_date,
          query("SELECT max(snapshot_date) AS snapshot_date FROM snapshot"))
    _mart("e2_product_dim", r.product_dim, query(
        """SELECT sku_id, sku_name, category, subcategory, brand, reorder_point, safety_stock,
          max_stock, unit_cost, selling_price, status, abc_class FROM product"""))
    _mart("e3_warehouse_dim", r.warehouse_dim,
          query("SELECT warehouse_id, warehouse_name, city, region FROM warehouse"))
    _mart("e4_inventory_overview", r.inventory_overview, op.inventory_overview())
    _mart("e5_warehouse_summary", r.warehouse_summary, op.warehouse_summary(5))
    low = (["reorder_point", "safety_stock"], LOW, "(p.reorder_point - s.available_qty)",
           "coverage_ratio")
    over = (["max_stock"], OVER, "(s.available_qty - p.max_stock)", "stock_ratio")
    _mart("e6_low_stock_alerts", r.low_stock_alerts, op.alert_rows(*low, 10))
    _mart("e7_overstock_alerts", r.overstock_alerts, op.alert_rows(*over, 10))
    _mart("e8_recent_movements", lambda t: r.recent_movements(t, NOW), op.recent_movements(7, 20))
    _mart("e8_recent_movements_of_site", lambda t: r.recent_movements(
        t, NOW, days=400, warehouse_id="wh02", limit=99),
        op.recent_movements(90, 50, "warehouse_id = 'WH02'"))
    _mart("e9_purchase_replenishment", r.purchase_replenishment, op.purchase_replenishment(10))
    parts = {
        "summary": op.inventory_overview(),
        "warehouse_summary": op.warehouse_summary(5),
        "low_stock_alerts": op.alert_rows(*low, 5),
        "overstock_alerts": op.alert_rows(*over, 5),
        "replenishment": op.purchase_replenishment(5),
    }
    for name, sql in parts.items():
        _mart(f"e10_summary_{name}", lambda t, k=name: r.dashboard_summary(t)[k], sql)
    _mart("e11_health", r.health, op.health())
    _mart("e12_readonly_sql", lambda t: r.readonly_sql(
        t.spark, ADHOC.format(product="dim_product"), {"dim_product": t.product}),
        query(ADHOC.format(product="product")))


# --- F and G: filters and panels ---------------------------------------------------------------


def _register_f() -> None:
    _mart("f1_region_options", filters.region_options,
          op.options("region", "warehouse", "region <> ''"))
    _mart("f2_warehouse_options", lambda t: filters.warehouse_options(t, SITES),
          op.options("warehouse_id", "warehouse", "region IN ('ASIA', 'EUROPE')"))
    _mart("f3_category_options", filters.category_options,
          op.options("category", "product", "category <> ''"))
    _mart("f4_brand_options", lambda t: filters.brand_options(t, SITES),
          op.options("brand", "product", "brand <> '' AND category IN ('ECONOMY', 'PROMO')"))
    _mart("f5_sku_options", lambda t: filters.sku_options(
        t, Filters(category=SITES.category, brand=GOODS.brand)),
        op.options("sku_id", "product",
                   "category IN ('ECONOMY', 'PROMO') AND brand IN ('Brand#2', 'Brand#17')"))
    _mart("f6_supplier_options", filters.supplier_options,
          op.options("supplier_name", "supplier_dim", "supplier_name <> ''"))
    _mart("f8_filtered_stock", lambda t: filters.with_dims(t.latest_snapshot(), t, SITES, "WRCBK")
          .select("warehouse_id", "sku_id", "available_qty"), query(
        """SELECT s.warehouse_id, s.sku_id, s.available_qty FROM latest s
        JOIN product p ON p.sku_id = s.sku_id JOIN warehouse w ON w.warehouse_id = s.warehouse_id
        WHERE w.region IN ('ASIA', 'EUROPE') AND p.category IN ('ECONOMY', 'PROMO')"""))
    _mart("f9_time_range", lambda t: filters.in_range(
        t.movement, "event_date", NO_FILTERS, AS_OF).groupBy("event_date").count()
        .withColumnRenamed("count", "cnt"), query(
        f"""SELECT event_date, count(*) AS cnt FROM movement
        WHERE event_date BETWEEN {ol.AS_OF} - 45 AND {ol.AS_OF} GROUP BY 1"""))


def _register_g1() -> None:
    x = executive
    _mart("g1_1_latest_snapshot_millis", x.latest_snapshot_millis, query(
        "SELECT cast(epoch_ms(cast(max(snapshot_date) AS timestamp)) AS bigint) AS value "
        "FROM snapshot"))
    for name, build, value in (
        ("g1_2_on_hand_total", x.on_hand_total, long("s.on_hand_qty")),
        ("g1_3_available_total", x.available_total, long("s.available_qty")),
        ("g1_4_value_total", x.value_total, cash("s.inventory_value")),
        ("g1_5_low_stock_count", x.low_stock_count, count_if(LOW)),
        ("g1_6_overstock_count", x.overstock_count, count_if(OVER)),
        ("g3_3_damaged_total", movement.damaged_total, long("s.damaged_qty")),
        ("g3_4_in_transit_total", movement.in_transit_total, long("s.in_transit_qty")),
        ("g2_4_negative_available_count", stock.negative_available_count,
         count_if("s.available_qty < 0")),
    ):
        _panel(name, build, lambda f, v=value: op.kpi(v, f), BY_SITE, BY_GOODS)
    _mart("g1_7_value_over_time", x.value_over_time, query(
        f"""SELECT snapshot_date AS time, {cash('inventory_value')} AS inventory_value
        FROM snapshot GROUP BY 1"""))
    _panel("g1_8_value_by_warehouse", x.value_by_warehouse, op.value_by_warehouse, BY_GOODS)


def _register_g2() -> None:
    by_status = ("_by_status", STATUSES)
    _panel("g2_0_stock_status", stock.stock_status, op.stock_status, BY_SITE)
    _panel("g2_1_status_distribution", stock.status_distribution, op.status_distribution,
           BY_GOODS, by_status)
    _panel("g2_2_low_stock_by_warehouse", stock.low_stock_by_warehouse, op.low_stock_by_warehouse,
           BY_SITE, by_status)
    _panel("g2_3_below_reorder_count", stock.below_reorder_count, op.below_reorder_count,
           BY_GOODS, by_status)
    _panel("g2_5_exception_matrix", stock.exception_matrix, op.exception_matrix, BY_SITE,
           by_status)
    _panel("g2_6_zero_stock_with_demand",
           lambda t, f: stock.zero_stock_with_demand(t, f, AS_OF), op.zero_stock_with_demand,
           BY_SITE)
    _panel("g2_7_largest_overstock", stock.largest_overstock, op.largest_overstock, BY_GOODS)


def _register_g3() -> None:
    m = movement
    _panel("g3_1_avg_daily_sold", lambda t, f: m.avg_daily_sold(t, f, AS_OF), op.avg_daily_sold,
           BY_GOODS)
    _panel("g3_5_inbound_outbound", lambda t, f: m.inbound_outbound(t, f, AS_OF),
           op.inbound_outbound, BY_SITE)
    _panel("g3_6_receiving_dispatch", lambda t, f: m.receiving_dispatch(t, f, AS_OF),
           op.receiving_dispatch, BY_GOODS)
    _panel("g3_7_top_movers", lambda t, f: m.top_movers(t, f, AS_OF), op.top_movers, BY_SITE)
    _panel("g3_8_slow_movers", m.slow_movers, op.slow_movers, BY_GOODS)


def _register_g4() -> None:
    p = replenishment
    _panel("g4_1_open_po_qty", p.open_po_qty, lambda f: op.open_po(long("s.qty_open"), f),
           BY_GOODS)
    _panel("g4_2_open_po_lines", p.open_po_lines,
           lambda f: op.open_po("cast(count(*) AS bigint)", f), BY_SITE)
    _mart("g4_3_avg_lead_time", p.avg_lead_time, op.avg_lead_time())
    _panel("g4_5_suggested_reorder_qty", p.suggested_reorder_qty, op.suggested_reorder_qty,
           BY_SITE)
    _panel("g4_6_supplier_sla", p.supplier_sla, op.supplier_sla, ("_by_supplier", VENDORS))
    _panel("g4_7_replenishment_plan", lambda t, f: p.replenishment_plan(t, f, AS_OF),
           op.replenishment_plan, BY_SITE)
    _panel("g4_8_po_trend", lambda t, f: p.po_trend(t, f, AS_OF), op.po_trend, BY_GOODS,
           ("_in_spring", SPRING))


def _register_g5() -> None:
    a = aging
    _panel("g5_0_aging_base", a.aging_base, op.aging_base, BY_SITE)
    _panel("g5_1_count_accuracy", lambda t, f: a.count_accuracy(t, f, AS_OF), op.count_accuracy,
           BY_SITE)
    _panel("g5_2_avg_abs_variance", lambda t, f: a.avg_abs_variance(t, f, AS_OF),
           op.avg_abs_variance, BY_GOODS)
    _mart("g5_3_dead_stock_value", a.dead_stock_value, op.aging_value("days_since_movement > 90"))
    _mart("g5_4_slow_moving_value", a.slow_moving_value,
          op.aging_value("days_since_movement BETWEEN 31 AND 90"))
    _mart("g5_5_aging_buckets", a.aging_buckets, op.aging_buckets())
    _panel("g5_6_variance_trend", lambda t, f: a.variance_trend(t, f, AS_OF), op.variance_trend,
           BY_SITE)
    _panel("g5_7_top_dead_slow", a.top_dead_slow, op.top_dead_slow, BY_GOODS)
    _panel("g5_8_variance_by_warehouse", lambda t, f: a.variance_by_warehouse(t, f, AS_OF),
           op.variance_by_warehouse, BY_SITE)


def _register_g6_g7() -> None:
    d = reliability
    _panel("g6_1_negative_stock_rows", d.negative_stock_rows, lambda f: op.kpi(
        count_if("s.available_qty < 0"), f, "negative_stock_rows"))
    _panel("g6_2_snapshot_lag_hours", lambda t, f: d.snapshot_lag_hours(t, f, NOW),
           op.snapshot_lag_hours, BY_SITE)
    _mart("g6_3_last_ingestion_millis", d.last_ingestion_millis, op.last_ingestion_millis())
    _panel("g6_4_data_quality_summary", d.data_quality_summary, op.data_quality_summary, BY_GOODS)
    _panel("g6_5_sku_stock_trend", lambda t, f: d.sku_stock_trend(t, f, AS_OF),
           op.sku_stock_trend, ("_of_skus", ONE_SKU))
    _panel("g6_6_sku_sales_trend", lambda t, f: d.sku_sales_trend(t, f, AS_OF),
           op.sku_sales_trend, ("_of_skus", ONE_SKU), ("_in_spring", SPRING))
    _panel("g6_7_sku_detail", d.sku_detail, op.sku_detail, ("_of_skus", ONE_SKU))
    below = "s.available_qty - 40 < 0"
    _mart("g2_4_negative_available_fires", lambda t: stock.negative_available_count(lowered(t)), op.kpi(count_if(below)))
    _mart("g6_1_negative_stock_fires", lambda t: d.negative_stock_rows(lowered(t)),
          op.kpi(count_if(below), NO_FILTERS, "negative_stock_rows"))
    _mart("g6_4_data_quality_fires", lambda t: d.data_quality_summary(lowered(t)),
          op.data_quality_summary().replace("s.available_qty < 0", below))
    _mart("g7_1_value_by_category", executive.value_by_category, op.value_by_category())
    _mart("g7_2_top_low_stock", executive.top_low_stock,
          op.top_gap("reorder_point", LOW, "p.reorder_point - s.available_qty", "gap_qty"))
    _mart("g7_3_top_overstock", executive.top_overstock,
          op.top_gap("max_stock", OVER, "s.available_qty - p.max_stock", "excess_qty"))
    _mart("g7_4_idle_skus", lambda t: movement.idle_skus(t, AS_OF), op.idle_skus())
    _mart("g7_5_urgent_replenishment",
          lambda t: replenishment.urgent_replenishment(t, AS_OF), op.urgent_replenishment())
    _mart("g7_6_dead_slow_only", aging.dead_slow_only, op.top_dead_slow(only=True))
    _mart("g7_7_aging_buckets_present", aging.aging_buckets_present, op.aging_buckets_present())
    _mart("g7_8_accuracy_by_warehouse", lambda t: aging.accuracy_by_warehouse(t, AS_OF),
          op.accuracy_by_warehouse())


# --- H: quality --------------------------------------------------------------------------------

SOURCE_TABLES = [
    "inventory_transactions", "inventory_snapshot_daily", "purchase_order_lines",
    "sales_order_lines", "stock_counts",
]
RAW_FACTS = [
    "raw_inventory_transactions", "raw_purchase_order_lines", "raw_sales_order_lines",
    "raw_inventory_snapshot_daily", "raw_stock_counts",
]


def source_tables(src: TradeTables) -> dict[str, DataFrame]:
    return {
        "inventory_transactions": src.transactions,
        "inventory_snapshot_daily": raw_snapshot(src),
        "purchase_order_lines": src.po_lines,
        "sales_order_lines": src.sales_lines,
        "stock_counts": src.stock_counts,
    }


def ready_tables(src: TradeTables, t: PublishedMart) -> dict[str, DataFrame]:
    return {n: raw_frame(src, n) for n in RAW_FACTS} | mart_frames(t)


def reconciled(src: TradeTables, t: PublishedMart) -> DataFrame:
    in_raw = {
        "inventory_transactions": raw_frame(src, "raw_inventory_transactions"),
        "inventory_snapshot_daily": raw_frame(src, "raw_inventory_snapshot_daily"),
        "purchase_order_lines": raw_frame(src, "raw_purchase_order_lines"),
        "sales_order_lines": raw_frame(src, "raw_sales_order_lines"),
        "stock_counts": raw_frame(src, "raw_stock_counts"),
        "skus": raw_frame(src, "raw_dim_skus"),
    }
    in_mart = {
        "inventory_transactions": t.movement, "inventory_snapshot_daily": t.snapshot,
        "purchase_order_lines": t.po_lines, "sales_order_lines": t.sales_lines,
        "stock_counts": t.stock_counts, "skus": t.product,
    }
    return quality.reconcile_counts(source_tables(src) | {"skus": src.sku_costs}, in_raw, in_mart)


def kpi_panels(t: PublishedMart) -> dict[str, DataFrame]:
    f = NO_FILTERS
    return {
        "low_stock_count": executive.low_stock_count(t),
        "overstock_count": executive.overstock_count(t),
        "avg_lead_time": replenishment.avg_lead_time(t),
        "suggested_reorder_qty": replenishment.suggested_reorder_qty(t),
        "supplier_sla": replenishment.supplier_sla(t),
        "count_accuracy": aging.count_accuracy(t, f, AS_OF),
        "avg_abs_variance": aging.avg_abs_variance(t, f, AS_OF),
        "dead_stock_value": aging.dead_stock_value(t),
        "slow_moving_value": aging.slow_moving_value(t),
        "below_reorder_count": stock.below_reorder_count(t),
        "negative_available_count": stock.negative_available_count(t),
        "damaged_total": movement.damaged_total(t),
        "in_transit_total": movement.in_transit_total(t),
        "negative_stock_rows": reliability.negative_stock_rows(t),
        "snapshot_lag_hours": reliability.snapshot_lag_hours(t, f, NOW),
    }


def alert_states(t: PublishedMart) -> DataFrame:
    return quality.alerts(quality.kpi_rows(kpi_panels(t)), quality.rules_table(t.spark))


def landed_tables(src: TradeTables, t: PublishedMart) -> dict[str, DataFrame]:
    skus = staging.normalise_keys(src.skus, ["sku_id"])
    return {
        "inventory_transactions": conformed(src),
        "inventory_snapshot_daily": t.snapshot,
        "purchase_order_lines": staging.normalise_keys(src.po_lines, ["sku_id"]),
        "sales_order_lines": staging.normalise_keys(src.sales_lines, ["sku_id"]),
        "sales_orders": src.sales_orders,
        "purchase_orders": src.purchase_orders,
        "suppliers": src.suppliers,
        "inventory_transfers": src.transfers,
        "inventory_transfer_lines": src.transfer_lines,
        "skus": skus,
        "warehouses": src.warehouses,
        "customers": src.customers,
        "stock_counts": staging.normalise_keys(src.stock_counts, ["warehouse_id", "sku_id"]),
        "daily_movements": derive.daily_movements(conformed(src)),
        "calendar": t.date,
    }


def _register_h() -> None:
    _source("h1_source_counts", lambda s: quality.source_counts(source_tables(s)),
            ol.counts_rows(SOURCE_TABLES))
    _source("h2_raw_counts", lambda s: staging.layer_counts(
        {n: raw_frame(s, n) for n in RAW_FACTS}), ol.counts_row(RAW_FACTS))
    _view("h3_population", lambda s, t: quality.assert_populated(ready_tables(s, t)),
          ol.counts_rows(RAW_FACTS + list(TABLE_NAMES.values()), populated=True))
    _view("h4_reconcile_counts", reconciled, ol.reconcile({
        "inventory_transactions": ("raw_tx", "raw_tx", "movement"),
        "inventory_snapshot_daily": ("snapshot", "snapshot", "snapshot"),
        "purchase_order_lines": ("raw_po_lines", "raw_po_lines", "po_lines"),
        "sales_order_lines": ("raw_sales_lines", "raw_sales_lines", "sales_lines"),
        "stock_counts": ("raw_counts", "raw_counts", "stock_counts"),
        "skus": ("part", "raw_skus", "product"),
    }))
    _mart("h5_alerts", alert_states, ol.alerts({
        "low_stock_count": op.kpi(count_if(LOW)),
        "overstock_count": op.kpi(count_if(OVER)),
        "avg_lead_time": op.avg_lead_time(),
        "suggested_reorder_qty": op.suggested_reorder_qty(),
        "supplier_sla": op.supplier_sla(),
        "count_accuracy": op.count_accuracy(),
        "avg_abs_variance": op.avg_abs_variance(),
        "dead_stock_value": op.aging_value("days_since_movement > 90"),
        "slow_moving_value": op.aging_value("days_since_movement BETWEEN 31 AND 90"),
        "below_reorder_count": op.below_reorder_count(),
        "negative_available_count": op.kpi(count_if("s.available_qty < 0")),
        "damaged_total": op.kpi(long("s.damaged_qty")),
        "in_transit_total": op.kpi(long("s.in_transit_qty")),
        "negative_stock_rows": op.kpi(count_if("s.available_qty < 0")),
        "snapshot_lag_hours": op.snapshot_lag_hours(),
    }))
    _view("h6_constraint_violations",
          lambda s, t: quality.constraint_violations(landed_tables(s, t)), ol.violations())


# --- I: message log ----------------------------------------------------------------------------


def _register_i() -> None:
    def of(name, build, sql):
        _source(name, lambda s: build(s.messages), sql)

    of("i1_list_conversations", talk.list_conversations, ol.list_conversations(20, 0))
    of("i1_list_conversations_next", lambda m: talk.list_conversations(m, 15, 15),
       ol.list_conversations(15, 15))
    of("i2_history_page", lambda m: talk.history_page(m, 1, 3), ol.history_page(1, 3))
    of("i2_history_second_page", lambda m: talk.history_page(m, 2, 3), ol.history_page(2, 3))
    of("i3_context_tail", talk.context_tail, ol.context_tail(12))
    of("i3_context_tail_short", lambda m: talk.context_tail(m, 3), ol.context_tail(3))
    of("i4_prune_tail_duplicates", talk.prune_tail_duplicates, ol.prune_tail_duplicates())
    of("i5_label_intent", talk.label_intent, ol.label_intent())
    of("i6_extract_ids", talk.extract_ids, ol.extract_ids())
    of("i7_snippets", talk.snippets, ol.snippets())


# --- X: planning figures, restriction, roll-up stream -----------------------------------------


def delivered_events(src: TradeTables) -> DataFrame:
    """The event log as six deliveries of five days: some events come a delivery late, some far too late, and
    some twice, soon or far too late."""
    rows = src.numbered_events
    day = F.least(F.datediff("event_time", rows.agg(F.min("event_time")).scalar()), F.lit(29))
    kind, slot = F.col("event_id") % 10, F.floor(day / 5).cast("int")
    soon, far = (day % 5 >= 3) & (slot < 5), slot + 3 <= 5
    slots = (
        F.when((kind == 1) & soon, F.array(slot + 1)).when((kind == 2) & far, F.array(slot + 3))
        .when((kind == 3) & soon, F.array(slot, slot + 1)).when((kind == 4) & far, F.array(slot, slot + 3))
        .otherwise(F.array(slot))
    )
    fields = ["event_id", "warehouse_id", "sku_id", "qty_change", "event_time"]
    value = F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    return rows.select(value.alias("value"), F.explode(slots).alias("delivery"))


def rolled_up_events(src: TradeTables) -> DataFrame:
    """Closed windows of the event log; the stream stops and starts again with each delivery."""
    folder = work_folder(src.spark, "rollup")
    overwrite(delivered_events(src), f"{folder}/deliveries")
    sent = src.spark.read.parquet(f"{folder}/deliveries")
    for delivery in range(6):
        sent.filter(F.col("delivery") == delivery).select("value").write.mode("append").text(
            f"{folder}/inventory_topic"
        )
        messages = topics.read_topic(src.spark, "inventory_topic", folder=folder)
        start_rollup(messages, f"{folder}/totals", f"{folder}/checkpoint").awaitTermination()
    return src.spark.read.schema(ROLLUP).parquet(f"{folder}/totals")


def turnaround(src: TradeTables) -> DataFrame:
    """Exact quantiles, and whether the sketched ones are within a hundredth of their rank."""
    rows = planning.transfer_turnaround(src.transfers)
    return rows.select(
        "from_warehouse_id", "to_warehouse_id", "completed", "open", "p50_days", "p90_days",
        ((F.col("p50_off") <= 0.01) & (F.col("p90_off") <= 0.01)).alias("within_bound"),
    )


def planted_snapshot(snapshot: DataFrame) -> DataFrame:
    """The snapshot with some days of some products taken out and some written twice."""
    number, day = F.substring("sku_id", 5, 9).cast("int"), F.col("snapshot_date")
    missing = (F.col("warehouse_id") == "WH01") & ((number + F.dayofyear(day)) % 17 < 3)
    twice = (number % 23 == 5) & (F.dayofmonth(day) == 15)
    return snapshot.filter(~missing).unionAll(snapshot.filter(twice))


def seen_by(t: PublishedMart, user: str) -> Tables:
    """The mart as users of the sample access table see it."""
    rights = [("anna", "region", "ASIA"), ("boris", "warehouse", "WH01"), ("boris", "region", "EUROPE"), ("chief", "all", "")]
    access = t.spark.createDataFrame(rights, ACCESS)
    return restricted(t, access, user, t.src.sales_orders, t.src.purchase_orders)


def _register_x() -> None:
    asia = Filters(region=("ASIA",))
    _mart("x1_stock_cover", lambda t: replenishment.stock_cover(t, NO_FILTERS, AS_OF), op.stock_cover())
    _mart("x1_stock_cover_of_region", lambda t: replenishment.stock_cover(t, asia, AS_OF), op.stock_cover(asia))
    _mart("x3_receipt_ratio", lambda t: planning.receipt_ratio(t.src.purchase_orders, t.po_lines), ox.receipt_ratio())
    _mart("x4_overdue_orders", lambda t: planning.overdue_orders(t.src.purchase_orders, t.po_lines, AS_OF),
          ox.overdue_orders())
    _mart("x8_aging_by_warehouse", lambda t: planning.aging_by(t, "warehouse_id"), ox.aging_by("s.warehouse_id"))
    _mart("x8_aging_by_category", lambda t: planning.aging_by(t, "category"), ox.aging_by("p.category"))
    _mart("x2_turnover", lambda t: planning.turnover(
        t.movement, t.sales_lines, t.src.sku_costs, t.product, AS_OF, SNAPSHOT_DAYS), ox.turnover())
    _source("x5_transfer_turnaround", turnaround, ox.transfer_turnaround())
    _mart("x6_month_over_month", lambda t: planning.month_over_month(t.snapshot), ox.month_over_month())
    _mart("x7_movement_margins", lambda t: planning.movement_margins(t.movement, t.product), ox.movement_margins())
    _mart("x9_snapshot_issues", lambda t: planning.snapshot_issues(
        planted_snapshot(t.snapshot.select("snapshot_date", "warehouse_id", "sku_id")), t.warehouse, t.product,
        AS_OF - timedelta(days=SNAPSHOT_DAYS), AS_OF), ox.snapshot_issues())
    asia, some, nobody = Filters(region=("ASIA",)), "(w.region = 'EUROPE' OR s.warehouse_id = 'WH01')", "nobody"
    _mart("x10_status_of_region", lambda t: stock.status_distribution(seen_by(t, "anna")), op.status_distribution(asia))
    _mart("x10_flow_of_region", lambda t: movement.inbound_outbound(seen_by(t, "anna"), NO_FILTERS, AS_OF),
          op.inbound_outbound(asia))
    _mart("x10_on_hand_of_sites", lambda t: executive.on_hand_total(seen_by(t, "boris")),
          op.kpi(long(f"CASE WHEN {some} THEN s.on_hand_qty END")))
    _mart("x10_on_hand_of_all", lambda t: executive.on_hand_total(seen_by(t, "chief")), op.kpi(long("s.on_hand_qty")))
    _mart("x10_on_hand_without_rights", lambda t: executive.on_hand_total(seen_by(t, nobody)),
          "SELECT cast(0 AS bigint) AS value")
    _mart("x10_readonly_sql", lambda t: reports.readonly_sql(
        t.spark, "SELECT warehouse_id, count(*) AS n FROM fact_stock_counts GROUP BY warehouse_id",
        mart_frames(seen_by(t, "anna"))), query(
        """SELECT c.warehouse_id, count(*) AS n FROM stock_counts c JOIN warehouse w ON w.warehouse_id = c.warehouse_id
        WHERE w.region = 'ASIA' GROUP BY 1"""))
    _source("x11_stream_rollup", rolled_up_events, ox.rollup())


@cache
def entries() -> dict[str, tuple[Query, str | None]]:
    for register in (
        _register_a, _register_b_c, _register_d, _register_e, _register_f, _register_g1,
        _register_g2, _register_g3, _register_g4, _register_g5, _register_g6_g7, _register_h,
        _register_i, _register_x,
    ):
        register()
    return dict(_entries)


