"""Planning figures over operational and mart tables: turnover, transfers, months, margins, data gaps."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.functions import count_where, ratio, sum_long, sum_money
from stocklens.operators.dashboards.aging import aging_base, bucket_of
from stocklens.operators.derive import PAIR
from stocklens.operators.mart import Tables

UNKNOWN = "Unknown"


def balance_ranges(tx: DataFrame, as_of: date, days_back: int) -> DataFrame:
    """Balance of every pair as ranges of days (valid_from, valid_to) inside the window.

    Movements are summed per day on the map side; all days before the window count as one. A pair has at
    most one row for each day on which it moved, so nothing is expanded by day.
    """
    first, last = F.lit(as_of - timedelta(days=days_back)), F.lit(as_of)
    day = F.greatest(F.to_date("event_time"), F.date_sub(first, 1))
    net = (
        tx.filter(F.to_date("event_time") <= last)
        .groupBy(*PAIR, day.alias("day"))
        .agg(F.sum("qty_change").alias("net"))
    )
    by_day = Window.partitionBy(*PAIR).orderBy("day")
    until = F.coalesce(F.date_sub(F.lead("day").over(by_day), 1), last)
    ranges = net.select(
        *PAIR, F.greatest("day", first).alias("valid_from"), until.alias("valid_to"),
        F.sum("net").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("balance"),
    )
    return ranges.filter(F.col("valid_to") >= F.col("valid_from"))


def turnover(
    tx: DataFrame, sales: DataFrame, costs: DataFrame, product: DataFrame, as_of: date, days_back: int
) -> DataFrame:
    """Cost of goods sold, average stock value, turnover and days of inventory by category.

    The average is weighted by the days each balance was valid, which equals the average over
    the daily snapshot. Both sides are summed per SKU before they meet.
    """
    days = days_back + 1
    first = as_of - timedelta(days=days_back)
    stock = (
        balance_ranges(tx, as_of, days_back)
        .withColumn("held", F.greatest("balance", F.lit(0)) * (F.datediff("valid_to", "valid_from") + 1))
        .groupBy("sku_id")
        .agg(F.sum("held").alias("unit_days"))
    )
    sold = (
        sales.filter(F.col("created_date").between(F.lit(first), F.lit(as_of)))
        .groupBy("sku_id")
        .agg(F.sum("qty").alias("sold"))
    )
    cents = F.round(F.col("unit_cost") * 100).cast("bigint")
    per_sku = (
        stock.join(sold, "sku_id", "full")
        .join(costs.select("sku_id", cents.alias("cents")), "sku_id")
        .join(product.select("sku_id", "category"), "sku_id", "left")
    )
    sums = per_sku.groupBy(F.coalesce("category", F.lit(UNKNOWN)).alias("category")).agg(
        sum_long(F.coalesce("sold", F.lit(0)) * F.col("cents")).alias("cogs"),
        sum_long(F.coalesce("unit_days", F.lit(0)) * F.col("cents")).alias("value_days"),
    )
    cogs, held = F.col("cogs"), F.col("value_days")
    return sums.select(
        "category",
        (cogs / 100).cast("decimal(38,2)").alias("cogs"),
        ratio(held, F.lit(100 * days)).alias("avg_inventory_value"),
        ratio(cogs * days, held, 4).alias("turnover"),
        ratio(held, cogs).alias("days_of_inventory"),
    )


def transfer_turnaround(transfers: DataFrame, shares: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """Days from request to completion by route: completed and open transfers, exact quantiles, and quantiles
    of a mergeable sketch with the rank each one really has.

    Sketches are built per route and month of request and then merged, as stored monthly ones would be;
    the exact quantiles come from one count for each number of days, so no route's transfers are gathered.
    """
    route = ["from_warehouse_id", "to_warehouse_id"]
    days = F.datediff("completed_at", "requested_at").cast("bigint")
    rows = transfers.select(*route, F.date_trunc("month", "requested_at").alias("month"), days.alias("days"))
    monthly = rows.groupBy(*route, "month").agg(
        F.count("days").alias("n"), F.count(F.lit(1)).alias("all"), F.kll_sketch_agg_bigint("days").alias("sketch")
    )
    merged = monthly.groupBy(*route).agg(
        F.sum("n").alias("completed"), (F.sum("all") - F.sum("n")).alias("open"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )
    counts = rows.filter(F.col("days").isNotNull()).groupBy(*route, "days").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy(*route).orderBy("days").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("n").over(up)).groupBy(*route).agg(
        F.array_sort(F.collect_list(F.struct("days", "n", "upto"))).alias("steps")
    )
    out = merged.join(ranked, route, "left")

    def exact(share: float) -> Column:
        enough = F.filter("steps", lambda s: s["upto"] >= F.ceil(F.col("completed") * share))
        return F.get(enough, F.lit(0))["days"].cast("int")

    def sketched(share: float) -> Column:
        n = F.col("completed")
        return F.when(n > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(share))).cast("int")

    def off(share: float) -> Column:
        """How far, as a share of all, the sketched value's ranks are from the wanted one."""
        step = F.get(F.filter("steps", lambda s: s["days"] == sketched(share)), F.lit(0))
        low, high = (step["upto"] - step["n"]) / F.col("completed"), step["upto"] / F.col("completed")
        return F.greatest(low - share, F.lit(share) - high, F.lit(0.0))

    columns = []
    for share in shares:
        name = f"p{round(share * 100)}"
        columns += [exact(share).alias(f"{name}_days"), sketched(share).alias(f"{name}_sketch"), off(share).alias(f"{name}_off")]
    return out.select(*route, "completed", "open", *columns)


def month_over_month(snapshot: DataFrame) -> DataFrame:
    """Stock value on the last snapshot day of each month, and the change to the month before.

    Months without a snapshot stay, with no value, and neither they nor the month after have a change. Only
    the chosen days' rows are read: they are found from the partition column first.
    """
    month = F.trunc("snapshot_date", "month")
    lasts = snapshot.groupBy(month.alias("month")).agg(F.max("snapshot_date").alias("snapshot_date"))
    values = (
        snapshot.join(F.broadcast(lasts.select("snapshot_date")), "snapshot_date", "left_semi")  # a row a month
        .groupBy("snapshot_date")
        .agg(F.sum("inventory_value").cast("decimal(38,2)").alias("inventory_value"))
    )
    span = lasts.agg(F.min("month").alias("a"), F.max("month").alias("b")).filter(F.col("a").isNotNull())
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    rows = months.join(lasts, "month", "left").join(values, "snapshot_date", "left")
    before = F.lag("inventory_value").over(Window.orderBy("month"))  # a row a month
    change = F.col("inventory_value") - F.col("previous_value")
    cents = lambda c: (c * 100).cast("bigint")
    return (
        rows.withColumn("previous_value", before)
        .select(
            "month", "snapshot_date", "inventory_value", "previous_value",
            change.cast("decimal(38,2)").alias("change"),
            ratio(cents(change) * 100, cents(F.col("previous_value"))).alias("change_pct"),
        )
    )


def movement_margins(movement: DataFrame, product: DataFrame) -> DataFrame:
    """Movement by warehouse and category with all margins; ``level`` 0 is a cell, 1 a warehouse, 2 a
    category, 3 everything. Movements are summed per pair before categories are joined, then in one pass."""
    q = F.col("qty_change")
    pairs = movement.groupBy(*PAIR).agg(
        F.sum(F.when(q > 0, q)).alias("qin"), F.sum(F.when(q < 0, -q)).alias("qout"), F.count(F.lit(1)).alias("n")
    )
    rows = pairs.join(product.select("sku_id", "category"), "sku_id", "left")
    return (
        rows.withColumn("category", F.coalesce("category", F.lit(UNKNOWN)))
        .cube("warehouse_id", "category")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            sum_long("qin").alias("qty_in"), sum_long("qout").alias("qty_out"),
            sum_long("n").alias("movement_rows"),
        )
    )


#: Days of a pair are counted in chunks of so many, two days in a 64-bit number.
CHUNK = 64
SECOND = 2**31


def snapshot_issues(
    snapshot: DataFrame, warehouse: DataFrame, product: DataFrame, first: date, last: date
) -> DataFrame:
    """What is wrong with a daily snapshot: ``gap`` (days without a row), ``duplicate`` (rows beyond the first
    of a day), ``no warehouse`` and ``no category`` (keys that the dimensions do not know or leave blank).

    Rows are shuffled once, by pair, and counted there: a few numbers a pair hold the rows of each day, so rows
    are not sorted and no row of a day is kept. Days are looked at one by one only for a pair with a day that has
    not just one row. No grid of days and pairs is built. Keys are joined once per pair.
    """
    span = (last - first).days + 1
    counted = _counted_days(snapshot, first, last)
    numbers = F.sequence(F.lit(0), F.lit(span - 1))
    listed = counted.withColumn("days", F.when(~F.col("whole"), F.transform(numbers, _rows_of_day)))

    def rows_of(i: Column) -> Column:
        return F.coalesce(F.get("days", i), F.lit(1))  # around the window there is nothing to miss

    def issue(kind: str, a: Column, b: Column, rows: Column) -> Column:
        values = F.lit(kind).alias("issue"), a.alias("first_day"), b.alias("last_day"), rows.cast("bigint").alias("n")
        return F.struct(*values)

    def on(i: Column) -> Column:
        return F.date_add(F.lit(first), i)

    begins = F.filter(numbers, lambda i: (rows_of(i) == 0) & (rows_of(i - 1) != 0))
    ends = F.filter(numbers, lambda i: (rows_of(i) == 0) & (rows_of(i + 1) != 0))
    gaps = F.zip_with(begins, ends, lambda a, b: issue("gap", on(a), on(b), b - a + 1))
    twice = F.filter(numbers, lambda i: rows_of(i) > 1)
    copies = F.transform(twice, lambda i: issue("duplicate", on(i), on(i), rows_of(i) - 1))
    of_days = F.when(F.col("days").isNotNull(), F.concat(gaps, copies)).otherwise(F.array())
    pairs = listed.select(*PAIR, "a", "b", "n", of_days.alias("of_days"))

    # A key that one dimension has more than once counts as often where the other does not know the pair.
    sites = warehouse.groupBy("warehouse_id").agg(F.count(F.lit(1)).alias("sites"))
    goods = product.filter(F.col("category") != "").groupBy("sku_id").agg(F.count(F.lit(1)).alias("goods"))

    def unmapped(kind: str, known: str, other: str) -> Column:
        times = F.coalesce(other, F.lit(1)).cast("int")
        of_pair = F.array_repeat(issue(kind, F.col("a"), F.col("b"), F.col("n")), times)
        return F.when(F.col(known).isNull(), of_pair).otherwise(F.array())

    keyed = pairs.join(sites, "warehouse_id", "left").join(goods, "sku_id", "left")
    found = F.concat("of_days", unmapped("no warehouse", "sites", "goods"), unmapped("no category", "goods", "sites"))
    return keyed.select(*PAIR, F.explode(found).alias("x")).select(
        *PAIR, "x.issue", "x.first_day", "x.last_day", F.col("x.n").alias("row_count")
    )


def _counted_days(snapshot: DataFrame, first: date, last: date) -> DataFrame:
    """One row a pair: its first and last day from ``first`` to ``last``, its rows, whether it has one row on each
    day, and the rows of each day in ``chunks`` (``_rows_of_day``)."""
    chunks, rest = divmod((last - first).days + 1, CHUNK)
    at = F.datediff("snapshot_date", F.lit(first))
    rows = snapshot.filter(F.col("snapshot_date").between(F.lit(first), F.lit(last))).select(*PAIR, "snapshot_date")
    one = F.when(F.pmod(at, F.lit(2)) == 0, F.lit(1)).otherwise(F.lit(SECOND)).cast("bigint")
    number = F.floor(F.pmod(at, F.lit(CHUNK)) / 2).cast("int")
    sums = [F.coalesce(F.sum(F.when(number == k, one)), F.lit(0)).alias(f"number{k}") for k in range(CHUNK // 2)]
    by_chunk = (
        rows.repartition(*PAIR)
        .groupBy(*PAIR, F.floor(at / CHUNK).cast("int").alias("chunk"))
        .agg(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b"), F.count(F.lit(1)).alias("n"), *sums)
    )

    def once(days: int) -> Column:
        """The numbers of a chunk with one row on each of its first days."""
        return F.array(*[F.lit((2 * k < days) + (2 * k + 1 < days) * SECOND).cast("bigint") for k in range(CHUNK // 2)])

    held = F.array(*[f"number{k}" for k in range(CHUNK // 2)])
    too_many = F.raise_error(F.lit(f"more than {SECOND - 1} snapshot rows of a warehouse and SKU in {CHUNK} days"))
    held = F.when(F.col("n") >= SECOND, too_many).otherwise(held)
    whole = F.col("held") == F.when(F.col("chunk") < chunks, once(CHUNK)).otherwise(once(rest))
    return (
        by_chunk.select(*PAIR, "chunk", "a", "b", "n", held.alias("held"))
        .groupBy(*PAIR)
        .agg(
            F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"),
            (F.count_if(whole) == chunks + (rest > 0)).alias("whole"),
            F.map_from_entries(F.collect_list(F.struct("chunk", "held"))).alias("chunks"),
        )
    )


def _rows_of_day(i: Column) -> Column:
    """Rows of a pair on day ``i`` of the window."""
    held = F.get(F.try_element_at("chunks", F.floor(i / CHUNK).cast("int")), F.floor(F.pmod(i, F.lit(CHUNK)) / 2).cast("int"))
    half = F.when(F.pmod(i, F.lit(2)) == 0, F.pmod(held, F.lit(SECOND))).otherwise(F.floor(F.shiftright(held, 31)))
    return F.coalesce(half, F.lit(0)).cast("bigint")


def _lines_by_order(lines: DataFrame) -> DataFrame:
    """PO lines summed per order, on the map side, before they meet the orders."""
    return lines.groupBy("po_id").agg(
        F.count(F.lit(1)).alias("lines"), count_where(F.col("qty_open") > 0).alias("open_lines"),
        sum_long("qty_ordered").alias("ordered"), sum_long("qty_received").alias("received"),
        sum_long("qty_open").alias("open"),
    )


def receipt_ratio(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Ordered and received quantity by supplier, what is missing, and the received share in percent.

    Lines whose order is not known count for the supplier "Unknown"; more received than ordered gives
    a negative variance and a share above a hundred.
    """
    per_order = _lines_by_order(lines).join(orders.select("po_id", "supplier_id"), "po_id", "left")
    ordered, received = F.col("qty_ordered"), F.col("qty_received")
    return (
        per_order.groupBy(F.coalesce("supplier_id", F.lit(UNKNOWN)).alias("supplier_id"))
        .agg(
            sum_long("lines").alias("line_count"), sum_long("ordered").alias("qty_ordered"),
            sum_long("received").alias("qty_received"),
        )
        .withColumns({"variance_qty": ordered - received, "receipt_pct": ratio(received * 100, ordered)})
    )


def overdue_orders(orders: DataFrame, lines: DataFrame, as_of: date) -> DataFrame:
    """Purchase orders past their expected date and not closed, by supplier: orders, lines and quantity
    still open, and days since the oldest expected date. Orders without an expected date are not late."""
    late = orders.filter(
        (F.col("expected_delivery_date") < F.lit(as_of)) & (F.upper("status") != F.lit("CLOSED"))
    )
    found = late.select("po_id", "supplier_id", "expected_delivery_date").join(_lines_by_order(lines), "po_id", "left")
    return found.groupBy(F.coalesce("supplier_id", F.lit(UNKNOWN)).alias("supplier_id")).agg(
        F.count(F.lit(1)).alias("overdue_orders"),
        F.coalesce(sum_long("open_lines"), F.lit(0)).cast("bigint").alias("open_lines"),
        F.coalesce(sum_long("open"), F.lit(0)).cast("bigint").alias("open_qty"),
        F.min("expected_delivery_date").alias("oldest_expected_date"),
        F.datediff(F.lit(as_of), F.min("expected_delivery_date")).alias("max_days_overdue"),
    )


def aging_by(t: Tables, dimension: str) -> DataFrame:
    """Stocked pairs and their value by aging bucket and ``dimension``: warehouse_id, or a product
    column. Pairs are summed per SKU or warehouse and bucket before a product column is joined."""
    key = "warehouse_id" if dimension == "warehouse_id" else "sku_id"
    sums = (
        aging_base(t)
        .groupBy(key, bucket_of(F.col("days_since_movement")).alias("aging_bucket"))
        .agg(F.count(F.lit(1)).alias("pairs"), sum_money("inventory_value").alias("value"))
    )
    if dimension != key:
        sums = sums.join(t.product.select(key, dimension), key, "left")
    return sums.groupBy(F.coalesce(dimension, F.lit(UNKNOWN)).alias(dimension), "aging_bucket").agg(
        sum_long("pairs").alias("pair_count"), sum_money("value").alias("aging_value")
    )
