"""Column helpers shared by every operator. All of them are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def normal_key(name: str | Column) -> Column:
    """Upper-case key without the blanks around it."""
    return F.upper(F.trim(F.col(name) if isinstance(name, str) else name))


def normalise_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Normalise key columns and drop the rows in which one of them is blank."""
    out = df.withColumns({c: normal_key(c) for c in cols})
    for c in cols:
        out = out.filter(F.col(c) != "")
    return out


def parse_time(col: str | Column) -> Column:
    """Timestamp from text; NULL when the text is not a date or timestamp."""
    text = F.trim(F.col(col) if isinstance(col, str) else col)
    # A cast would also take a bare time of day and put it on the current date.
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.try_to_timestamp(text))


def timestamp_lit(value: datetime | str) -> Column:
    """Timestamp literal read in the session time zone."""
    text = value if isinstance(value, str) else value.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(text))


def not_below_zero(col: str | Column) -> Column:
    """Clamp at zero. NULL gives zero, since ``greatest`` skips NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.greatest(c, F.lit(0))


def money(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def sum_long(col: str | Column) -> Column:
    """Integer total; zero over no rows."""
    return F.coalesce(F.sum(col), F.lit(0)).cast("bigint")


def sum_money(col: str | Column) -> Column:
    """Money total; zero over no rows."""
    return F.coalesce(F.sum(col), F.lit(0)).cast(MONEY_SUM)


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def ratio_units(a: Column, b: Column, places: int = 2) -> Column:
    """``a / b`` in whole units of 10**-places, rounded half to even on exact integers.

    NULL unless ``b`` is positive.
    """
    wide = "decimal(38,0)"  # a * 200 can leave a bigint; the quotient does not
    top = F.abs(a.cast(wide)) * F.lit(2 * 10**places).cast("decimal(5,0)")
    bottom = F.when(b > 0, b.cast("decimal(20,0)") * F.lit(2))
    whole = F.call_function("div", top, bottom)
    rest = top.cast(wide) - (whole.cast("decimal(20,0)") * bottom).cast(wide)
    twice, odd = rest * F.lit(2), whole % 2 == 1
    up = (twice > bottom) | ((twice == bottom) & odd)
    rounded = whole + F.when(up, 1).otherwise(0)
    return F.when(a < 0, -rounded).otherwise(rounded).cast("bigint")


def ratio(a: Column, b: Column, places: int = 2) -> Column:
    """``a / b`` rounded half to even; no floating point until the last step."""
    return ratio_units(a, b, places) / F.lit(10**places)


def kept_if(df: DataFrame, condition: Column) -> DataFrame:
    """``df.filter(condition)``, with the columns of ``df`` computed once. A plain filter is moved below the
    projection, which then computes what the condition reads once for each time it is named and once more for
    the rows that stay. It is not moved below one with a column that is not deterministic.
    """
    task = "_task"
    marked = df.select("*", F.spark_partition_id().alias(task))
    return marked.filter(condition & (F.col(task) >= 0)).drop(task)


def epoch_millis(day: Column) -> Column:
    """Milliseconds since 1970 of midnight of a date, whatever the session time zone."""
    return F.unix_date(day).cast("bigint") * F.lit(86_400_000)


def landed_once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last landed row of each key: landing a window or a poll again adds nothing.

    Rows without a whole key cannot be told apart and all stay. Copies meet in the map-side part
    of the aggregate.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    marked = df.withColumn("_own", F.when(missing, F.monotonically_increasing_id()))
    tie = [c for c in ["created_at"] if c in df.columns]
    return latest_per_key(marked, [*keys, "_own"], "ingestion_time", tie).drop("_own")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: str, tie: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key, as a whole row.

    Equal versions are settled by ``tie`` and then by the other columns, so that the result
    does not depend on row order. The maximum is combined on the map side: a key with very
    many versions sends one row per task to the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c != version and c not in tie]
    row = F.max(F.struct(version, *tie, *rest)).alias("row")
    best = df.groupBy(*keys).agg(row)
    return best.select(*[c if c in keys else F.col("row")[c].alias(c) for c in df.columns])
