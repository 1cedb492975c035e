"""How layers are written: monthly layout, full refresh, atomic swap, window replace."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocklens.operators.derive import PAIR, block_numbers, cut_runs, fill_days
from stocklens.plans.manifest import CODEC, arranged, publish, read_manifest, read_table, side_by_side

#: A snapshot is written in blocks of days, so many cut runs (at most so many times the days) a task.
BLOCK_DAYS = 11
TASK_RUNS = 128_000


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn("month", F.date_format(date_col, "yyyy-MM"))


def since(df: DataFrame, date_col: str, first: date) -> DataFrame:
    """Rows on or after a day; on a monthly layout whole months are pruned as well."""
    out = df.filter(F.col(date_col) >= F.lit(first))
    if "month" in df.columns:
        out = out.filter(F.col("month") >= first.strftime("%Y-%m"))
    return out


def between(df: DataFrame, date_col: str, first: date, last: date) -> DataFrame:
    out = since(df, date_col, first).filter(F.col(date_col) <= F.lit(last))
    if "month" in df.columns:
        out = out.filter(F.col("month") <= last.strftime("%Y-%m"))
    return out


def write_layer(
    df: DataFrame, path: str, date_col: str | None = None, sort_cols: Sequence[str] = ()
) -> None:
    """Write a table by month of its business date, sorted by key inside each file."""
    if date_col is None:
        df.write.mode("overwrite").parquet(path)
        return
    rows = arranged(with_month(df, date_col), "month", sort_cols)
    rows.write.mode("overwrite").partitionBy("month").parquet(path)


def placed_days(runs: DataFrame, task_runs: int = TASK_RUNS, block_days: int = BLOCK_DAYS) -> DataFrame:
    """The days of written runs, with a few days of neighbouring keys in each task, in the order of their keys.

    Runs are cut at blocks of days and shuffled; days are filled in after that, so the dense rows, some hundred
    times as many, are neither shuffled nor sorted.
    """
    pieces = runs.agg(F.sum(F.size(block_numbers(block_days)))).first()[0] or 0
    cut = cut_runs(runs, block_days).repartitionByRange(max(1, -(-pieces // task_runs)), "block", *PAIR)
    return fill_days(cut.sortWithinPartitions(*PAIR, "valid_from").drop("block"))


def write_by_day(df: DataFrame, path: str, date_col: str, sort_cols: Sequence[str], placed: bool = False) -> None:
    """Write a table with one partition per day, the unit that ``replace_window`` replaces.

    ``placed``: rows that come from a table of such a layout; they keep their order and are not shuffled.
    """
    rows = df if placed else arranged(df, date_col, sort_cols)
    with side_by_side(df.sparkSession) if placed else nullcontext():
        rows.write.mode("overwrite").option("compression", CODEC).partitionBy(date_col).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Full refresh: empty the table and insert everything."""
    df.write.mode("overwrite").parquet(path)


def replace_window(
    df: DataFrame, path: str, date_col: str, first: date, last: date, sort_cols: Sequence[str] = (),
    placed: bool = False,
) -> None:
    """Replace the days from ``first`` to ``last`` and leave every other day alone.

    Days of the window that got no rows are emptied too, as a delete before the insert would.
    ``placed``: see ``write_by_day``.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(date_col).between(F.lit(first), F.lit(last)))
    written = Observation()
    rows = rows.observe(written, F.collect_set(date_col).alias("days"))  # one entry per day
    ready = rows if placed else arranged(rows, date_col, sort_cols)
    with side_by_side(spark) if placed else nullcontext():
        (
            ready.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", CODEC)
            .partitionBy(date_col)
            .parquet(path)
        )
    stored = {str(day) for day in written.get["days"]}
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for n in range((last - first).days + 1):
        day = (first + timedelta(days=n)).isoformat()
        if day not in stored:
            fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{date_col}={day}"), True)


def swap_overwrite(
    df: DataFrame,
    path: str,
    date_col: str | None = None,
    sort_cols: Sequence[str] = (),
    by_day: bool = False,
    state: str = "",
    placed: bool = False,
) -> str:
    """Build the new table beside the old one, then repoint readers in one rename.

    A reader sees the old version or the new one, never an empty or half-written table. The
    version before the old one is removed; the old one stays for readers that still scan it.
    ``placed``: see ``write_rows``. Returns the path of the new version.
    """
    if date_col is None:
        held = publish(df, path, state=state)
    elif by_day:
        held = publish(df, path, date_col, date_col, sort_cols, state, placed=placed)
    else:
        held = publish(with_month(df, date_col), path, "month", date_col, sort_cols, state, placed=placed)
    return f"{path}/{held.whole}"


def current_path(spark: SparkSession, path: str) -> str:
    """Path of the version that readers of a swapped table see."""
    held = read_manifest(spark, path)
    if held is None:
        raise FileNotFoundError(f"no published version under {path}")
    return f"{path}/{held.whole}"


def read_current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table as its readers see it. A declared schema also reads a table without rows."""
    return read_table(spark, path, schema)
