"""Versioned tables: which files a table consists of, and what is known of them without reading them.

A table is a folder with one subfolder per write and a small manifest. The manifest names, for each
partition value, the writes that hold its rows, and keeps numbers gathered while they were written: row
count, first and last day, newest landing time. A change writes the new files first and then replaces the
manifest in one rename, so a reader sees the old table or the new one; any application can open the
table by its path. Files that neither this manifest nor the one before it names are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "_current"
WHOLE = ""  # partition value of a table without partitions
COMPACT = 8  # a partition of so many writes is rewritten as one
CODEC = "zstd"  # sorted keys and repeated numbers take far less disk than with Spark's default
OPEN_FILES = 44  # a task that writes placed rows has so many files open at most


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    column: str | None = None
    parts: dict[str, list[str]] = field(default_factory=dict)
    rows: int = 0
    first: str | None = None
    last: str | None = None
    landed: int | None = None  # microseconds
    whole: str | None = None  # the one write that is the table
    state: str = ""
    mark: str | None = None
    before: list[str] = field(default_factory=list)

    def folders(self, values: Iterable[str] | None = None) -> list[str]:
        """Folders below the table's that hold the rows of some partition values, or of all."""
        named = self.parts if values is None else [v for v in values if v in self.parts]
        return [w if v == WHOLE else f"{w}/{self.column}={v}" for v in named for w in self.parts[v]]

    @property
    def last_day(self) -> date | None:
        return date.fromisoformat(self.last) if self.last else None


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf), conf


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    jvm, context, _ = _files(spark, path)
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    if not context.util().exists(pointer):
        return None
    stream = context.open(pointer)
    try:
        return Manifest(**json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def store_manifest(spark: SparkSession, path: str, new: Manifest, held: Manifest | None) -> Manifest:
    """Publish ``new`` in one rename, then remove files that only the version before ``held`` had."""
    live = held.folders() if held else []
    new = replace(new, version=held.version + 1 if held else 1, before=live)
    jvm, context, conf = _files(spark, path)
    hadoop_path = jvm.org.apache.hadoop.fs.Path
    beside = hadoop_path(f"{path}/{POINTER}.{uuid.uuid4().hex}")
    stream = beside.getFileSystem(conf).create(beside, True)
    stream.write(json.dumps(asdict(new)).encode())
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(beside, hadoop_path(f"{path}/{POINTER}"), options)
    for old in set(held.before if held else []) - set(live) - set(new.folders()):
        context.delete(hadoop_path(f"{path}/{old}"), True)
    return new


def new_write() -> str:
    return f"v={uuid.uuid4().hex}"


def arranged(df: DataFrame, partition_col: str, sort_cols: Sequence[str]) -> DataFrame:
    """Rows of one partition value side by side, sorted.

    The rebalance hint lets the adaptive planner cut a partition value that holds far more than
    its share into several files and put small ones together.
    """
    return df.hint("rebalance", partition_col).sortWithinPartitions(partition_col, *sort_cols)


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[None]:
    """Within it, a task writes the files of its partition values side by side, in the order its rows come in, and
    sorts rows by partition value only from ``OPEN_FILES`` values on."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    held = spark.conf.get(key, None)
    spark.conf.set(key, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.unset(key) if held is None else spark.conf.set(key, held)


def observed(df: DataFrame, column: str | None, day: str | None) -> tuple[DataFrame, Observation]:
    """``df`` with the numbers of the manifest gathered while it is written."""
    seen = Observation()
    none = F.lit(None).cast("string")
    return df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        (F.min(day).cast("string") if day else none).alias("first"),
        (F.max(day).cast("string") if day else none).alias("last"),
        (F.unix_micros(F.max("ingestion_time")) if "ingestion_time" in df.columns else F.lit(None).cast("long")).alias("landed"),
        # One entry for each month or day.
        (F.collect_set(column).cast("array<string>") if column else F.array()).alias("parts"),
    ), seen


def numbers(seen: Observation) -> dict:
    """What was observed. Where the planner finds that there are no rows at all, it leaves the
    observing node out, and the observation has no row."""
    try:
        return seen.get
    except Py4JJavaError:
        return {"rows": 0, "first": None, "last": None, "landed": None, "parts": []}


def write_rows(
    df: DataFrame, path: str, column: str | None, day: str | None, sort_cols: Sequence[str] = (), placed: bool = False
) -> tuple[str, dict]:
    """Write rows beside those of the table; the name of the write and its numbers.

    ``placed``: each task of ``df`` holds few partition values already, and the rows of each in the order of the
    sort columns, so they are neither shuffled nor sorted.
    """
    name = new_write()
    rows, seen = observed(df, column, day)
    if column and placed:
        with side_by_side(df.sparkSession):
            rows.write.option("compression", CODEC).partitionBy(column).parquet(f"{path}/{name}")
    elif column:
        ready = arranged(rows, column, sort_cols)
        ready.write.option("compression", CODEC).partitionBy(column).parquet(f"{path}/{name}")
    else:
        rows.write.option("compression", CODEC).parquet(f"{path}/{name}")
    return name, numbers(seen)


def publish(
    df: DataFrame, path: str, column: str | None = None, day: str | None = None,
    sort_cols: Sequence[str] = (), state: str = "", mark: str | None = None, placed: bool = False,
) -> Manifest:
    """Replace a whole table. ``column``: partition column, ``day``: business date."""
    held = read_manifest(df.sparkSession, path)
    name, seen = write_rows(df, path, column, day, sort_cols, placed)
    parts = {v: [name] for v in sorted(seen["parts"])} if column and seen["rows"] else {WHOLE: [name]}
    new = Manifest(
        column=column, parts=parts, rows=seen["rows"], first=seen["first"], last=seen["last"],
        landed=seen["landed"], whole=name, state=state, mark=mark,
    )
    return store_manifest(df.sparkSession, path, new, held)


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None,
    values: Iterable[str] | None = None, manifest: Manifest | None = None,
) -> DataFrame:
    """The table as its readers see it, or only some partition values of it."""
    held = manifest or read_manifest(spark, path)
    if held is None:
        raise FileNotFoundError(f"no published version under {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if values is None and held.whole:
        return reader.parquet(f"{path}/{held.whole}")
    folders = held.folders(values)
    if not folders:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", path).parquet(*[f"{path}/{f}" for f in folders]).drop("v")


def append(
    df: DataFrame, path: str, schema: StructType, day: str | None = None, sort_cols: Sequence[str] = (),
    mark: str | None = None, placed: bool = False,
) -> Manifest:
    """Add rows to a partitioned table. Files of other partition values are not touched; a value with
    many writes is rewritten as one."""
    spark = df.sparkSession
    held = read_manifest(spark, path)
    name, seen = write_rows(df, path, held.column, day, sort_cols, placed)
    if not seen["rows"]:
        return store_manifest(spark, path, replace(held, mark=mark or held.mark), held)
    parts = {v: list(names) for v, names in held.parts.items() if v != WHOLE}
    for value in seen["parts"]:
        parts[value] = [*parts.get(value, []), name]
    new = replace(
        held, parts=dict(sorted(parts.items())), whole=None, rows=held.rows + seen["rows"], mark=mark or held.mark,
        first=_least(held.first, seen["first"]), last=_most(held.last, seen["last"]),
        landed=_most(held.landed, seen["landed"]),
    )
    full = [v for v, names in parts.items() if len(names) >= COMPACT]
    if full:
        again, _ = write_rows(read_table(spark, path, schema, full, new), path, held.column, day, sort_cols)
        new = replace(new, parts=parts | {v: [again] for v in full})
    return store_manifest(spark, path, new, held)


def replace_values(
    df: DataFrame, path: str, schema: StructType, values: Sequence[str], day: str | None = None,
    sort_cols: Sequence[str] = (), dropped: Sequence[str] = (), mark: str | None = None, placed: bool = False,
) -> Manifest:
    """Replace the rows of some partition values by ``df``, which has rows of these alone, and leave out
    the ``dropped`` ones. Other partition values keep their files."""
    spark = df.sparkSession
    held = read_manifest(spark, path)
    gone = [v for v in [*values, *dropped] if v in held.parts]
    # Rows that go are counted from file footers.
    fewer = read_table(spark, path, schema, gone, held).count() if gone else 0
    name, seen = write_rows(df, path, held.column, day, sort_cols, placed)
    parts = {v: names for v, names in held.parts.items() if v not in gone and v != WHOLE}
    parts |= {v: [name] for v in seen["parts"]}
    by_day = held.column == day
    new = replace(
        held, parts=dict(sorted(parts.items())) or {WHOLE: [name]}, whole=None, rows=held.rows - fewer + seen["rows"], mark=mark or held.mark,
        first=min(parts, default=None) if by_day else _least(held.first, seen["first"]),
        last=max(parts, default=None) if by_day else _most(held.last, seen["last"]),
        landed=_most(held.landed, seen["landed"]),
    )
    return store_manifest(spark, path, new, held)


def upsert(
    df: DataFrame, path: str, schema: StructType, key: Sequence[str], day: str | None = None,
    sort_cols: Sequence[str] = (), mark: str | None = None, settled: bool = False, placed: bool = False,
) -> Manifest:
    """Rows of ``df``, one a key, replace those of the same key. Rewritten are the partition values that ``df``
    has and those that its keys had before: a row whose business date moved leaves its old month. The latter are
    found by a scan of the key columns only. ``settled``: a key never changes its partition value, as that of
    a digest of the whole row does not, so there is nothing to look for in other values, and rows of values that the
    table does not have meet none. ``placed``: see ``write_rows``."""
    spark = df.sparkSession
    held = read_manifest(spark, path)
    # One entry for each month or day.
    value = F.col(held.column).cast("string").alias("value")
    values = df.select(value)
    if not settled:
        before = read_table(spark, path, schema, manifest=held).select(*key, value).join(df.select(*key), list(key), "left_semi")
        values = values.unionAll(before.select("value"))
    touched = [r[0] for r in values.distinct().collect()]
    old = read_table(spark, path, schema, touched, held)
    new = df.filter(F.col(held.column).cast("string").isin([v for v in touched if v in held.parts])) if settled else df
    kept = old.join(new.select(*key), list(key), "left_anti")
    return replace_values(kept.unionByName(df), path, schema, touched, day, sort_cols, mark=mark, placed=placed)


def _least(*values):
    return min([v for v in values if v is not None], default=None)


def _most(*values):
    return max([v for v in values if v is not None], default=None)
