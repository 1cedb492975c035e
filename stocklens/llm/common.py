"""Shared helpers: reading tables, the shared folder, written intermediate tables, words."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A Python worker gets texts in Arrow batches of this size at most (one longer text is one batch).
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else the context's checkpoint
    folder; in local mode only, where neither is set, a temporary folder is made and set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, and a lost executor
    costs no more than the tasks it ran. Shuffle files of the write are freed at its end."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Limit the session's Arrow batches to BATCH_BYTES, so that a worker's memory does not follow the
    length of 10,000 texts; a lower limit that the session has stays. Batches change no result."""
    held = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < held <= BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has (names differ beyond case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_column(df: DataFrame, name: str = "text") -> Column:
    """The column as a string, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
