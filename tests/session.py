"""The Spark session of tests and checks."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def make_session(cpus: str | None = None) -> SparkSession:
    cores = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stocklens")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Local inputs are small: small splits, row groups and shuffle targets use all cores.
        .config("spark.sql.files.openCostInBytes", "262144")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.hadoop.parquet.block.size", str(1 << 20))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stocklens-checkpoint-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark
