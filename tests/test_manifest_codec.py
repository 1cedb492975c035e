from __future__ import annotations

from pyspark.sql import functions as F

from stocklens.plans import manifest as m


def test_tables_take_less_disk_than_with_the_default_codec(spark, tmp_path):
    key = F.concat(F.lit("SKU_"), F.lpad(F.col("id").cast("string"), 6, "0"))
    rows = spark.range(0, 50_000, 1, 1).select(
        key.alias("sku_id"), (F.col("id") * 37 % 900).cast("int").alias("qty"),
        F.lit("2001-07-01").cast("date").alias("day"),
    )
    rows.write.parquet(str(tmp_path / "plain"))
    m.publish(rows, str(tmp_path / "whole"))
    m.publish(rows, str(tmp_path / "daily"), "day", "day", ["sku_id"])
    plain, whole, daily = (
        sum(f.stat().st_size for f in (tmp_path / name).rglob("*.parquet")) for name in ("plain", "whole", "daily")
    )
    assert whole < 0.7 * plain and daily < 0.7 * plain
    read = m.read_table(spark, str(tmp_path / "daily"), rows.schema)
    assert read.select(*rows.columns).exceptAll(rows).isEmpty() and read.count() == 50_000
