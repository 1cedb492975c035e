from __future__ import annotations

import shutil
from pathlib import Path

import pytest

from stocklens.operators import reports
from stocklens.operators.dashboards import executive, stock
from stocklens.plans.pipeline import lazy_mart, published_mart, shared_folder
from stocklens.sources.trade_tables import TradeTables
from tests.small import rows, value

SMALL = Path("/root/testdata/sf0.001")
TABLES = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem"]


def copy_of(folder: Path) -> Path:
    for name in TABLES:
        shutil.copy(SMALL / f"{name}.parquet", folder / f"{name}.parquet")
    return folder


def test_published_equals_lazy(spark):
    published = published_mart(spark, str(SMALL))
    lazy = lazy_mart(TradeTables(spark, str(SMALL)))
    assert rows(stock.status_distribution(published)) == rows(stock.status_distribution(lazy))
    assert sorted(published.last_moves().collect()) == sorted(lazy.last_moves().collect())
    assert published.movement.drop("month").columns == lazy.movement.columns


def test_no_movements_at_all(spark, tmp_path):
    folder = copy_of(tmp_path)
    (folder / "lineitem.parquet").unlink()
    schema = spark.read.parquet(str(SMALL / "lineitem.parquet")).schema
    spark.createDataFrame([], schema).write.parquet(str(folder / "lineitem.parquet"))
    t = published_mart(spark, str(folder))
    assert rows(reports.inventory_overview(t)) == [] and rows(stock.exception_matrix(t)) == []
    assert value(executive.on_hand_total(t)) == 0
    assert rows(reports.health(t))[0]["movement_rows"] == 0


def test_a_changed_source_is_published_again(spark, tmp_path):
    folder = copy_of(tmp_path)
    before = published_mart(spark, str(folder))
    assert published_mart(spark, str(folder)) is before
    assert before.warehouse.count() == 5
    kept = spark.read.parquet(str(SMALL / "region.parquet")).filter("r_regionkey < 3")
    (folder / "region.parquet").unlink()
    kept.write.parquet(str(folder / "region.parquet"))
    assert published_mart(spark, str(folder)).warehouse.count() == 3


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        pytest.skip("the session names no folder")
    assert shared_folder(spark) == folder.rstrip("/")
