"""Transfers are made of all orders and all their lines."""

from __future__ import annotations

import pytest

from stocklens.sources.trade_tables import TradeTables

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, source", [("transfers", "orders"), ("transfer_lines", "lineitem")])
def test_no_order_is_left_out(spark, name, source):
    src = TradeTables(spark, SMALL)
    assert getattr(src, name).count() == src.table(source).count()
