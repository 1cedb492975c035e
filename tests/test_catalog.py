"""Every registered query against its check SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check import compare
from stocklens.catalog import entries

SMALL = "/root/testdata/sf0.001"
CHECKS = contract.oracle_sql()


def test_every_query_has_a_check():
    assert set(entries()) <= set(CHECKS) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["warehouse", "sku_id", "sku_name"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, name):
    outcome, _ = compare(spark, SMALL, name, contract.queries()[name], CHECKS[name])
    assert outcome.startswith("equal") and "TYPES" not in outcome, outcome
