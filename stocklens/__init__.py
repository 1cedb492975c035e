"""Inventory analytics as Spark DataFrame operators."""
