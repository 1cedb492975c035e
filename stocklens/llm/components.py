"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a, b; longs): the smallest node that
    its links reach, itself included.

    Every round points the nodes at smaller ones until all links form stars around the smallest
    node. Minima are combined before each shuffle, and both sides of each join are written tables,
    so a node with very many links can be split among tasks. Nothing but one checksum row comes
    to the driver. No links give no rows.
    """
    edges = settle(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while (state := _checksum(edges)) != before:
        before = state
        edges = settle(_small_star(settle(_large_star(edges), "large")), "small")
    return (
        edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .union(edges.select("b", "b"))
        .distinct()
    )


def _checksum(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    lowest = settle(
        both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m")),
        "lowest",
    )
    return (
        both.join(lowest, F.col("a") == F.col("n"))
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` has a > b on every row."""
    lowest = settle(edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")), "lowest")
    moved = edges.join(lowest, F.col("a") == F.col("n")).where("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    return moved.union(lowest.select("n", "m")).distinct()
