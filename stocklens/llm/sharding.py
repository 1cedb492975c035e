"""Shards and slots by a Feistel permutation of global row numbers.

Rows are numbered 0 to N - 1 in the order of (key, text size, text checksum, text hash). A keyed
permutation of these numbers, evaluated row by row, is the shuffle: position p goes to shard
p mod n and slot p div n, so shards differ by one row at most, slots have no gaps, and any row's
place follows from its number, as its number does from its place (``number_at``).

The permutation: a number below a * b, where a and b are about the square root of N, is split into
a digit below a and one below b; rounds add a hash of one digit to the other, in turn. That is a
bijection of 0 .. a b - 1. Numbers from N on are walked on along their cycle until one falls below N
(cycle walking). Fewer than a numbers are beyond N, so a walk outlasts ``WALK`` steps either never
(a at most ``WALK``) or with a chance of less than N / b ** WALK; the query then fails instead of
giving a wrong place.

Row numbers: rows are sorted by range, written, and numbered by their order within a partition plus
the sizes of the partitions before it; only these sizes, one for each partition, are broadcast. Texts
take no part in the shuffle. Everything is DataFrame functions.

Defined results: a null text has size 16 and checksum 0; null keys come first; rows equal in key
and text are told apart by their order and get different places; an empty table gives no rows;
other columns are not read and may have any name.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settle, table, text_column

SHARDS = 40
ROUNDS = 6
WALK = 48
SEED = 20_260_101


def sides(total: int) -> tuple[int, int]:
    """a and b with a * b >= total, as near as can be to equal."""
    a = max(1, isqrt(max(total, 1) - 1) + 1)
    return a, max(1, -(-total // a))


def feistel(number: Column, total: int, seed: int = SEED, inverse: bool = False) -> Column:
    """The permutation of 0 .. a * b - 1 (or its inverse)."""
    a, b = sides(total)
    state = F.struct((number % a).alias("x"), F.floor(number / a).cast("long").alias("y"))
    # The rounds are one fold, so that each reads its digits from the round before by name.
    turns = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    sign = -1 if inverse else 1

    def step(s: Column, turn: Column) -> Column:
        shift_x = F.pmod(F.xxhash64(F.lit(seed), turn, s["y"]), F.lit(a))
        shift_y = F.pmod(F.xxhash64(F.lit(seed), turn, s["x"]), F.lit(b))
        even = turn % 2 == 0
        return F.struct(
            F.when(even, F.pmod(s["x"] + sign * shift_x, F.lit(a))).otherwise(s["x"]).alias("x"),
            F.when(even, s["y"]).otherwise(F.pmod(s["y"] + sign * shift_y, F.lit(b))).alias("y"),
        )

    return F.aggregate(
        F.array(*[F.lit(t) for t in turns]), state, step, lambda s: s["x"] + s["y"] * F.lit(a)
    )


def permuted(number: Column, total: int, seed: int = SEED, inverse: bool = False) -> Column:
    """The permutation of 0 .. total - 1 by cycle walking (or its inverse)."""
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), F.lit(-1).cast("long"),
        lambda at, i: F.when((at >= 0) & (at < total), at).otherwise(
            feistel(F.when(i == 1, number).otherwise(at), total, seed, inverse)
        ),
    )
    return F.when(walk < total, walk).otherwise(
        F.raise_error(F.lit(f"no number below {total} within {WALK} steps")).cast("long")
    )


def number_at(shard: Column, slot: Column, total: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """Number of the row at a shard's slot."""
    return permuted(slot * shards + shard, total, seed, inverse=True)


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``number`` (0, 1, ... in the given order, null first), and how many there are."""
    ranked = settle(rows, "rows").orderBy(*order).withColumn("place", F.monotonically_increasing_id())
    kept = settle(ranked, "sorted")
    # The id holds the sort's partition in its upper bits, the row's order there in the lower 33.
    part = F.shiftright("place", 33)
    sizes = settle(kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    found = kept.withColumn("part", part).join(F.broadcast(first), "part")
    number = F.col("first") + F.col("place") - F.shiftleft("part", 33)
    return found.withColumn("number", number).drop("part", "first", "place"), total


def shard(
    docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", seed: int = SEED
) -> DataFrame:
    """doc_id, size, text_crc32, number, shard and slot of every row."""
    t = text_column(docs, text)
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(t) + 16).cast("long").alias("size"),
        F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"),
        F.xxhash64(t).alias("text_hash"),
    )
    found, total = numbered(rows, ["doc_id", "size", "text_crc32", "text_hash"])
    place = permuted(F.col("number"), max(total, 1), seed)
    return found.withColumn("position", place).select(
        "doc_id", "size", "text_crc32", "number",
        (F.col("position") % shards).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).cast("long").alias("slot"),
    )


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "number",
    )
