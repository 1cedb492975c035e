"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 64 bits, each set if it is set in over half the XXH64 values of the text's word
shingles. Two fingerprints are linked if at most ``RADIUS`` bits differ.

Covering masks (Pagh): give each bit position a vector of RADIUS + 1 bits that is not zero. For a
vector v that is not zero, the table of v keeps the positions whose vector has an odd product with
v. At most RADIUS differing positions give at most RADIUS linear equations in RADIUS + 1
unknowns, so some v makes all their products even: that table drops every differing bit, and the
pair collides there. No pair within the radius is missed.

Buckets: equal fingerprints are one node. A bucket of few nodes is compared inside one list. A
larger one is split again by the covering masks of the positions its table dropped; any pair of it
within the radius meets again, and with each level about half of the free positions are fixed, so
that buckets end for certain (k free positions allow 2^k distinct fingerprints). No bucket is cut.

Defined results: null and empty texts have fingerprint zero, linked like any other; one or two
words form one shingle; a null doc_id can be in a component but never names one, and a component
of null ids only is null; repeated rows are answered row by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, settle, table, text_column
from .components import smallest_reachable

RADIUS = 3
FULL = (1 << 64) - 1
LIST_LIMIT = 256  # nodes compared in one list; larger buckets are split by further masks


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of one UTF-8 text, as an unsigned number."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, count = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: count - 1].tolist()]
    stops = (ends[len(words) - count :] - 1).tolist()
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (one(joined[i:j], 42) for i, j in zip(starts, stops, strict=True)), "<u8", count
    )
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(count, 64)
    whole = count // 128 * 128  # sums of 128 rows fit in a byte
    totals = bits[whole:].sum(0, dtype=np.int64)
    if whole:
        totals += bits[:whole].reshape(-1, 128, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(totals * 2 > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str, width: int):
    """Column with the fingerprint as a long (two's complement)."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        values = [fingerprint(t, width) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(values, np.uint64).view(np.int64))

    return of(text_column(docs, text))


def covering_masks(free: int, radius: int = RADIUS) -> list[int]:
    """Masks inside ``free``: any ``radius`` of its positions are outside at least one of them."""
    vectors = (1 << (radius + 1)) - 1
    places = [i for i in range(64) if free >> i & 1]
    return [
        sum(1 << p for k, p in enumerate(places) if ((k % vectors + 1) & v).bit_count() & 1)
        for v in range(1, vectors + 1)
    ]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def masks_after(spark: SparkSession, befores: list[int]) -> DataFrame:
    """before, masks: what each table of the next level keeps. From an Arrow table the rows are part of
    the plan; from a list they would be an RDD, read by Python workers of a second daemon."""
    masks = [[signed(k & FULL | m) for m in covering_masks(FULL & ~k)] for k in befores]
    return spark.createDataFrame(
        pa.table({"before": pa.array(befores, pa.int64()), "masks": pa.array(masks, pa.list_(pa.int64()))})
    )


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in "ab"])))
def linked_in_list(prints: pa.Array) -> pa.Array:
    """Links that connect, inside each list, what pairs within RADIUS connect: one for each node
    but the first of a component, not one for each pair."""
    out = []
    for p in prints:
        ids = np.array(p.as_py(), np.int64)
        values = ids.view(np.uint64)
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= RADIUS
        label = ids
        while True:
            better = np.where(near, label[None, :], np.iinfo(np.int64).max).min(1)
            if (better == label).all():
                break
            label = better
        out.append([{"a": int(i), "b": int(k)} for i, k in zip(ids, label, strict=True) if i != k])
    return pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))


def links(prints: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Links (a, b) that connect the same fingerprints as all pairs within RADIUS do.

    ``prints``: distinct fingerprints as longs, column ``print``. ``list_limit`` is 128 at least:
    masks of a level fix about half of the free positions (64, 30, 14, at most 7 are left), and
    seven free positions allow 128 fingerprints, so the third level is the last. It has at most
    225 masks, each followed by 15: that table's size does not depend on the data.
    """
    if list_limit < 128:
        raise ValueError("list_limit must be 128 at least")
    spark, found = prints.sparkSession, []
    level = prints.select("print", F.lit(0).cast("long").alias("before"))
    befores, keys = [0], ["kept", "bucket"]
    while befores:
        spread = level.join(F.broadcast(masks_after(spark, befores)), "before").select(
            "print", F.explode("masks").alias("kept")
        )
        spread = spread.withColumn("bucket", F.col("print").bitwiseAND(F.col("kept")))
        if befores != [0]:  # two ways through the masks can keep the same positions
            spread = spread.distinct()
        sizes = settle(spread.groupBy(keys).agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        shared = settle(
            spread.join(sizes, keys).select("print", *keys, (F.col("n") > list_limit).alias("large")),
            "shared",
        )
        lists = shared.where("not large").groupBy(keys).agg(F.collect_list("print").alias("prints"))
        found.append(
            lists.select(F.explode(linked_in_list("prints")).alias("l")).select("l.a", "l.b")
        )
        level = shared.where("large").select("print", F.col("kept").alias("before"))
        befores = [r[0] for r in level.select("before").distinct().collect()]
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


def with_components(prints: DataFrame, key: str, print_: str = "print") -> DataFrame:
    """``prints`` (a written table) with ``component`` (its least fingerprint) and ``component_id``,
    the smallest key of the component."""
    nodes = settle(
        prints.groupBy(F.col(print_).alias("print")).agg(F.min(key).alias("first")), "nodes"
    )
    stars = settle(smallest_reachable(links(nodes.select("print"))), "stars")
    members = settle(
        nodes.join(stars, F.col("print") == F.col("node"), "left")
        .select("print", "first", F.coalesce("component", "print").alias("component")),
        "members",
    )
    names = settle(
        members.groupBy("component").agg(F.min("first").alias("component_id")), "names"
    )
    named = settle(
        members.join(names, "component").select(F.col("print").alias("p__"), "component", "component_id"),
        "named",
    )
    return prints.join(named, F.col(print_) == F.col("p__")).drop("p__")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    prints = settle(
        docs.select(F.col(key).alias("doc_id"), fingerprints(docs, text, width).alias("print")),
        "prints",
    )
    return with_components(prints, "doc_id").select(
        F.col("doc_id").alias(key),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """One row of each component: that of the smallest key (null last), then of the least text hash.
    Columns stay as they are. Of rows equal in key and text any one stays."""
    row = [F.col(key).alias("k"), F.xxhash64(text_column(docs, text)).alias("h")]
    prints = settle(docs.select(*row, fingerprints(docs, text, width).alias("print")), "prints")
    order = F.struct(F.col("k").isNull().alias("last"), "k", "h")
    chosen = settle(
        with_components(prints, "k").groupBy("component").agg(
            F.min(order).alias("one"), F.count("*").alias("rows")
        ).select(F.col("one.k").alias("k__"), F.col("one.h").alias("h__"), (F.col("rows") > 1).alias("several__")),
        "chosen",
    )
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), *row)
    found = packed.join(chosen, F.col("k").eqNullSafe(F.col("k__")) & (F.col("h") == F.col("h__")))
    once = found.where("not several__").select("d")
    again = found.where("several__").dropDuplicates(["k", "h"]).select("d")
    return once.union(again).select(*(F.col(f"d.`{c}`").alias(c) for c in docs.columns))


def op9_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
