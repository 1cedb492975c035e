"""Exact top-k inner products: tiles of queries against shards of candidates.

Vectors become integers, floor(64 x), and are packed into blocks: shards of ``SHARD`` candidates
and tiles of ``TILE`` queries (fewer of very wide vectors: ``CELLS`` components at most), one row each,
components in as few bytes as the block's values need. Every tile meets every shard (the query set is stated,
so that is the work asked for, a block pair at a time) in a sort-merge join: a copy of the tiles for each
shard is far more than their file, by which Spark would judge them fit for a broadcast. One matrix product gives all scores of a
pair, and a partial selection keeps the k best of each query. The lists of a query are then
merged along a tree: ``FAN`` shards' lists at a time, until one is left. No task holds more than two
blocks and one score matrix, or FAN lists of a query.

Order: higher score first, ties to the smaller vec_id. Scores are exact: products run in float64 only
while all partial sums stay below 2^52, else in 64-bit integers, where a sum that could need more than 62
bits raises an error instead of being wrong.

Defined results: a vector that is null, or holds a null or non-finite component, takes no part, nor
does a row without vec_id; an empty vector scores 0 with all; of two lengths the shorter
counts as filled up with zeros; rows that share a vec_id are one vector in several forms: its score
with another is the best of the forms, and it never answers itself; fewer candidates than k give
all of them; other columns are not read and may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, table

TILE = 256
SHARD = 16384
CELLS = 1 << 22
FAN = 16
BLOCK = T.StructType(
    [
        T.StructField("width", T.IntegerType()), T.StructField("bytes", T.IntegerType()),
        T.StructField("ids", T.BinaryType()), T.StructField("data", T.BinaryType()),
    ]
)
TOP = T.ArrayType(T.StructType([T.StructField("worse", T.LongType()), T.StructField("vec_id", T.LongType())]))
LISTS = T.ArrayType(T.StructType([T.StructField("query_id", T.LongType()), T.StructField("top", TOP)]))


def whole_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and v (longs) of the rows that take part."""
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c * 64).cast("long"))
    return rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine).select(
        F.col(key).cast("long").alias("vec_id"), scaled.alias("v")
    )


@F.arrow_udf(BLOCK)
def packed(ids: pa.Array, vectors: pa.Array) -> pa.Array:
    """Blocks from lists of ids and of vectors: ids ascending, vectors as rows of integers of ``bytes`` bytes."""
    out = []
    for i, v in zip(ids, vectors, strict=True):
        keys = np.array(i.as_py(), np.int64)
        order = np.argsort(keys, kind="stable")
        lists = v.values
        lengths = np.diff(np.asarray(lists.offsets))
        width = int(lengths.max(initial=0))
        data = np.zeros((len(keys), width), "<i8")
        flat = np.asarray(lists.flatten())
        data[np.arange(width)[None, :] < lengths[:, None]] = flat
        size = item_size(data)
        rows = data[order].astype(f"<i{size}")
        out.append({"width": width, "bytes": size, "ids": keys[order].tobytes(), "data": rows.tobytes()})
    return pa.array(
        out, pa.struct([("width", pa.int32()), ("bytes", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])
    )


def item_size(data: np.ndarray) -> int:
    """Bytes of the smallest integer that holds all values."""
    low, high = int(data.min(initial=0)), int(data.max(initial=0))
    return next(n for n in (1, 2, 4, 8) if -(1 << 8 * n - 1) <= low and high < 1 << 8 * n - 1)


def blocks(vectors: DataFrame, size: int, total: int) -> DataFrame:
    """``vectors`` in blocks of about ``size``; every row falls into one by the hash of its id."""
    count = max(1, -(-total // size))
    return (
        vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int"))
        .groupBy("block")
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
        .select("block", packed(F.col("rows.vec_id"), F.col("rows.v")).alias("b"))
    )


def unpacked(block: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(block["ids"], "<i8")
    return ids, np.frombuffer(block["data"], f"<i{block['bytes']}").reshape(len(ids), block["width"])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T as 64-bit integers, exactly."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    x, y = a.astype(np.float64), b.astype(np.float64)
    most = np.abs(x).sum(1).max() * np.abs(y).max()  # no partial sum is larger
    if most < 2.0**52:
        return (x @ y.T).astype(np.int64)
    if most < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise OverflowError("a score can need more than 62 bits")


def one_each(ids: np.ndarray, scores: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray]:
    """One row (or column) for each id, with the best score of its forms. ``ids`` ascend."""
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    if len(starts) == len(ids):
        return ids, scores
    return ids[starts], np.maximum.reduceat(scores, starts, axis=axis)


def best_of(query: int, ids: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A query's k best of one shard, in order; ``ids`` ascend, so of equal scores the first stay."""
    at = int(np.searchsorted(ids, query))
    if at < len(ids) and ids[at] == query:
        ids, row = np.delete(ids, at), np.delete(row, at)
    if len(row) > k:
        limit = np.partition(row, len(row) - k)[len(row) - k]
        above = np.flatnonzero(row > limit)
        chosen = np.concatenate([above, np.flatnonzero(row == limit)[: k - len(above)]])
        ids, row = ids[chosen], row[chosen]
    order = np.lexsort((ids, -row))
    return ids[order], row[order]


def selected(k: int, tile: Column, shard: Column) -> Column:
    """Lists (query_id, its best of the shard) of a tile's queries. ``worse`` is the score negated,
    so that the natural order of a list is best first."""

    @F.arrow_udf(LISTS)
    def of(tiles: pa.Array, shards: pa.Array) -> pa.Array:
        queries, ids, scores, sizes, ends = [], [], [], [0], [0]
        for t, s in zip(tiles, shards, strict=True):
            (keys, a), (names, b) = unpacked(t.as_py()), unpacked(s.as_py())
            keys, found = one_each(keys, products(a, b), 0)
            names, found = one_each(names, found, 1)
            for q, row in zip(keys.tolist(), found, strict=True):
                i, x = best_of(q, names, row, k)
                queries.append(q)
                ids.append(i)
                scores.append(-x)
                sizes.append(len(i))
            ends.append(len(queries))
        top = pa.ListArray.from_arrays(
            pa.array(np.cumsum(sizes), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x or [np.empty(0, np.int64)]), pa.int64()) for x in (scores, ids)],
                ["worse", "vec_id"],
            ),
        )
        lists = pa.StructArray.from_arrays([pa.array(queries, pa.int64()), top], ["query_id", "top"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lists)

    return of(tile, shard)


def top_k(
    rows: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    tile: int = TILE, shard: int = SHARD,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k best of each row for which ``queries`` (of
    the id) holds."""
    vectors = whole_vectors(rows, key, vector).dropDuplicates()
    vectors = vectors.withColumn("asks", queries)
    total, asking, width = vectors.agg(F.count("*"), F.count_if("asks"), F.max(F.size("v"))).first()
    tile, shard = (max(1, min(size, CELLS // max(width or 0, 1))) for size in (tile, shard))
    shards = settle(blocks(vectors.drop("asks"), shard, total), "shards")
    tiles = settle(blocks(vectors.where("asks").drop("asks"), tile, asking), "tiles")
    groups = max(1, -(-total // shard))
    # Each tile goes to every shard: the pairs are dealt by shard, an even key.
    to_all = tiles.select(
        F.col("b").alias("t"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("block")
    )
    lists = to_all.hint("merge").join(shards, "block").select(
        F.col("block").alias("group"), F.explode(selected(k, F.col("t"), F.col("b"))).alias("l")
    ).select("group", "l.query_id", "l.top")
    while True:
        groups = -(-groups // FAN)
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k)
        lists = lists.groupBy("query_id", F.floor(F.col("group") / FAN).cast("int").alias("group")).agg(
            merged.alias("top")
        )
        if groups <= 1:
            break
    return lists.select("query_id", F.posexplode("top").alias("at", "best")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        "best.vec_id",
        (-F.col("best.worse")).alias("score"),
    )


def op8_tiled_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: DuckDB, for the same rows.
OP8_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 20
"""
