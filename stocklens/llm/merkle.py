"""Merkle manifest of a dataset with a proof for every row, by incremental witnesses.

A row's leaf is the digest of its fields, each written with its size. Within a group (language) leaves
stand in the order of their key; every ``FAN`` neighbours become one node, level by level, and what
remains is the group's subroot. The subroots, in the order of their groups, become the root likewise.

Leaves are numbered by a sort by range and cut into aligned blocks of ``FAN ** LEVELS``. A task streams
the leaves of a block into an ``Appender``: it holds, on each level, the open run of subtrees, and each
open subtree holds its partial witness (the siblings left of it, and those right of it that are complete).
Every later sibling that completes extends the witnesses of the open ones; with the run full or closed they
become part of the witnesses of all leaves below, and the run one subtree of the next level.
The root of a block is a node like any other: block roots are appended to blocks of their own, round
by round, until each group has one node; the subroots are treated the same way as one more group.

Blocks are worked on twice, up for their roots and down for the witnesses, so that no witness
is written: one round has 1/4096 of the rows of the round before, and what goes down to a block is one
row. All of a task's data is one block. A group with a third of all rows is many blocks; so are rows that are equal
in everything, as a random number, drawn once and written, tells them apart in the sort.

Defined results: a null field is ``-``; a null group is a group of its own and comes first; null keys come
first; rows equal in group and key stand in the order of their leaves; repeated rows have a leaf and a
proof each; empty and very long texts are hashed whole; an empty table has no rows; other columns are
not read and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, table
from .sharding import numbered

FAN = 8
LEVELS = 4  # of a block: 4,096 nodes
SEED = 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = [T.StructField("left", T.ArrayType(T.StringType())), T.StructField("right", T.ArrayType(T.StringType()))]


class Subtree:
    """A complete subtree in an open run: its digest, its partial witness, the witnesses of its nodes."""

    __slots__ = ("digest", "left", "right", "witnesses")

    def __init__(self, digest: str, witnesses: list[list[tuple[str, str]]]):
        self.digest, self.witnesses = digest, witnesses
        self.left = self.right = ""


class Appender:
    """Nodes appended in order, and their witnesses: for each level the digests left and right."""

    def __init__(self, fan: int = FAN):
        self.fan = fan
        self.open: list[list[Subtree]] = []

    def append(self, digest: str) -> list[tuple[str, str]]:
        """The node's witness, a list that grows as its siblings complete."""
        witness: list[tuple[str, str]] = []
        self._add(0, Subtree(digest, [witness]))
        return witness

    def _add(self, level: int, subtree: Subtree) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        for earlier in run:
            earlier.right += subtree.digest
            subtree.left += earlier.digest
        run.append(subtree)
        if len(run) == self.fan:
            self._finish(level)

    def _finish(self, level: int) -> None:
        """Close the run of a level: its witnesses are final, it is one subtree of the next level."""
        run, self.open[level] = self.open[level], []
        for subtree in run:
            step = (subtree.left, subtree.right)
            for witness in subtree.witnesses:
                witness.append(step)
        digest = hashlib.sha256("".join([s.digest for s in run]).encode()).hexdigest()
        self._add(level + 1, Subtree(digest, [w for s in run for w in s.witnesses]))

    def close(self, levels: int | None) -> str:
        """Close the open runs up to ``levels`` (None: until one node remains), and give the root."""
        level = 0
        while level < len(self.open) if levels is None else level < levels:
            if self.open[level]:
                if levels is None and len(self.open[level]) == 1 and not any(self.open[level + 1 :]):
                    break
                self._finish(level)
            level += 1
        return self.open[level][0].digest


def appended(block: pa.Table, total: int, fan: int, levels: int) -> tuple[pa.Table, list[list[tuple[str, str]]], str]:
    """A block in order, the witnesses of its nodes, its root. ``total``: nodes of the whole group;
    the only block of its group ends with its root, others go up ``levels`` levels."""
    block = block.sort_by("idx")
    appender = Appender(fan)
    witnesses = [appender.append(node) for node in block["node"].to_pylist()]
    return block, witnesses, appender.close(None if total <= fan**levels else levels)


def forest(nodes: DataFrame, fan: int, levels: int) -> list[DataFrame]:
    """``nodes`` (g, idx, n, node) and the roots of their blocks, round by round, to one node a group."""
    size = fan**levels
    schema = T.StructType([nodes.schema[c] for c in ("g", "idx", "n", "node")])

    def root(key: tuple, block: pa.Table) -> pa.Table:
        total = block["n"][0].as_py()
        _, _, digest = appended(block, total, fan, levels)
        row = {"g": key[0].as_py(), "idx": key[1].as_py(), "n": -(-total // size), "node": digest}
        return pa.Table.from_pylist([row], ARROW_NODE)

    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        own = rounds[-1].select("g", "idx", "n", "node")
        rounds.append(settle(own.groupBy("g", block_of(size)).applyInArrow(root, schema), "roots"))
    return rounds


ARROW_NODE = pa.schema([("g", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("node", pa.string())])


def block_of(size: int) -> Column:
    return F.floor(F.col("idx") / size).cast("long").alias("block")


def lowered(own: list[str], given: list[str], fan: int, levels: int):
    """A block's rows with their witnesses, ended by what the row of its root has above."""

    def down(block: pa.Table, above: pa.Table) -> pa.Table:
        block, witnesses, _ = appended(block, block["n"][0].as_py(), fan, levels)
        up = above.to_pylist()[0]
        sides = [[x for x, _ in w] + up["left"] for w in witnesses], [[y for _, y in w] + up["right"] for w in witnesses]
        columns = {c: block[c] for c in own}
        columns |= {c: pa.array(x, pa.list_(pa.string())) for c, x in zip(("left", "right"), sides, strict=True)}
        columns |= {c: pa.array([up[c]] * len(witnesses), above.schema.field(c).type) for c in given}
        return pa.table(columns)

    return down


def descend(rounds: list[DataFrame], top: DataFrame, fan: int, levels: int) -> DataFrame:
    """The first round's rows with left, right and the further columns of ``top``, which has one row a
    group (g, idx 0, left, right, ...) for the last round."""
    size = fan**levels
    for nodes in reversed(rounds[:-1]):
        own = [c for c in nodes.columns if c not in ("left", "right")]
        given = [c for c in top.columns if c not in ("g", "idx", "left", "right", *own)]
        schema = T.StructType([nodes.schema[c] for c in own] + [top.schema[c] for c in ("left", "right", *given)])

        here = nodes.select(*own).groupBy("g", block_of(size))
        top = here.cogroup(top.select("g", "idx", "left", "right", *given).groupBy("g", F.col("idx").alias("block"))).applyInArrow(
            lowered(own, given, fan, levels), schema
        )
    return top


def field(value: Column) -> Column:
    """A field with its size in UTF-8 bytes; null is a dash."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def folded(node: Column, left: Column, right: Column) -> Column:
    """The root that a node and its witness lead to."""
    return F.aggregate(
        F.arrays_zip(left.alias("left"), right.alias("right")), node,
        lambda at, step: F.sha2(F.concat(step["left"], at, step["right"]), 256),
    )


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang",
    key: str = "doc_id", keep: dict[str, Column] | None = None, fan: int = FAN, levels: int = LEVELS,
) -> DataFrame:
    """The key, ``keep``, leaf, subroot, root and the witness of every row: ``left`` and ``right`` hold
    for each level, from the leaf up to the root, the digests on either side, in order."""
    spare = {f"k{i}": c for i, c in enumerate((keep or {}).values())}
    rows = docs.select(
        # '-' for null sorts before '=' and the group's own bytes.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("g"),
        F.col(key).alias("k"), leaf([F.col(c) for c in fields]).alias("node"), F.rand(SEED).alias("r"),
        *[c.alias(n) for n, c in spare.items()],
    )
    found, _ = numbered(rows, ["g", "k", "node", "r"])
    sizes = found.groupBy("g").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    leaves = settle(
        found.join(sizes, "g").select("g", (F.col("number") - F.col("first")).alias("idx"), "n", "node", "k", *spare),
        "leaves",
    )
    grown = forest(leaves, fan, levels)
    none = F.array().cast("array<string>")
    subroots, groups = numbered(grown[-1].select(F.col("g").alias("lang"), "node"), ["lang"])
    subroots = settle(
        subroots.select(F.lit("").alias("g"), F.col("number").alias("idx"), F.lit(groups).cast("long").alias("n"), "node", "lang"),
        "subroots",
    )
    over = forest(subroots, fan, levels)
    end = over[-1].select(
        "g", "idx", none.alias("left"), none.alias("right"), F.col("node").alias("root"),
        *(["node", "lang"] if len(over) == 1 else []),
    )
    heads = descend(over, end, fan, levels).select(
        F.col("lang").alias("g"), F.lit(0).cast("long").alias("idx"), "left", "right", F.col("node").alias("subroot"), "root"
    )
    if len(grown) == 1:  # no group has two leaves
        full = leaves.join(heads.drop("idx"), "g")
    else:
        full = descend(grown, settle(heads, "heads"), fan, levels)
    return full.select(
        F.col("k").alias(key), *[F.col(n).alias(c) for n, c in zip(spare, keep or {}, strict=True)],
        F.col("node").alias("leaf"), "subroot", "root", "left", "right",
    )


def op12_incremental_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    values = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    tampered = leaf((values | {"text": F.translate("text", UPPER, LOWER)}).values())
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = manifest(docs, keep={"changed": F.when(third, tampered)})
    steps = F.arrays_zip("left", "right")
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("left"), F.col("right")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(lang_levels: int = 7, group_levels: int = 4) -> str:
    """The same rows in DuckDB, level by level; room for 8 ** lang_levels rows of a language."""
    size = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
    leaf_of = " || ".join(size.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    changed = leaf_of.replace("text", f"translate(text, '{UPPER}', '{LOWER}')")
    crc = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                            lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
    parts = [
        f"""base AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS g, sha256({leaf_of}) AS leaf,
    CASE WHEN {crc} % 3 = 0 THEN sha256({changed}) ELSE sha256({leaf_of}) END AS changed FROM documents)""",
        """a0 AS (SELECT r, g, leaf AS node, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY g) AS n FROM base)""",
    ]

    def grow(name: str, levels: int) -> None:
        for k in range(levels):
            parts.append(f"""{name}{k + 1} AS (SELECT g, i // 8 AS i, (any_value(n) + 7) // 8 AS n,
    CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY i)) END AS node
    FROM {name}{k} GROUP BY g, i // 8)""")
            parts.append(f"""{name}s{k} AS (SELECT g, i, n > 1 AS up,
    coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS e
    FROM {name}{k} WINDOW w AS (PARTITION BY g, i // 8 ORDER BY i))""")

    def fold(step: str, before: str, join: str) -> None:
        parts.append(f"""{step} AS (SELECT b.* EXCLUDE (f, proof), proof || s.l || s.e AS proof,
    CASE WHEN s.up THEN sha256(s.l || f || s.e) ELSE f END AS f FROM {before} b JOIN {join})""")

    grow("a", lang_levels)
    top = f"a{lang_levels}"
    parts.append(f"""b0 AS (SELECT '' AS g, g AS lang, node, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n
    FROM {top})""")
    grow("b", group_levels)
    parts.append("""f0 AS (SELECT base.*, a0.i AS pos, b0.i AS at, b0.node AS subroot, changed AS f, '' AS proof
    FROM base JOIN a0 USING (r) JOIN b0 ON b0.lang = base.g)""")
    for k in range(lang_levels):
        fold(f"f{k + 1}", f"f{k}", f"as{k} s ON s.g = b.g AND s.i = b.pos // {8**k}")
    fold("h0", f"f{lang_levels}", "bs0 s ON s.i = b.at")
    for k in range(1, group_levels):
        fold(f"h{k}", f"h{k - 1}", f"bs{k} s ON s.i = b.at // {8**k}")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, t.node AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t.node AS verified
FROM h{group_levels - 1} h, b{group_levels} t"""  # fmt: skip


OP12_SQL = _sql()
