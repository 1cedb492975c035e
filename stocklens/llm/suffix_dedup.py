"""Repeated byte strings by bucket-pointer refinement.

A string of ``LENGTH`` bytes is repeated if it also starts anywhere else in the corpus. Sorting all
suffixes of a large corpus is out of reach, and needless: suffixes are put into buckets by a first
q-gram, a bucket with one member is done, and the others are refined by the identifiers of buckets
that cover more of the text, round by round, until each window of a member is decided.

Suffixes: every window of LENGTH bytes picks the q-gram with the least hash inside it (its anchor).
Equal windows pick equal q-grams at equal places, so windows need comparing only under anchors
in the same bucket, and about one suffix in 176 is kept. ``shift`` is how far a window starts
before its anchor; an anchor owns the windows that picked it, a range of shifts.

First round: buckets are the q-grams. Inside a bucket, anchors whose owned windows, taken together,
are the same bytes at the same shifts are decided as one: all those windows are repeated.
The other anchors go on, with one representative for each such set.

Refinement: a block of shifts is cut into smaller blocks. A block has two bucket identifiers: that of
the bytes all its windows share (its core), and that of the bytes of all its windows together (its
span); either covers later and earlier offsets than the block it was cut from. A core without a
second member ends the block: none of its windows is repeated. A span with a second member
decides it: all are. What is left is cut again, with the identifiers of this round; blocks of one
window have the same core and span and are always decided.

Work: rows go by hash of an identifier, counts are combined before each shuffle, equal texts share
one copy wherever texts move, and a set of equal members goes on as one representative, so
that a passage in a third of all documents is no hot group. No pair of members is ever formed.
Identifiers of strings have 128 bits.

Defined results: a null text is empty; nothing is removed from texts shorter than LENGTH; equal
texts (repeated rows too) remove all of each other; matches inside one document, overlapping or
not, count; an empty table gives no rows; other columns are not read and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, table, text_column

LENGTH = 400
GRAM = 50
CHUNK = 1 << 17  # windows looked at together, whatever the length of the text
BLOCKS = (44, 6, 1)  # shifts in a block, round by round
FACTOR = 0x9E3779B97F4A7C15  # odd
MASK = (1 << 64) - 1


class Anchors:
    """Anchors of texts. ``runs`` works in chunks, so memory does not depend on a text's length."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.windows = length, gram, length - gram + 1
        size = CHUNK + length + 1
        self.byte = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.power, self.inverse = (
            np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, f, np.uint64)], dtype=np.uint64)
            for f in (FACTOR, pow(FACTOR, -1, 1 << 64))
        )

    def grams(self, raw: np.ndarray) -> np.ndarray:
        """A hash of each q-gram, the same wherever it stands."""
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.byte[raw] * self.power[: len(raw)], dtype=np.uint64, out=sums[1:])
        found = (sums[self.gram :] - sums[: -self.gram]) * self.inverse[: len(raw) - self.gram + 1]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        return found ^ (found >> np.uint64(32))

    def chunk(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window its anchor (the first of the least hashes), and the hashes."""
        hashes = self.grams(raw)
        bits = np.uint64(20)  # places in a chunk; the other 44 bits order the q-grams
        least = hashes >> bits << bits | np.arange(len(hashes), dtype=np.uint64)
        reach = 1
        while reach * 2 <= self.windows:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        count = len(hashes) - self.windows + 1
        late = self.windows - reach
        least = np.minimum(least[:count], least[late : late + count])
        return (least & np.uint64((1 << 20) - 1)).astype(np.int64), hashes

    def runs(self, text: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(anchor, first window, last window, hash of its q-gram), in order."""
        raw = np.frombuffer(text, np.uint8)
        held = None
        for at in range(0, len(raw) - self.length + 1, CHUNK):
            picked, hashes = self.chunk(raw[at : at + CHUNK + self.length - 1])
            first = np.flatnonzero(np.r_[True, picked[1:] != picked[:-1]])
            last = np.r_[first[1:], len(picked)] - 1
            places = picked[first]
            for m, lo, hi, h in zip(
                (places + at).tolist(), (first + at).tolist(), (last + at).tolist(),
                hashes[places].view(np.int64).tolist(), strict=True,
            ):
                if held and held[0] == m:  # a run that goes on in the next chunk
                    held = (m, held[1], hi, h)
                else:
                    if held:
                        yield held
                    held = (m, lo, hi, h)
        if held:
            yield held


ANCHOR = "t binary, anchor int, first int, last int, gram long, span binary"
KEYED = "t binary, anchor int, first int, last int, low int, high int, weight int, core binary, span binary"


def anchors_of(length: int, gram: int):
    """mapInArrow over (t, text): the anchors of each text. ``first`` and ``last`` are the least and
    the greatest shift owned; ``span`` identifies the owned windows together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        names = ["t", "anchor", "first", "last", "gram", "span"]
        one = xxhash.xxh3_128_digest
        for batch in batches:
            rows: list[tuple] = []
            for t, text in zip(batch["t"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for m, lo, hi, h in finder.runs(text):
                    rows.append((t, m, m - hi, m - lo, h, one(text[lo : hi + length], (m - lo) << 20 | (m - hi))))
                    if len(rows) >= 20_000:
                        yield _batch(rows, kinds, names)
                        rows = []
            if rows:
                yield _batch(rows, kinds, names)

    return run


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
    )


def contexts_of(length: int, gram: int):
    """mapInArrow over (t, text, wanted): the bytes around each wanted anchor that its windows can
    reach, and the anchor's place in them."""
    most = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        names = ["t", "anchor", "first", "last", "weight", "place", "bytes"]
        for batch in batches:
            rows = []
            for t, text, wanted in zip(*(batch[c].to_pylist() for c in ("t", "text", "wanted")), strict=True):
                for w in wanted:
                    m = w["anchor"]
                    start = max(0, m - most)
                    rows.append((t, m, w["first"], w["last"], w["weight"], m - start, text[start : m + length]))
                    if len(rows) >= 20_000:
                        yield _batch(rows, kinds, names)
                        rows = []
            if rows:
                yield _batch(rows, kinds, names)

    return run


def blocks_of(length: int, size: int):
    """mapInArrow over members with the block (low to high) they are in: one row for each smaller
    block that holds an owned shift, with its core and span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), *[pa.int32()] * 6, pa.binary(), pa.binary()]
        names = ["t", "anchor", "first", "last", "low", "high", "weight", "core", "span"]
        one = xxhash.xxh3_128_digest
        columns = ("t", "anchor", "first", "last", "low", "high", "weight", "place", "bytes")
        for batch in batches:
            rows: list[tuple] = []
            for t, m, first, last, low, high, weight, place, text in zip(
                *(batch[c].to_pylist() for c in columns), strict=True
            ):
                for a in range(low, high + 1, size):
                    b = min(a + size - 1, high)
                    if b < first or a > last:
                        continue
                    # Windows start between place - b and place - a; the seed is the block itself.
                    core = one(text[place - a : place - b + length], a << 20 | b)
                    if place >= b and place - a + length <= len(text):
                        span = one(text[place - b : place - a + length], a << 20 | b)
                    else:  # beyond the text's ends: like no other
                        span = hashlib.blake2b(t + m.to_bytes(8, "little"), digest_size=16).digest()
                    rows.append((t, m, max(a, first), min(b, last), a, b, weight, core, span))
                if len(rows) >= 20_000:
                    yield _batch(rows, kinds, names)
                    rows = []
            if rows:
                yield _batch(rows, kinds, names)

    return run


def removed(members: DataFrame, repeated: DataFrame, keys: list[str], length: int) -> DataFrame:
    """Stretches (t, start, end) of members whose span is ``repeated``."""
    return (
        members.join(repeated.select(*keys), keys)
        .select("t", (F.col("anchor") - F.col("last")).alias("start"), (F.col("anchor") - F.col("first") + length).alias("end"))
        .distinct()
    )


def round_of(members: DataFrame, bucket: str, carried: list[str], label: str, length: int):
    """One round: (stretches decided, members that go on). ``members`` is a written table with t,
    anchor, first, last, weight, the bucket's identifier and span. Weight 2 stands for a set that is
    decided already: it says of others that they are repeated, and is not removed again."""
    keys = [bucket, "span"]
    sets = settle(
        members.groupBy(*keys).agg(
            F.sum("weight").alias("n"),
            F.min(F.struct("t", "anchor", "first", "last", *carried)).alias("one"),
        ),
        f"{label}-sets",
    )
    open_ = settle(
        sets.groupBy(bucket)
        .agg(F.sum("n").alias("all"), F.max((F.col("n") == 1).cast("int")).alias("single"))
        .where("all > 1 and single = 1").select(bucket),
        f"{label}-open",
    )
    decided = removed(members.where("weight = 1"), sets.where("n > 1"), keys, length)
    going = sets.join(open_, bucket).select("one.*", F.least("n", F.lit(2)).cast("int").alias("weight"))
    return settle(decided, f"{label}-decided"), settle(going, f"{label}-going")


def one_text_each(docs: DataFrame, text: str, length: int) -> DataFrame:
    """(t, text): each text that is long enough, once; copies meet in a partial aggregate."""
    raw = F.encode(text_column(docs, text), "UTF-8")
    rows = docs.select(raw.alias("text")).where(F.octet_length("text") >= length)
    return rows.groupBy(F.unhex(F.md5("text")).alias("t")).agg(F.first("text").alias("text"))


def repeated_stretches(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(t, start, end): the md5 of a text, and stretches of its bytes that are covered by repeated
    strings; they can touch and overlap."""
    raw = F.encode(text_column(docs, text), "UTF-8")
    rows = docs.select(raw.alias("text")).where(F.octet_length("text") >= length)
    every = settle(
        rows.select(F.unhex(F.md5("text")).alias("t"), "text").mapInArrow(anchors_of(length, gram), ANCHOR),
        "anchors",
    )
    grams = settle(every.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "grams")
    members = settle(every.join(grams, "gram", "left_semi").withColumn("weight", F.lit(1)), "members")
    decided, going = round_of(members, "gram", [], "first", length)
    found = [decided]
    wanted = going.groupBy("t").agg(
        F.collect_list(F.struct("anchor", "first", "last", "weight")).alias("wanted")
    )
    contexts = settle(
        one_text_each(docs, text, length).join(wanted, "t").mapInArrow(
            contexts_of(length, gram),
            "t binary, anchor int, first int, last int, weight int, place int, bytes binary",
        ),
        "contexts",
    )
    whole = [F.lit(0).alias("low"), F.lit(length - gram).alias("high")]
    level = contexts.select("*", *whole)
    for size in BLOCKS:
        keyed = settle(level.mapInArrow(blocks_of(length, size), KEYED), f"blocks-{size}")
        decided, going = round_of(keyed, "core", ["low", "high"], f"blocks-{size}", length)
        found.append(decided)
        level = going.join(contexts.select("t", "anchor", "place", "bytes"), ["t", "anchor"])
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


CUT = T.StructType(
    [
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("kept", T.BinaryType()),
    ]
)


def merged(stretches: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in sorted((s["start"], s["end"]) for s in stretches):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def cut(with_kept: bool, text, stretches):
    @F.arrow_udf(CUT)
    def of(texts: pa.Array, lists: pa.Array) -> pa.Array:
        rows = []
        for raw, stretch in zip(texts.to_pylist(), lists.to_pylist(), strict=True):
            runs = merged(stretch)
            edges = [0, *[e for r in runs for e in r], len(raw)]
            left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append(
                {
                    "n_removed": sum(b - a for a, b in runs),
                    "n_spans": len(runs),
                    "kept_sha256": hashlib.sha256(left).hexdigest(),
                    "kept": left if with_kept else None,
                }
            )
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.array(rows, pa.struct(list(zip(CUT.names, kinds, strict=True))))

    return of(text, stretches)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
    with_kept: bool = True,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, unless ``with_kept`` is off, the
    remaining bytes of every row."""
    stretches = (
        repeated_stretches(docs, text, length, gram).groupBy("t")
        .agg(F.collect_set(F.struct("start", "end")).alias("stretches"))
    )
    results = settle(
        one_text_each(docs, text, length).join(stretches, "t")
        .select("t", cut(with_kept, F.col("text"), F.col("stretches")).alias("r")).select("t", "r.*"),
        "cut",
    )
    raw = F.encode(text_column(docs, text), "UTF-8")
    plain = docs.select(F.col(key).alias("doc_id"), raw.alias("raw")).select(
        "doc_id",
        F.unhex(F.md5("raw")).alias("t"),
        F.octet_length("raw").cast("long").alias("n_bytes"),
        F.sha2("raw", 256).alias("sha"),
        *([F.col("raw")] if with_kept else []),
    )
    out = plain.join(results, "t", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        *([F.when(F.col("n_removed").isNull(), F.col("raw")).otherwise(F.col("kept")).alias("kept")] if with_kept else []),
    )
    return out


def op5_bucket_refined_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)
