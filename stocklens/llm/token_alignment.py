"""Cross-tokenizer alignment with pair counts by external spill counting.

Two tokenizers cut the same bytes: A, a byte-level BPE, the text after a blank; B, a piece model that adds
this blank itself. Where tokens of both end at the same byte they are linked, and these places cut
the tokens into groups. How often an id pair is linked is counted over the whole corpus; each
document then gets the counts of its links and how many of them are the highest of their B id.

Counting spills, so that no task holds the pairs of the corpus. A task sorts the pair-document records
of up to ``RUN_RECORDS`` links side-major (by B's radix, B, A) and writes them as a *run*: for each
radix one piece, zstd streams of its pairs with their totals in the run and of the documents' shares. A very
common pair is one entry of a run, however many documents hold it. Pieces of a radix are merged
``FAN_IN`` at a time by a k-way heap merge that adds up equal pairs, round by round, until one stream
holds the radix' counts; its order has all pairs of a B id together, so one pass yields their
maximum. The counts then go back to the pieces, ``FAN_IN`` at a time, each piece adds up what its
documents get, and the shares of a run are added to its documents.

What a task holds is bounded by a run, ``FAN_IN`` open streams and the distinct pairs of one radix; none
grows with the number of documents. Runs, counts and shares are written to the shared folder between steps.

Texts are cut into units where a single blank stands between two characters that are no white space: A's
pattern starts a word there, and no piece of B has a blank behind another letter, so neither joins bytes across
(if a vocabulary has such pieces or another pattern, texts are encoded whole). A unit's tokens and
links are found once and remembered, up to ``MEMORY`` of them and as many from before; units met
for the first time are encoded together. Tokens have one byte at least, so each group has one link.

Defined results: null and empty texts, and those whose tokens do not give back their bytes (say, one with
U+2581), have no tokens: zeros, empty group text. Strings of special tokens are plain text. Repeated rows
are counted row by row; an empty table gives no rows; other columns are not read and may have any name.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, table, text_column
from .sharding import numbered

RUN_RECORDS = 1_000_000  # pair-document records of a run
RUN_DOCS = 50_000
RADIX = 32  # pieces of a run
FAN_IN = 64  # streams of a merge
PART_CHARS = 1 << 18  # texts are encoded together, and long ones in parts, of about this size
MEMORY = 150_000  # units that a task remembers before it starts anew, from what comes back
LONGEST_UNIT = 64  # longer units are not remembered
BLOCK = 8192  # entries read from a stream at a time
PAIR = np.dtype([("code", "<i8"), ("n", "<i8")])
CUT = re.compile(r"(?<=\S) (?=\S)")
BLANK = "▁"  # fixed by piece models


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the
    others follow from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(definition)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = byte_letters()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.bytes_a = [bytes(letters.get(c, 63) for c in name) for name in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        self.lengths_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.ids = max(self.size_a, self.size_b)
        self.words = [f"{i}{mark}" for mark in ",|;" for i in range(self.ids)]
        self.known: dict[str, Unit] = {}
        self.old: dict[str, Unit] = {}
        self.rows = -(-self.size_b // RADIX)
        split = json.loads(definition).get("pre_tokenizer") or {}
        self.cuttable = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not any(BLANK in p.lstrip(BLANK) for p in pieces)
        )

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts, without the blanks between them."""
        at = 0
        while self.cuttable and len(text) - at > PART_CHARS:
            cut = CUT.search(text, at + PART_CHARS)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.end()
        yield text[at:]

    def code(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs as numbers in the order of B's radix, B, A."""
        return ((b % RADIX) * self.rows + b // RADIX) * self.size_a + a

    def units(self, text: str) -> list[str]:
        return CUT.split(text) if self.cuttable else [text]

    def learned(self, units: list[str]) -> dict[str, Unit]:
        """What is known of ``units``; those not met before are encoded together."""
        if len(self.known) >= MEMORY:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        wanted = set(units)
        new = [u for u in wanted if u not in known]
        known.update({u: old[u] for u in new if u in old})
        found = dict(self.linked([u for u in new if u not in known]))
        long = {u: x for u, x in found.items() if len(u) > LONGEST_UNIT}
        known.update((u, x) for u, x in found.items() if u not in long)
        return {u: long[u] if u in long else known[u] for u in wanted} if long else known

    def linked(self, units: list[str]) -> Iterator[tuple[str, Unit]]:
        """Each unit with its tokens and links; units that can stand beside each other are encoded as one text."""
        inner = [u for u in units if not (u[0].isspace() or u[-1].isspace())] if self.cuttable else []
        if inner:
            yield from self._linked(inner)
        if len(inner) < len(units):
            for u in set(units).difference(inner):
                yield from self._linked([u])

    def _linked(self, units: list[str]) -> Iterator[tuple[str, Unit]]:
        text = " ".join(units)
        whole = b" " + text.encode()
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
        if (
            b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole
        ):  # some unit does not give back its bytes
            if len(units) == 1:
                yield units[0], None
            else:
                yield from self._linked(units[: len(units) // 2])
                yield from self._linked(units[len(units) // 2 :])
            return
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        stop_a, stop_b = np.searchsorted(ends_a, ends) + 1, np.searchsorted(ends_b, ends) + 1
        at = np.searchsorted(ends_a, ends_b)
        last_b = np.flatnonzero(ends_a[at] == ends_b)  # last tokens of the groups
        last_a = at[last_b]
        # Each group's A tokens, then its B tokens.
        sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        place_a = np.arange(len(ids_a)) + np.repeat(last_b + 1 - sizes_b, sizes_a)
        place_b = np.arange(len(ids_b)) + np.repeat(last_a + 1, sizes_b)
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[place_a], order[place_b] = ids_a, ids_b
        order[place_a[last_a]] += self.ids
        order[place_b[last_b]] += 2 * self.ids
        words = list(map(self.words.__getitem__, order.tolist()))
        codes = self.code(ids_a[last_a], ids_b[last_b]).tobytes()
        links = (8 * (np.searchsorted(ends_a[last_a], ends) + 1)).tolist()
        tokens = (stop_a + stop_b).tolist()
        own_a, own_b = np.diff(stop_a, prepend=0).tolist(), np.diff(stop_b, prepend=0).tolist()
        i = j = 0
        for u, n_a, n_b, link, token in zip(units, own_a, own_b, links, tokens, strict=True):
            yield u, (n_a, n_b, "".join(words[j:token])[:-1], codes[i:link])
            i, j = link, token


_CODECS: dict[str, Codec] = {}


def codec_of(definition: str, model: bytes) -> Codec:
    """The codec of a worker, with what it remembers from its earlier tasks; only the last one is kept."""
    name = hashlib.sha256(definition.encode() + model).hexdigest()
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = Codec(definition, model)
    return _CODECS[name]


#: Numbers of A's and B's tokens, the groups' text, the linked pairs; none if the bytes differ.
Unit = tuple[int, int, str, bytes] | None


class Run:
    """Documents and pair-document records of a run in the making."""

    def __init__(self, codec: Codec, label: str, keep_groups: bool):
        self.codec, self.label, self.keep_groups = codec, label, keep_groups
        self.rows: list[tuple] = []
        self.keys: list[pa.Array] = []
        self.codes: list[np.ndarray] = []
        self.shares: list[np.ndarray] = []
        self.records = 0

    @property
    def full(self) -> bool:
        return self.records >= RUN_RECORDS or len(self.rows) >= RUN_DOCS

    def add(self, parts: Iterator[list[Unit]]) -> None:
        """A document by the units of its parts."""
        n_a = n_b = n_links = 0
        digest, groups, codes = hashlib.sha256(), [], []
        for units in parts:
            if None in units:
                n_a = 0
                break
            sizes_a, sizes_b, texts, links = zip(*units, strict=True)
            text = (";" if codes else "") + ";".join(texts)
            digest.update(text.encode())
            if self.keep_groups:
                groups.append(text)
            own = np.frombuffer(b"".join(links), np.int64)
            n_a, n_b, n_links = n_a + sum(sizes_a), n_b + sum(sizes_b), n_links + len(own)
            codes.append(np.unique(own, return_counts=True))
        if not n_a:
            self.rows.append((0, 0, 0, 0, "", "" if self.keep_groups else None))
            return
        self.rows.append((n_a, n_b, n_links, n_links, digest.hexdigest(), "".join(groups) if self.keep_groups else None))
        own, shares = codes[0]
        if len(codes) > 1:
            own, at = np.unique(np.concatenate([c for c, _ in codes]), return_inverse=True)
            shares = np.zeros(len(own), np.int64)
            np.add.at(shares, at, np.concatenate([s for _, s in codes]))
        self.codes.append(own)
        self.shares.append(np.column_stack([np.full(len(own), len(self.rows) - 1), shares]).astype("<u4"))
        self.records += len(own)

    def written(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The documents, then the pieces."""
        if self.rows:
            size = len(self.rows)
            columns = dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"), zip(*self.rows, strict=True), strict=True))
            columns |= {"run": [self.label] * size, "ordinal": range(size), "k": pa.concat_arrays(self.keys)}
            yield filled(schema, columns, size)
        if self.records:
            yield from self._pieces(schema)

    def _pieces(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        codes, shares = np.concatenate(self.codes), np.concatenate(self.shares)
        order = np.argsort(codes, kind="stable")
        codes, shares = codes[order], shares[order]
        pairs, first, docs = np.unique(codes, return_index=True, return_counts=True)
        totals = np.add.reduceat(shares[:, 1].astype(np.int64), first)
        radix = pairs // (self.codec.rows * self.codec.size_a)
        for bucket in np.unique(radix).tolist():
            p, q = np.searchsorted(radix, [bucket, bucket + 1])
            i, j = first[p], first[q] if q < len(first) else len(codes)
            entries = np.empty(q - p, PAIR)
            entries["code"], entries["n"] = pairs[p:q], totals[p:q]
            columns = {
                "run": [self.label], "bucket": [bucket], "pairs": [packed(entries)],
                "docs": [packed(docs[p:q].astype("<u4"))], "ordinals": [packed(shares[i:j, 0].copy())],
                "shares": [packed(shares[i:j, 1].copy())],
            }
            yield filled(schema, columns, 1)


def packed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def filled(schema: pa.Schema, columns: dict, size: int) -> pa.RecordBatch:
    arrays = [
        columns[f.name].cast(f.type) if isinstance(columns.get(f.name), pa.Array)
        else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def entries(data: bytes) -> Iterator[tuple[int, int]]:
    """The (pair, number) entries of a stream, in order, read block by block."""
    import zstandard

    stream = io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(data), BLOCK * PAIR.itemsize)
    while block := stream.read(BLOCK * PAIR.itemsize):
        values = np.frombuffer(block, PAIR)
        yield from zip(values["code"].tolist(), values["n"].tolist(), strict=True)


def merged(streams: list[bytes]) -> bytes:
    """One stream with the sum of each pair's numbers."""
    import zstandard

    out = io.BytesIO()
    with zstandard.ZstdCompressor(level=1).stream_writer(out, closefd=False) as writer:
        block = array("q")
        for code, same in groupby(heapq.merge(*map(entries, streams)), key=itemgetter(0)):
            block.append(code)
            block.append(sum([n for _, n in same]))
            if len(block) >= 2 * BLOCK:
                writer.write(block.tobytes())
                del block[:]
        writer.write(block.tobytes())
    return out.getvalue()


def runs_of(definition: str, model: bytes, schema: pa.Schema, keep_groups: bool) -> Callable:
    """A partition's texts as documents and pieces of runs."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(definition, model)
        part, made = TaskContext.get().partitionId(), 0
        run = Run(codec, f"{part:08d}-{made:08d}", keep_groups)
        for batch in batches:
            keys, texts = batch.column("k"), batch.column("t")
            lengths = batch.column("size").to_numpy()
            at = 0
            while at < len(texts):
                # Some texts at a time, about PART_CHARS together; a long one alone and in parts.
                end = at + 1
                total = lengths[at]
                while end < len(texts) and total + lengths[end] <= PART_CHARS:
                    total += lengths[end]
                    end += 1
                some = [t.as_py() for t in texts[at:end]]
                run.keys.append(keys.take(pa.array(range(at, end), pa.int64())))
                if len(some) == 1:
                    parts = (codec.units(p) for p in codec.parts(some[0]) if p)
                    run.add([own[u] for u in units] for units in parts for own in [codec.learned(units)])
                else:
                    texts_units = [codec.units(t) if t else [] for t in some]
                    own = codec.learned([u for units in texts_units for u in units])
                    for units in texts_units:
                        run.add(iter([[own[u] for u in units]] if units else []))
                at = end
                if run.full:
                    yield from run.written(schema)
                    made += 1
                    run = Run(codec, f"{part:08d}-{made:08d}", keep_groups)
        yield from run.written(schema)

    return of


RUN = [
    ("run", T.StringType()), ("ordinal", T.LongType()), ("k", None), ("n_a", T.LongType()), ("n_b", T.LongType()),
    ("n_groups", T.LongType()), ("n_links", T.LongType()), ("groups_sha256", T.StringType()),
    ("groups", T.StringType()), ("bucket", T.IntegerType()), ("pairs", T.BinaryType()), ("docs", T.BinaryType()),
    ("ordinals", T.BinaryType()), ("shares", T.BinaryType()),
]


class Alignment:
    """``documents`` and ``pairs`` of a corpus, from runs written once."""

    def __init__(
        self, docs: DataFrame, definition: str, model: bytes, text: str = "text",
        keep: tuple[str, ...] = ("doc_id",), keep_groups: bool = False, fan_in: int = FAN_IN,
    ):
        from pyspark.sql.pandas.types import to_arrow_schema

        t = text_column(docs, text)
        rows = docs.select(F.struct(*keep).alias("k"), t.alias("t"), F.length(t).alias("size"))
        kind = rows.schema["k"].dataType
        schema = T.StructType([T.StructField(name, kind_ or kind) for name, kind_ in RUN])
        of = runs_of(definition, model, to_arrow_schema(schema), keep_groups)
        codec = Codec(definition, model)
        self.size_a, self.rows_b, self.fan_in = codec.size_a, codec.rows, fan_in
        self.runs = settle(rows.mapInArrow(of, schema), "runs")
        pieces = self.runs.where(F.col("bucket").isNotNull())
        found, self.count = numbered(pieces.select("run").distinct(), ["run"])
        self.numbers = settle(found.select("run", F.col("number").alias("at")), "numbers")
        self.pieces = pieces.join(self.numbers, "run")
        self.counts = settle(self._counted(), "counts")

    def _counted(self) -> DataFrame:
        """For each radix its pairs in order, their counts, and whether they are the highest of their B id."""

        def merge(key: tuple, group: pa.Table) -> pa.Table:
            streams = [s.as_py() for s in group["pairs"]]
            row = {"bucket": key[0].as_py(), "at": key[1].as_py(), "pairs": merged(streams)}
            return pa.Table.from_pylist([row], pa.schema([("bucket", pa.int32()), ("at", pa.int64()), ("pairs", pa.binary())]))

        streams, count = self.pieces.select("bucket", "at", "pairs"), self.count
        while count > 1:
            up = F.floor(F.col("at") / self.fan_in).cast("long").alias("up")
            streams = settle(
                streams.groupBy("bucket", up).applyInArrow(merge, "bucket int, at long, pairs binary"), "merged"
            )
            count = -(-count // self.fan_in)
        size_a = self.size_a

        def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for bucket, data in zip(batch["bucket"].to_pylist(), batch["pairs"], strict=True):
                    values = unpacked_stream(data.as_py())
                    side = values["code"] // size_a  # in order: a side's pairs are neighbours
                    first = np.flatnonzero(np.diff(side, prepend=-1))
                    most = np.maximum.reduceat(values["n"], first) if len(first) else values["n"]
                    best = values["n"] == np.repeat(most, np.diff(first, append=len(side)))
                    yield pa.RecordBatch.from_pydict(
                        {"bucket": pa.array([bucket], pa.int32()), "counts": [packed(values)], "best": [packed(best.astype("u1"))]}
                    )

        return streams.select("bucket", "pairs").mapInArrow(highest, "bucket int, counts binary, best binary")

    @property
    def pairs(self) -> DataFrame:
        """a_id, b_id, n_links over the corpus, and whether that is the highest of the B id."""
        size_a, rows_b = self.size_a, self.rows_b

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for bucket, data, flags in zip(batch["bucket"].to_pylist(), batch["counts"], batch["best"], strict=True):
                    values, best = unpacked(data.as_py(), PAIR), unpacked(flags.as_py(), "u1")
                    for i in range(0, len(values), BLOCK):
                        code = values["code"][i : i + BLOCK]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "a_id": code % size_a, "b_id": (code // size_a - bucket * rows_b) * RADIX + bucket,
                                "n_links": values["n"][i : i + BLOCK], "best": best[i : i + BLOCK] == 1,
                            }
                        )

        return self.counts.mapInArrow(of, "a_id long, b_id long, n_links long, best boolean")

    @property
    def documents(self) -> DataFrame:
        """``keep``, n_a, n_b, n_groups, n_links, groups_sha256, groups (null unless kept), n_best, count_sum."""

        def shared(pieces: pa.Table, counts: pa.Table) -> pa.Table:
            """What the documents of some pieces get from one radix."""
            values, best = unpacked(counts["counts"][0].as_py(), PAIR), unpacked(counts["best"][0].as_py(), "u1")
            runs, parts = [], []
            for piece in pieces.to_batches():
                for row in range(piece.num_rows):
                    one = {c: piece[c][row].as_py() for c in ("run", "pairs", "docs", "ordinals", "shares")}
                    at = np.searchsorted(values["code"], unpacked_stream(one["pairs"])["code"])
                    docs = unpacked(one["docs"], "<u4")
                    shares = unpacked(one["shares"], "<u4").astype(np.int64)
                    ordinals, back = np.unique(unpacked(one["ordinals"], "<u4"), return_inverse=True)
                    out = np.zeros((3, len(ordinals)), np.int64)
                    out[0] = ordinals
                    np.add.at(out[1], back, shares * np.repeat(best[at], docs))
                    np.add.at(out[2], back, shares * np.repeat(values["n"][at], docs))
                    runs.append(one["run"])
                    parts.append(packed(out))
            return pa.table({"run": pa.array(runs, pa.string()), "part": pa.array(parts, pa.binary())})

        some = F.floor(F.col("at") / self.fan_in).cast("long").alias("some")
        pieces = self.pieces.select("bucket", some, "run", "pairs", "docs", "ordinals", "shares")
        places = settle(self.pieces.select("bucket", some).distinct(), "places")
        wanted = places.join(self.counts, "bucket")
        parts = (
            pieces.groupBy("bucket", "some").cogroup(wanted.groupBy("bucket", "some"))
            .applyInArrow(shared, "run string, part binary")
        )
        rows = self.runs.where(F.col("bucket").isNull()).drop("bucket", "pairs", "docs", "ordinals", "shares")
        schema = T.StructType([*rows.schema, *[T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")]])

        def total(rows: pa.Table, parts: pa.Table) -> pa.Table:
            sums = np.zeros((2, rows.num_rows), np.int64)
            for part in parts["part"]:
                ordinals, best, count = unpacked(part.as_py(), "<i8").reshape(3, -1)
                sums[0, ordinals] += best
                sums[1, ordinals] += count
            at = rows["ordinal"].to_numpy()
            return rows.append_column("n_best", pa.array(sums[0, at])).append_column("count_sum", pa.array(sums[1, at]))

        full = rows.groupBy("run").cogroup(parts.groupBy("run")).applyInArrow(total, schema)
        return full.select("k.*", *full.columns[3:])


def unpacked_stream(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().stream_reader(data).readall(), PAIR)


def align(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, **options) -> Alignment:
    """``vocabulary_a``: a byte-level tokenizer file, ``vocabulary_b``: a piece model; the driver reads them."""
    with open(vocabulary_a, encoding="utf-8") as a, open(vocabulary_b, "rb") as b:
        return Alignment(docs, a.read(), b.read(), **options)


def op13_spill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = align(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return found.documents.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
