"""BPE encoding and decoding by tree concatenation.

Texts of up to ``leaf_chars`` code points are encoded in one go. A longer text, also one without
any place where the tokenizer would split it, is halved until its leaves are short enough; the leaves are encoded
in parallel, in tasks of their own, and joined pairwise up the tree. At each join a window of text
around the seam is encoded again and grows until, on either side, it ends in a token that the side
has at the same place too.

Why that is exact: a sequence of BPE tokens is the encoding of its text if and only if each pair of
neighbours is the encoding of its own text. All pairs left of the shared token come from the left
encoding, all in between from the window's, all right of it from the right encoding. A window only
starts or ends at a *clean* place: after white space or a digit, or inside a run of letters
or of symbols, away from its ends, where neither normalisation nor the pattern that splits words
looks across. Special tokens are shorter than the least window. If no clean place with equal tokens
is found, the window grows to the whole text, which is encoded as such.

Inside a leaf, words between white space are independent (white space is dropped, no pattern
crosses it), so each worker remembers the tokens of words it has met, up to ``MEMORY`` of them.

Defined results: null and empty texts have no tokens and decode to the empty text; repeated rows
are encoded row by row; other columns are not read and may have any name.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, settle, table, text_column

LEAF_CHARS = 32_768
WINDOW_CHARS = 64  # least window on either side of a seam; longer than any special token
MEMORY = 150_000  # words that a task remembers before it starts anew, from what comes back
BATCH_CHARS = 1 << 18  # short texts are encoded together up to this size
LONGEST_WORD = 64  # longer words are encoded without being remembered
#: White space of the Unicode standard.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = re.compile(f"[{SPACES}]")
WORD = re.compile(f"[^{SPACES}]+")
ODD_SPACE = re.compile("[\x1c-\x1f]")  # str.split() cuts there, the tokenizer does not


PUNCTUATION = string.punctuation
#: Latin letters that stay one letter in lower case (U+0130 does not).
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")


class Codec:
    """A tokenizer file and the words met so far."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Without a decoder the decoded text is the tokens with one space between them.
        self.joins_tokens = self.tokenizer.decoder is None
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) for i in range(size)] if self.joins_tokens else []
        suffix = json.loads(definition).get("model", {}).get("end_of_word_suffix")
        self.word_end = np.array([t.endswith(suffix) for t in self.tokens], bool) if suffix and self.tokens else None
        # Ids as little-endian 32-bit numbers and nothing else: a worker holds up to 4 * MEMORY of them.
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        # What was met before the last clearing: words that come back are taken over from here.
        self.old_words: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.placed: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Encode ``words``; those that are not too long stay in memory."""
        known, again, old, held = self.pieces, self.old_pieces, self.old_words, self.words
        out, todo, new, long = {}, [], {}, {}
        for word in words:
            found = old.get(word)
            if found is not None:
                out[word] = held[word] = found
                continue
            own = pieces(word)
            todo.append((word, own))
            for piece in own:
                if piece not in known:
                    found = again.get(piece)
                    if found is None:
                        new[piece] = None
                    else:
                        known[piece] = found
        for piece, ids in self._encoded(list(new)):
            (known if len(piece) <= LONGEST_WORD else long)[piece] = array("I", ids).tobytes()
        for word, own in todo:
            first = own[0]
            found = known[first] if first in known else long[first]
            if len(own) > 1:
                found += known[own[1]] if own[1] in known else long[own[1]]
            out[word] = found
            if len(word) <= LONGEST_WORD:
                held[word] = found
        if len(held) > MEMORY:
            self.words, self.old_words = {}, held
        if len(known) > MEMORY:
            self.pieces, self.old_pieces = {}, known
        return out

    def _encoded(self, new: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Ids of each piece. Latin words are one word to the tokenizer, whose last token carries its
        end: they are encoded as one text and told apart by these tokens."""
        plain = [p for p in new if LATIN.fullmatch(p)] if self.word_end is not None else []
        if plain:
            found = np.array(self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(self.word_end[found]) + 1
            if len(ends) == len(plain) and ends[-1] == len(found):
                ids, first = found.tolist(), 0
                for piece, end in zip(plain, ends.tolist(), strict=True):
                    yield piece, ids[first:end]
                    first = end
                new = [p for p in new if not LATIN.fullmatch(p)]
        for piece, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            yield piece, e.ids

    def encode_all(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text ids as little-endian 32-bit numbers, and the decoded text."""
        split = [WORD.findall(t) if ODD_SPACE.search(t) else t.split() for t in texts]
        known = self.words
        missing = [w for w in set(chain.from_iterable(split)) if w not in known]
        learned = self._learn(missing) if missing else {}
        long = {w: learned[w] for w in missing if len(w) > LONGEST_WORD}
        tokens = self.tokens
        for words in split:
            ids = b"".join([long[w] if w in long else known[w] for w in words] if long else [known[w] for w in words])
            numbers = np.frombuffer(ids, "<u4").tolist()
            yield ids, " ".join([tokens[i] for i in numbers]) if self.joins_tokens else self.decode(numbers)

    def encode(self, text: str) -> tuple[bytes, str]:
        return next(self.encode_all([text]))

    def place(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the place in ``text`` where each token starts."""
        ids, starts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        found = list(WORD.finditer(text))
        if len(self.placed) >= MEMORY:
            self.placed = {}
        placed = self.placed
        new = [w for w in dict.fromkeys(m[0] for m in found) if w not in placed]
        long = {}
        for word, e in zip(new, self.tokenizer.encode_batch(new, add_special_tokens=False), strict=True):
            known = np.array(e.ids, np.uint32), np.array([o[0] for o in e.offsets], np.int64)
            (placed if len(word) <= LONGEST_WORD else long)[word] = known
        for m in found:
            known = placed.get(m[0]) or long[m[0]]
            ids.append(known[0])
            starts.append(known[1] + m.start())
        return np.concatenate(ids), np.concatenate(starts)

    def join(self, text: str, left: tuple, right: tuple, seam: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of ``text``, whose parts before and after ``seam`` have ``left`` and ``right``
        (ids and starts, all counted from the start of ``text``)."""
        reach = WINDOW_CHARS
        while reach < seam or reach < len(text) - seam:
            i = clean_place(text, left[1], seam - reach, -1)
            j = clean_place(text, right[1], seam + reach, 1)
            stop = None if j is None else clean_place(text, right[1], int(right[1][j]) + reach, 1)
            begin = 0 if i is None else int(left[1][i])
            end = len(text) if stop is None else int(right[1][stop])
            ids, starts = self.place(text[begin:end])
            starts = starts + begin
            head, tail = i or 0, len(right[0])
            agreed = i is None or same_token(left, i, ids, starts, 0)
            if stop is not None:
                t = int(np.searchsorted(starts, right[1][j]))
                agreed = agreed and same_token(right, j, ids, starts, t)
                ids, starts, tail = ids[:t], starts[:t], j
            if agreed:
                return (
                    np.concatenate([left[0][:head], ids, right[0][tail:]]),
                    np.concatenate([left[1][:head], starts, right[1][tail:]]),
                )
            reach *= 2
        return self.place(text)

    def join_leaves(self, leaves: list[tuple[str, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Ids of the whole text, from its leaves in order (text, ids, starts), pair by pair."""
        while len(leaves) > 1:
            joined = []
            for k in range(0, len(leaves) - 1, 2):
                (a, *left), (b, ids, starts) = leaves[k], leaves[k + 1]
                joined.append((a + b, *self.join(a + b, left, (ids, starts + len(a)), len(a))))
            leaves = joined + leaves[len(joined) * 2 :]
        return leaves[0][1]


_CODECS: dict[str, Codec] = {}


def codec_of(definition: str) -> Codec:
    """The codec of a worker, with the words of its earlier tasks; only the last one is kept."""
    if definition not in _CODECS:
        _CODECS.clear()
        _CODECS[definition] = Codec(definition)
    return _CODECS[definition]


def pieces(word: str) -> tuple[str, ...]:
    """Parts of a word that the tokenizer treats on their own: letters and the ASCII punctuation
    that follows them, ASCII letters in lower case, as it sees them."""
    core = word.rstrip(PUNCTUATION)
    if core.isascii():
        if not core.isalpha():
            return (word,)
        core = core.lower()
    elif not unicodedata.normalize("NFC", core).lower().isalpha():  # it can end in a mark
        return (word,)
    return (core,) if len(core) == len(word) else (core, word[len(core) :])


def clean(text: str, at: int) -> bool:
    """Whether no rule of the tokenizer looks across this place."""
    before, after = text[at - 1], text[at]
    if SPACE.match(before) or (before in "0123456789" and after.isascii()):
        return True
    near = text[max(0, at - 3) : at + 3]
    if len(near) < 6 or any(map(unicodedata.combining, near)):
        return False
    halves = unicodedata.normalize("NFC", near[:3]) + unicodedata.normalize("NFC", near[3:])
    if not near == halves == unicodedata.normalize("NFC", near):
        return False
    if near.isalpha():
        return True
    return not set(near) & set("'<|>") and all(unicodedata.category(c)[0] in "PS" for c in near)


def clean_place(text: str, starts: np.ndarray, limit: int, step: int) -> int | None:
    """The nearest token from ``limit`` on, in the direction of ``step``, that starts at a clean
    place; none if the side's end comes first."""
    i = int(np.searchsorted(starts, limit, side="right")) - 1 if step < 0 else int(np.searchsorted(starts, limit))
    while 0 < i < len(starts) - 1:
        if starts[i - 1] < starts[i] < starts[i + 1] and clean(text, int(starts[i])):
            return i
        i += step
    return None


def same_token(side: tuple, i: int, ids: np.ndarray, starts: np.ndarray, t: int) -> bool:
    """Whether token ``t`` of the window is token ``i`` of the side: same id, start and end. The
    window's last token never is, as it can carry the end of a word that goes on."""
    return bool(
        t + 1 < len(ids)
        and side[0][i] == ids[t]
        and side[1][i] == starts[t]
        and side[1][i + 1] == starts[t + 1]
    )


RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
    ]
)
LEAF = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("starts", T.BinaryType())])


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def results(rows: list[tuple[bytes, str]], with_ids: bool) -> pa.Array:
    """RESULT of each (ids, digest of the decoded text); the texts themselves are not kept."""
    sizes = np.array([0, *(len(ids) // 4 for ids, _ in rows)], np.int64)
    if with_ids:
        values = np.frombuffer(b"".join([ids for ids, _ in rows]), "<i4")
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(values))
    else:
        lists = pa.nulls(len(rows), pa.list_(pa.int32()))
    return pa.StructArray.from_arrays(
        [
            pa.array(sizes[1:]),
            pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in rows], pa.string()),
            pa.array([decoded for _, decoded in rows], pa.string()),
            lists,
        ],
        RESULT.names,
    )


def whole(definition: str, with_ids: bool, text: Column) -> Column:
    @F.arrow_udf(RESULT)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(definition)
        for texts in batches:
            sizes, rows, at = pc.utf8_length(texts).to_pylist(), [], 0
            while at < len(texts):  # some texts at a time as Python strings
                end, total = at + 1, sizes[at]
                while end < len(texts) and total + sizes[end] <= BATCH_CHARS:
                    total += sizes[end]
                    end += 1
                found = codec.encode_all(texts.slice(at, end - at).to_pylist())
                rows += [(ids, digest(decoded)) for ids, decoded in found]
                at = end
            yield results(rows, with_ids)

    return of(text)


def leaf(definition: str, text: Column) -> Column:
    @F.arrow_udf(LEAF)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(definition)
        for texts in batches:
            rows = [codec.place(t) for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([ids.astype("<u4").tobytes() for ids, _ in rows], pa.binary()),
                    pa.array([starts.astype("<i8").tobytes() for _, starts in rows], pa.binary()),
                ],
                LEAF.names,
            )

    return of(text)


def tree(definition: str, with_ids: bool, leaves: Column) -> Column:
    @F.arrow_udf(RESULT)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(definition)
        for lists in batches:
            rows = []
            for one in lists:
                parts = [
                    (p["text"], np.frombuffer(p["ids"], "<u4"), np.frombuffer(p["starts"], "<i8"))
                    for p in sorted(one.as_py(), key=lambda p: p["part"])
                ]
                ids = codec.join_leaves(parts)
                rows.append((ids.astype("<u4").tobytes(), digest(codec.decode(ids.tolist()))))
            yield results(rows, with_ids)

    return of(leaves)


def encode(
    docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    with_ids: bool = True, leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """``keep`` and n_tokens, ids_sha256, decoded_sha256, token_ids (null unless ``with_ids``).

    ``vocabulary``: a tokenizer file, read by the driver. Equal long texts are encoded once.
    """
    bounded_batches(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:
        definition = file.read()
    fields = [F.col(f"r.{c}").alias(c) for c in RESULT.names]
    rows = docs.select(F.struct(*keep).alias("k"), text_column(docs, text).alias("t"))
    long = rows.where(F.length("t") > leaf_chars).withColumn("h", F.sha2("t", 256))
    parts = F.pow(2, F.ceil(F.log2(F.length("t") / leaf_chars))).cast("long")
    cut = lambda i: F.floor(F.length("t") * i / F.col("parts")).cast("int")
    leaves = (
        long.withColumn("parts", parts)
        .select("h", "t", "parts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        .select("h", "part", F.substring("t", cut(F.col("part")) + 1, cut(F.col("part") + 1) - cut(F.col("part"))).alias("text"))
        .dropDuplicates(["h", "part"])
        .withColumn("l", leaf(definition, F.col("text")))
    )
    joined = settle(
        leaves.groupBy("h")
        .agg(F.collect_list(F.struct("part", "text", "l.ids", "l.starts")).alias("leaves"))
        .select("h", tree(definition, with_ids, F.col("leaves")).alias("r")),
        "long",
    )
    short = rows.where(F.length("t") <= leaf_chars).select(
        "k", whole(definition, with_ids, F.col("t")).alias("r")
    )
    return short.union(long.select("k", "h").join(joined, "h").select("k", "r")).select(
        "k.*", *fields
    )


def decode(encoded: DataFrame, vocabulary: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """``encoded`` with the decoded text in ``text``; null ids decode to the empty text."""
    with open(vocabulary, encoding="utf-8") as file:
        definition = file.read()

    @F.arrow_udf(T.StringType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(definition)
        for lists in batches:
            yield pa.array([codec.decode(x or []) for x in lists.to_pylist()], pa.string())

    return encoded.withColumn(text, of(F.col(ids)))


def op10_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False
    ).drop("token_ids")
