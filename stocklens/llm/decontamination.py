"""Benchmark decontamination by an Aho-Corasick automaton over normalised test items.

Texts are normalised byte by byte: A-Z to lower case, every other ASCII character that is no letter
or digit to a blank. No byte is added or removed, so a place in the normalised text is the same place
in the original. Words are what blanks leave; bytes beyond ASCII are parts of words.

A *window* is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
window. The automaton reads word numbers instead of letters: a word that no item has is number 0,
which no pattern holds. It runs over a text once and reports each window's last word; the words of all
occurrences are hit. Only texts with a hit are looked at again, for the places of their words.

The automaton is broadcast, so its size has a bound: at most ``block_rows`` pairs of window and item
(and a window is ``window`` words at most). Benchmarks within the bound, the usual case, take one pass
without a shuffle. A larger one is cut into blocks of that size, each with an automaton of its own
that reads the texts once; a text's hits from all blocks are then joined by the text's digest, the
documents' side being as many rows as there are and the other one row for each text with hits. A
window that very many items share may be in several blocks; nothing is left out.

Long texts are read in runs of ``RUN_BYTES`` with ``window - 1`` words carried over, and whole.

Defined results: null texts have no words and no hits; items without words (null, empty) have no
window; repeated items and equal item ids count once, a null item id counts as one item written as the
empty string; repeated documents are scanned row by row; an empty benchmark leaves all documents
clean, an empty document table gives no rows; other columns are not read and may have any name.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle, table
from .sharding import numbered

WINDOW = 10
BLOCK_ROWS = 200_000  # windows with their items in one automaton: at most 2,000,000 nodes
RUN_BYTES = 1 << 20
#: Letters to lower case, separators to blanks, all else as it is.
LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
WORD = re.compile(rb"[^ ]+")
SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")

SPAN = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_words", T.ArrayType(T.LongType())),  # first and last word of each run, in turn
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)


class Automaton:
    """Windows of words with the items that hold them."""

    def __init__(self, windows: list[tuple[bytes, str]]):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        self.items: list[list[str]] = []
        self.sizes: list[int] = []
        self.longest = 0
        known: dict[tuple[int, ...], int] = {}
        for words, item in windows:
            key = tuple([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words.split(b" ")])
            at = known.setdefault(key, len(known))
            if at == len(self.items):
                self.items.append([])
                self.sizes.append(len(key))
                self.longest = max(self.longest, len(key))
            self.items[at].append(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for key, at in known.items():
            self.automaton.add_word(key, at)
        if known:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[list[int]], set[str]]:
        """Number of words, runs of hit words (first, last) in order, and the items found."""
        count, runs, found = 0, [], set()
        carried: list[bytes] = []
        for words in runs_of_words(text):
            old, words = len(carried), carried + words
            if self.items:
                for end, window in self.automaton.iter(tuple(map(self.numbers.get, words, repeat(0)))):
                    if end >= old:  # the run before has reported the others
                        last = count - old + end
                        add(runs, last - self.sizes[window] + 1, last)
                        found.add(window)
                carried = words[1 - self.longest :] if self.longest > 1 else []
            count += len(words) - old
        return count, runs, {i for w in found for i in self.items[w]}


def runs_of_words(text: bytes) -> Iterator[list[bytes]]:
    """The normalised words of about ``RUN_BYTES`` at a time; no word is cut."""
    at = 0
    while at < len(text):
        end = SEPARATOR.search(text, at + RUN_BYTES)
        stop = end.start() if end else len(text)
        yield text[at:stop].translate(LOWER).split()
        at = stop


def add(runs: list[list[int]], first: int, last: int) -> None:
    """Add a range of words to runs in order; no earlier range ended later. Runs that touch or overlap
    become one."""
    while runs and runs[-1][1] >= first - 1:
        start, end = runs.pop()
        first, last = min(first, start), max(last, end)
    runs.append([first, last])


def spans_of(text: bytes, runs: list[list[int]]) -> list[dict[str, int]]:
    """The runs' places in the text, in code points, the end after the last."""
    wanted = iter([n for run in runs for n in run])
    places, words, next_word, at, points = [], enumerate(WORD.finditer(text.translate(LOWER))), next(wanted, None), 0, 0
    for n, m in words:
        while n == next_word:
            first = len(places) % 2 == 0
            place = m.start() if first else m.end()
            points += len(text[at:place].decode("utf-8", "replace"))
            at = place
            places.append(points)
            next_word = next(wanted, None)
        if next_word is None:
            break
    return [{"start": places[i], "end": places[i + 1]} for i in range(0, len(places), 2)]


_BUILT: dict[str, Automaton] = {}


def built(label: str, windows: Broadcast) -> Automaton:
    """The automaton of a broadcast block, built once in a worker; only the last one is kept."""
    if label not in _BUILT:
        _BUILT.clear()
        _BUILT[label] = Automaton(windows.value)
    return _BUILT[label]


def scanned(windows: Broadcast, text: Column) -> Column:
    label = uuid.uuid4().hex

    @F.arrow_udf(FOUND)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = built(label, windows)
        for texts in batches:
            rows = []
            for one in texts:
                t = one.as_py() or b""
                count, runs, items = automaton.scan(t)
                rows.append(
                    {
                        "n_words": count,
                        "hit_words": [n for run in runs for n in run],
                        "items": sorted(items),
                        "spans": spans_of(t, runs) if runs else [],
                    }
                )
            yield pa.array(rows, T_FOUND)

    return of(text)


T_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
T_FOUND = pa.struct(
    [
        ("n_words", pa.int64()), ("hit_words", pa.list_(pa.int64())),
        ("items", pa.list_(pa.string())), ("spans", pa.list_(T_SPAN)),
    ]
)


def item_windows(items: DataFrame, texts: tuple[str, ...], item_id: str, window: int) -> DataFrame:
    """Distinct (words, item) of all windows; each text column of an item is cut on its own."""

    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = []
            for one in column:
                words = (one.as_py() or b"").translate(LOWER).split()
                ends = range(min(window, len(words)), len(words) + 1) if words else ()
                rows.append([b" ".join(words[max(0, e - window) : e]) for e in ends])
            yield pa.array(rows, pa.list_(pa.binary()))

    each = [
        items.select(
            F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
            F.col(t).cast("string").cast("binary").alias("t"),
        )
        for t in texts
    ]
    rows = each[0]
    for more in each[1:]:
        rows = rows.unionAll(more)
    return rows.select("item", F.explode(cut("t")).alias("words")).select("words", "item").distinct()


def blocks(items: DataFrame, texts: tuple[str, ...], item_id: str, window: int, rows: int) -> Iterator[Broadcast]:
    """The windows in broadcast blocks of at most ``rows``; one empty block for an empty benchmark."""
    spark = items.sparkSession
    found = settle(item_windows(items, texts, item_id, window), "windows")
    total = found.count()
    count = max(1, -(-total // rows))
    if count == 1:
        yield spark.sparkContext.broadcast([(bytes(r.words), r.item) for r in found.collect()])
        return
    # By window and item, so that also the items of one very common window go to several blocks.
    ranked, _ = numbered(found, ["words", "item"])
    dealt = settle(ranked.withColumn("block", F.floor(F.col("number") / rows).cast("int")), "blocks")
    for block in range(count):
        part = dealt.where(F.col("block") == block).select("words", "item").collect()
        yield spark.sparkContext.broadcast([(bytes(r.words), r.item) for r in part])


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", item_texts: tuple[str, ...] = ("text",),
    item_id: str = "item_id", keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``keep`` and, for each document: n_words; hit_words (first and last number of each run of hit
    words, in turn); items (ids found, as sorted strings); spans (start and end of these runs in code points
    of the original text)."""
    passes = list(blocks(items, item_texts, item_id, window, block_rows))
    t = F.col(text).cast("string").cast("binary")
    if len(passes) == 1:
        rows = docs.select(F.struct(*keep).alias("k"), scanned(passes[0], t).alias("f"))
        return rows.select("k.*", "f.*")
    one_each = docs.select(F.struct(*keep).alias("k"), t.alias("t"), F.sha2(t, 256).alias("h"))
    hits = None
    for windows in passes:
        # Only texts with hits go on, each once.
        part = one_each.select("h", "t", scanned(windows, F.col("t")).alias("f"))
        part = settle(
            part.where(F.size("f.hit_words") > 0)
            .groupBy("h")
            .agg(F.first("t").alias("t"), F.first("f").alias("f"))
            .select("h", "t", F.col("f.hit_words").alias("w"), F.col("f.items").alias("i")),
            "hits",
        )
        hits = part if hits is None else hits.unionAll(part)
    whole = hits.groupBy("h").agg(
        F.first("t").alias("t"),
        F.flatten(F.collect_list("w")).alias("w"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("i")))).alias("items"),
    )
    runs = settle(whole.select("h", "items", combined(F.col("t"), F.col("w")).alias("c")), "runs")
    counted = one_each.select("k", "h", word_count(F.col("t")).alias("n_words"))
    empty = F.array().cast(T.ArrayType(T.LongType()))
    return counted.join(runs, "h", "left").select(
        "k.*",
        "n_words",
        F.coalesce("c.hit_words", empty).alias("hit_words"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("c.spans", F.array().cast(T.ArrayType(SPAN))).alias("spans"),
    )


def combined(text: Column, words: Column) -> Column:
    """Runs of several blocks as one list, and their places."""
    kind = T.StructType([T.StructField("hit_words", T.ArrayType(T.LongType())), T.StructField("spans", T.ArrayType(SPAN))])

    @F.arrow_udf(kind)
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            rows = []
            for one, numbers in zip(texts, lists, strict=True):
                n = numbers.as_py()
                runs: list[list[int]] = []
                for last, first in sorted(zip(n[1::2], n[::2], strict=True)):
                    add(runs, first, last)
                rows.append({"hit_words": [x for r in runs for x in r], "spans": spans_of(one.as_py(), runs)})
            yield pa.array(rows, pa.struct([("hit_words", pa.list_(pa.int64())), ("spans", pa.list_(T_SPAN))]))

    return of(text, words)


def word_count(text: Column) -> Column:
    @F.arrow_udf(T.LongType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([sum(map(len, runs_of_words(t.as_py() or b""))) for t in texts], pa.int64())

    return of(text)


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any hit, all their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    return decontaminate(rows, items, keep=("row",), **options).where(F.size("hit_words") == 0).select("row.*")


def n_hit(hit_words: Column) -> Column:
    """Number of words in the runs."""
    signed = F.transform(hit_words, lambda n, i: F.when(i % 2 == 0, 1 - n).otherwise(n))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda s, n: s + n)


def op11_aho_corasick_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words",
        n_hit(F.col("hit_words")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


#: The same rows in DuckDB: every run of n words of a document is looked up among windows of n words.
OP11_SQL = r"""
WITH item AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
run AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)),
hit AS (SELECT r, run.n, i, id FROM run JOIN win USING (n, words)),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN ids USING (r)"""
