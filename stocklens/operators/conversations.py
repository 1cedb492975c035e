"""Analytics over a message log.

A message has a conversation, a position in it (``turn``, an integer), a sender and a text;
``sent_at`` and ``links`` are optional.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONV = "conversation_id"
CHUNK_TURNS = 1024

# Limits of the message rules.
TAIL_MESSAGES = 12
MIN_TAIL_CHARS = 8
TAIL_WINDOW_SECONDS = 4.0
SNIPPET_CHARS = 88
EMPTY_SNIPPET = "New chat"

# Intent -> words, tried in this order on folded text.
INTENTS: dict[str, list[str]] = {
    "overview": [
        "tong quan", "overview", "hien tai", "current inventory", "gia tri ton kho",
    ],
    "low_stock": ["sap het", "thieu hang", "low stock", "stockout", "reorder"],
    "overstock": ["overstock", "vuot max", "ton qua muc", "du hang"],
    "warehouse": ["warehouse", "kho nao", "theo kho", "tung kho"],
    "movement": ["movement", "nhap xuat", "bien dong", "xuat nhap", "giao dich kho"],
    "replenishment": ["po", "mua hang", "replenishment", "inbound", "don mua"],
}
NO_INTENT = "help"

# White space as a browser counts it.
_SPACE = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]+"
# White space of the context tail: separators U+001C-001F and U+0085 count, U+FEFF does not.
_STRIP = r"[\t\n\x0B\f\r\x1C-\x1F \u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"
_WORD = r"[\p{L}\p{N}_]"


def list_conversations(msgs: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    """Conversations, the most recent first, with their first message.

    The page is chosen from turns alone; texts are read only for the conversations on it.
    """
    recent_first = [F.desc("updated_at"), F.asc(CONV)]
    page = (
        msgs.groupBy(CONV)
        .agg(F.min("turn").alias("started_at"), F.max("turn").alias("updated_at"))
        .orderBy(*recent_first)
        .offset(max(offset, 0))
        .limit(max(limit, 0))
    )
    opening = msgs.select(CONV, F.col("turn").alias("started_at"), "message")
    return (
        opening.join(page, [CONV, "started_at"])
        # Messages of the same position: the least of them, so that a page keeps its size.
        .groupBy(CONV, "started_at", "updated_at")
        .agg(F.min("message").alias("message"))
        .orderBy(*recent_first)
        .select(CONV, "started_at", F.coalesce("message", F.lit("")).alias("first_message"))
    )


def history_page(msgs: DataFrame, page: int = 1, page_size: int = 100) -> DataFrame:
    """One page of every conversation, in order, with a flag for more pages.

    The row-number limit is applied on the map side, so a very long conversation sends no more
    than the rows up to the page end, plus one, from each task.
    """
    first = max(page - 1, 0) * page_size
    last = first + page_size
    ordered = Window.partitionBy(CONV).orderBy("turn")
    seen = msgs.withColumn("position", F.row_number().over(ordered)).filter(
        F.col("position") <= last + 1
    )
    whole = Window.partitionBy(CONV)
    more = F.max("position").over(whole) > last
    rows = seen.withColumn("has_more", more).filter(F.col("position").between(first + 1, last))
    return rows.withColumn("next_offset", F.when(F.col("has_more"), F.lit(last))).select(
        CONV, "position", "turn", "sender", "message", "has_more", "next_offset"
    )


def context_tail(msgs: DataFrame, n: int = TAIL_MESSAGES) -> DataFrame:
    """The last ``n`` messages of each conversation, then without blanks and other senders."""
    recent = Window.partitionBy(CONV).orderBy(F.desc("turn"))
    text, sender = trim_all("message"), F.lower("sender")
    role = F.when(sender == "user", "user").when(sender.isin("assistant", "bot"), "assistant")
    return (
        msgs.withColumn("age", F.row_number().over(recent))
        .filter(F.col("age") <= n)
        .select(CONV, "turn", role.alias("role"), text.alias("content"))
        .filter(F.col("role").isNotNull() & (F.col("content") != ""))
    )


def trim_all(name: str) -> Column:
    return F.regexp_replace(F.coalesce(name, F.lit("")), rf"^{_STRIP}|{_STRIP}$", "")


def compact(name: str) -> Column:
    """Text with white space collapsed to single blanks and trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), _SPACE, " "))


def snippet(name: str) -> Column:
    text = compact(name)
    cut = F.concat(F.substring(text, 1, SNIPPET_CHARS - 1), F.lit("..."))
    return F.when(F.length(text) > SNIPPET_CHARS, cut).when(text == "", EMPTY_SNIPPET).otherwise(
        text
    )


def snippets(msgs: DataFrame) -> DataFrame:
    return msgs.select(CONV, "turn", snippet("message").alias("snippet"))


def _folded(text: Column) -> Column:
    """Compatibility decomposition, then all marks deleted, in Arrow batches. The function is local,
    so that it travels to the workers by value, with the table of marks."""
    marks = {code: None for code in range(sys.maxunicode + 1) if unicodedata.combining(chr(code))}

    @F.arrow_udf(T.StringType())
    def decompose(texts: pa.Array) -> pa.Array:
        whole = pc.utf8_normalize(texts, "NFKD").to_pylist()
        return pa.array([t and t.translate(marks) for t in whole], pa.string())

    return decompose(text)


def fold(name: str) -> Column:
    """Accent-free lower-case text. Only texts beyond ASCII are sent to the decomposition."""
    text = F.coalesce(F.col(name), F.lit(""))
    beyond = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return F.lower(F.coalesce(_folded(beyond), text))


def intent() -> Column:
    """First intent one of whose words occurs in column ``folded``."""
    text = F.col("folded")
    out = F
    for name, words in INTENTS.items():
        hit = text.contains(words[0])
        for word in words[1:]:
            hit = hit | text.contains(word)
        out = out.when(hit, name)
    return out.otherwise(NO_INTENT)


def label_intent(msgs: DataFrame) -> DataFrame:
    folded = msgs.select(CONV, "turn", fold("message").alias("folded"))
    return folded.select(CONV, "turn", intent().alias("intent"))


def _first_id(name: str, pattern: str, prefix: str) -> Column:
    whole = rf"(?iu)(?<!{_WORD}){pattern}(?!{_WORD})"
    digits = F.regexp_extract(F.coalesce(name, F.lit("")), whole, 1)
    return F.when(digits != "", F.concat(F.lit(prefix), digits))


def extract_ids(msgs: DataFrame) -> DataFrame:
    return msgs.select(
        CONV, "turn",
        _first_id("message", r"SKU[_-]?(\p{Nd}{3})", "SKU_").alias("sku_id"),
        _first_id("message", r"WH(\p{Nd}{2})", "WH").alias("warehouse_id"),
    )


def _drops() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The walk as a local function: it travels to the workers by value, whatever their path."""
    window_seconds, min_chars = TAIL_WINDOW_SECONDS, MIN_TAIL_CHARS

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Positions of tail duplicates in rows sorted by conversation, segment and turn.

        The state is the last kept message of the current segment, so memory does not grow.
        """
        group, kept_text, kept_at = None, "", None
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                key = (row.conversation_id, row.segment)
                at = None if pd.isna(row.sent_seconds) else row.sent_seconds
                late = (
                    at is not None and kept_at is not None and at - kept_at > window_seconds
                )
                duplicate = (
                    key == group
                    and not row.has_links
                    and len(row.text) >= min_chars
                    and len(kept_text) > len(row.text) + min_chars
                    and kept_text.endswith(row.text)
                    and not late
                )
                if duplicate:
                    found.append((row.conversation_id, row.turn))
                else:
                    group, kept_text, kept_at = key, row.text, at
            yield pd.DataFrame(found, columns=["conversation_id", "turn"])

    return walk


def prune_tail_duplicates(msgs: DataFrame) -> DataFrame:
    """Drop an assistant message that the last kept message, from the assistant too, ends with.

    A duplicate shares its last eight characters with the message it repeats, and every message
    dropped in between shares them as well. So a message whose tail differs from its direct
    predecessor's is certainly kept, and a conversation falls apart at these messages into
    segments that do not depend on each other. Only segments of two messages and more need the
    sequential rule. Predecessors are found per chunk of turns, with one small row carried from
    chunk to chunk, so that one long conversation does not end up in one task.
    """
    columns = msgs.columns
    links = F.col("links").isNotNull() if "links" in columns else F.lit(False)
    sent = F.col("sent_at").cast("double") if "sent_at" in columns else F.lit(None).cast("double")
    text = compact("message")
    mark = F.when(
        (F.col("sender") == "assistant") & (F.length("text") >= MIN_TAIL_CHARS),
        F.right("text", F.lit(MIN_TAIL_CHARS)),
    )
    keyed = (
        msgs.select(
            CONV, "turn", "sender", text.alias("text"), links.alias("has_links"),
            sent.alias("sent_seconds"),
        )
        .withColumns({"tail": mark, "chunk": F.floor(F.col("turn") / CHUNK_TURNS)})
    )
    marks = keyed.select(CONV, "turn", "chunk", F.struct("tail").alias("mark"))
    in_chunk = Window.partitionBy(CONV, "chunk").orderBy("turn")
    chunks_before = Window.partitionBy(CONV).orderBy("chunk")
    carried = (
        marks.groupBy(CONV, "chunk")
        .agg(F.max_by("mark", "turn").alias("last"))
        .select(CONV, "chunk", F.lag("last").over(chunks_before).alias("carried"))
    )
    linked = marks.withColumn("before", F.lag("mark").over(in_chunk)).join(
        carried, [CONV, "chunk"], "left"
    )
    before = F.coalesce("before", "carried")
    doubtful = F.coalesce(F.col("mark.tail") == before["tail"], F.lit(False))
    tested = linked.select(CONV, "turn", "chunk", doubtful.alias("doubtful"))
    head = F.when(~F.col("doubtful"), F.col("turn"))
    up_to_here = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = chunks_before.rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        tested.groupBy(CONV, "chunk")
        .agg(F.max(head).alias("head"))
        .select(CONV, "chunk", F.max("head").over(earlier).alias("earlier_head"))
    )
    segments = (
        tested.withColumn("head", F.max(head).over(up_to_here))
        .join(heads, [CONV, "chunk"], "left")
        .select(CONV, "turn", "doubtful", F.coalesce("head", "earlier_head").alias("segment"))
    )
    open_segments = segments.filter("doubtful").select(CONV, "segment").distinct()
    rows = (
        segments.join(open_segments, [CONV, "segment"], "left_semi")
        .join(keyed, [CONV, "turn"])
        .select(
            F.col(CONV).alias("conversation_id"), "segment", "turn", "text", "has_links",
            "sent_seconds",
        )
        .repartition(CONV, "segment")
        .sortWithinPartitions(CONV, "segment", "turn")
    )
    kinds = {f.name: f.dataType.simpleString() for f in msgs.schema}
    dropped = rows.mapInPandas(_drops(), f"conversation_id {kinds[CONV]}, turn {kinds['turn']}")
    return msgs.join(dropped, [CONV, "turn"], "left_anti").select(*columns)
