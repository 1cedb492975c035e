from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stocklens.operators import conversations as talk
from tests.small import rows

LOG = "conversation_id long, turn long, sender string, message string"
TIMED = LOG + ", sent_at double, links string"


def log(spark, *messages):
    return spark.createDataFrame([(1, i, s, m) for i, (s, m) in enumerate(messages)], LOG)


def kept_of(messages):
    """The rule as a walk over one conversation: sender, text, time, links."""
    kept = []
    for sender, text, at, links in messages:
        body = " ".join(text.split())
        if kept:
            last_sender, last_body, last_at = kept[-1][:3]
            late = at is not None and last_at is not None and at - last_at > 4
            if (
                sender == last_sender == "assistant" and not links and len(body) >= 8
                and len(last_body) > len(body) + 8 and last_body.endswith(body) and not late
            ):
                continue
        kept.append((sender, body, at, links))
    return kept


LONG = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
text = st.sampled_from([LONG, LONG[10:], LONG[16:], LONG[18:], LONG[20:], "0" * 30 + LONG, "other words"])
message = st.tuples(
    st.sampled_from(["assistant", "assistant", "assistant", "user"]), text,
    st.one_of(st.none(), st.integers(0, 12).map(float)),
    st.sampled_from([None, None, None, "[1]"]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(message, min_size=1, max_size=14), min_size=1, max_size=3))
def test_pruning_equals_a_walk(spark, monkeypatch, conversations):
    monkeypatch.setattr(talk, "CHUNK_TURNS", 3)  # chunk borders inside a conversation
    data = [(c, i, *m) for c, messages in enumerate(conversations) for i, m in enumerate(messages)]
    out = talk.prune_tail_duplicates(spark.createDataFrame(data, TIMED))
    assert out.columns == [f.split()[0] for f in TIMED.split(", ")]
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.conversation_id, r.turn)):
        body = " ".join(r.message.split())
        got.setdefault(r.conversation_id, []).append((r.sender, body, r.sent_at, r.links))
    assert got == {c: kept_of(messages) for c, messages in enumerate(conversations)}


def test_a_drop_follows_a_drop(spark):
    out = talk.prune_tail_duplicates(log(
        spark, ("assistant", LONG), ("assistant", LONG[17:]), ("assistant", LONG[10:]),
        ("assistant", LONG[:8]), ("user", LONG[16:]), ("assistant", LONG[16:])))
    assert sorted(r.turn for r in out.collect()) == [0, 3, 4, 5]


@pytest.mark.parametrize("words, wanted", [
    ("Tổng quan kho", "overview"), ("LOW STOCK at wh03 for sku-012", "low_stock"),
    ("hello", "help"), ("a report", "replenishment"), ("reorder and overstock", "low_stock"),
    ("Tồn quá mức", "overstock"), ("theo kho nào", "warehouse"), ("nhập xuất", "movement"),
    ("đơn mua", "help"), ("mua hàng", "replenishment"), ("ｏｖｅｒｖｉｅｗ", "overview"), (None, "help"),
])
def test_intent(spark, words, wanted):
    assert rows(talk.label_intent(log(spark, ("user", words))))[0]["intent"] == wanted


@pytest.mark.parametrize("words, sku, site", [
    ("low stock at wh03 for sku-012", "SKU_012", "WH03"), ("SKU_1234 WH1", None, None),
    ("xsku001 WH02x", None, None), ("sku007, then SKU_008; WH01 WH02", "SKU_007", "WH01"),
    (None, None, None),
])
def test_ids(spark, words, sku, site):
    out = rows(talk.extract_ids(log(spark, ("user", words))))[0]
    assert (out["sku_id"], out["warehouse_id"]) == (sku, site)


def test_snippet(spark):
    texts = ["  a \n\t b  ", "x" * 88, "y" * 89, " \n ", None, "one two"]
    out = rows(talk.snippets(log(spark, *[("user", t) for t in texts])))
    assert [r["snippet"] for r in sorted(out, key=lambda r: r["turn"])] == [
        "a b", "x" * 88, "y" * 87 + "...", "New chat", "New chat", "one two",
    ]


def test_tail_drops_blanks_after_the_cut(spark):
    df = log(spark, ("user", "one"), ("Bot", " two "), ("user", "  "), ("system", "x"), ("user", "z"))
    got = sorted((r["turn"], r["role"], r["content"]) for r in rows(talk.context_tail(df, 4)))
    assert got == [(1, "assistant", "two"), (4, "user", "z")]
    assert len(rows(talk.context_tail(df, 1))) == 1


def test_pages(spark):
    df = log(spark, *[("user", str(i)) for i in range(5)])
    for page, texts, more in ((1, "01", True), (2, "23", True), (3, "4", False), (4, "", False)):
        out = rows(talk.history_page(df, page, 2))
        assert "".join(r["message"] for r in out) == texts
        assert all(r["has_more"] == more for r in out)
        assert all(r["next_offset"] == (page * 2 if more else None) for r in out)
    assert len(rows(talk.history_page(df, 1, 5))) == 5
    assert not rows(talk.history_page(df, 1, 5))[0]["has_more"]


def test_conversation_list(spark):
    data = [(1, 0, "u", "first"), (1, 1, "u", "next"), (2, 0, "u", None), (3, 5, "u", "c"), (3, 4, "u", "b")]
    out = rows(talk.list_conversations(spark.createDataFrame(data, LOG)))
    assert [(r["conversation_id"], r["first_message"]) for r in out] == [(3, "b"), (1, "first"), (2, "")]
    page = rows(talk.list_conversations(spark.createDataFrame(data, LOG), limit=1, offset=1))
    assert [r["conversation_id"] for r in page] == [1]


def test_equal_positions_do_not_double_a_conversation(spark):
    given_rows = [("c1", 0, "user", "b"), ("c1", 0, "user", "a"), ("c2", 5, "user", "x"), ("c3", 1, "user", None)]
    msgs = spark.createDataFrame(given_rows, "conversation_id string, turn int, sender string, message string")
    got = [tuple(r) for r in talk.list_conversations(msgs, limit=2).collect()]
    assert got == [("c2", 5, "x"), ("c3", 1, "")]
    assert talk.list_conversations(msgs).count() == 3


def test_folding_is_whole(spark):
    texts = ["\U0001d428\U0001d42f\U0001d41e\U0001d42b\U0001d42f\U0001d422\U0001d41e\U0001d430", "Tổng quan", "ﬁlter overﬂow", None, "plain"]
    msgs = spark.createDataFrame([(t,) for t in texts], "message string")
    assert [r[0] for r in msgs.select(talk.fold("message")).collect()] == [
        "overview", "tong quan", "filter overflow", "", "plain",
    ]


def test_tail_trims_the_separators_and_keeps_the_mark(spark):
    given_rows = [("c", 0, "user", "\x1c\x85 a \x1f"), ("c", 1, "user", "\ufeffb\ufeff"), ("c", 2, "user", "\x1d \x85")]
    msgs = spark.createDataFrame(given_rows, "conversation_id string, turn int, sender string, message string")
    got = [r.content for r in talk.context_tail(msgs).orderBy("turn").collect()]
    assert got == ["a", "\ufeffb\ufeff"]
