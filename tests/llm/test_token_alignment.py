from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stocklens.llm import token_alignment as ta
from stocklens.llm.common import table
from tests.llm.rows import EDGE, LONG, edge_docs, no_docs

SMALL = "/root/testdata/sf0.001"
FILE_A, FILE_B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(FILE_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILE_B)


def letters():
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    spare = iter(range(256, 512))
    return {(chr(b) if b in shown else chr(next(spare))): b for b in range(256)}


LETTERS = letters()


def aligned(plain, text):
    """Groups of (A ids, B ids), token by token; none where the bytes differ."""
    if not text:
        return [], []
    a, b = plain[0].encode(" " + text, add_special_tokens=False).ids, plain[1].encode(text)
    raw_a = [bytes(LETTERS[c] for c in plain[0].id_to_token(i)) for i in a]
    raw_b = []
    for i in b:
        piece = plain[1].id_to_piece(i)
        raw_b.append(bytes([int(piece[3:5], 16)]) if plain[1].is_byte(i) else piece.replace("▁", " ").encode())
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return [], []
    groups, links, i, j, at_a, at_b = [], [], 0, 0, 0, 0
    own_a, own_b = [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            own_a.append(a[i])
            at_a += len(raw_a[i])
            i += 1
        else:
            own_b.append(b[j])
            at_b += len(raw_b[j])
            j += 1
        if at_a == at_b:
            groups.append((own_a, own_b))
            links.append((own_a[-1], own_b[-1]))
            own_a, own_b = [], []
    return groups, links


def brute(plain, docs):
    found = [(key, *aligned(plain, text)) for key, text in docs]
    counts = Counter(link for _, _, links in found for link in links)
    most: dict[int, int] = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    rows = []
    for key, groups, links in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append(
            (key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
             sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(text.encode()).hexdigest() if groups else "", text)
        )
    return rows, counts, most


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")


def compare(plain, docs, rows, **options):
    got = ta.align(docs, FILE_A, FILE_B, keep_groups=True, **options)
    want, counts, most = brute(plain, rows)
    assert sorted(repr(tuple(r)) for r in got.documents.select(*COLUMNS).collect()) == sorted(map(repr, want))
    pairs = {(r.a_id, r.b_id): (r.n_links, r.best) for r in got.pairs.collect()}
    assert pairs == {p: (n, n == most[p[1]]) for p, n in counts.items()}


def test_whole_table_against_plain_python(spark, plain):
    docs = table(spark, SMALL, "documents")
    compare(plain, docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_many_small_runs_and_merges(spark, plain, monkeypatch):
    """Runs of a few texts, merged two at a time in several rounds."""
    monkeypatch.setattr(ta, "PART_CHARS", 3000)
    source = table(spark, SMALL, "documents")
    docs = source.where("length(text) < 3000").limit(60).coalesce(1)
    rows = [(r.doc_id, r.text) for r in docs.collect()] * 2
    again = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    got = ta.align(again, FILE_A, FILE_B, fan_in=2, keep_groups=True)
    assert got.count >= 8
    want, counts, most = brute(plain, rows)
    assert sorted(repr(tuple(r)) for r in got.documents.select(*COLUMNS).collect()) == sorted(map(repr, want))
    assert {(r.a_id, r.b_id): r.n_links for r in got.pairs.collect()} == counts


ODD = [
    (50, "one ▁ two"), (51, "<s> </s> <unk> <0x41> <|endoftext|> x"), (52, "  lead and  trail  "), (53, "\x00 null\x01"),
    (54, "日本語 テキスト 한국어 😀👍🏽 naïve Ünïcødé"), (55, "a" * 3000), (56, "\n\n\t x\r\n"), (57, " "), (58, "don't we'll 12345 !!!???"),
    (59, "é ﬁ Ω"),
]


def test_edge_rows(spark, plain):
    docs = edge_docs(spark)
    more = spark.createDataFrame([(*r, *([None] * 18)) for r in ODD], docs.schema)
    compare(plain, docs.unionAll(more), [r[:2] for r in EDGE] + ODD)


def test_empty_table(spark):
    got = ta.align(no_docs(spark), FILE_A, FILE_B)
    assert got.documents.count() == 0 and got.pairs.count() == 0
    none = ta.align(edge_docs(spark).where("coalesce(text, '') = ''"), FILE_A, FILE_B).documents.collect()
    assert len(none) == 3 and {(r.n_a, r.n_b, r.n_links, r.count_sum, r.groups_sha256) for r in none} == {(0, 0, 0, 0, "")}


def test_parts_of_long_texts(plain, monkeypatch):
    """A long text in parts has the tokens and links of the whole."""
    with open(FILE_A) as a, open(FILE_B, "rb") as b:
        codec = ta.Codec(a.read(), b.read())
    assert codec.cuttable
    text = LONG[:30_000] + "  two  blanks. Don't x y z. \x1c 　 a \u2028 b" + "é " * 300 + "word " * 200
    plain_row = brute(plain, [(1, text)])[0][0]

    def run_of(parts):
        run = ta.Run(codec, "a", True)
        run.add([codec.learned(u)[x] for x in u] for u in map(codec.units, parts))
        return run

    whole = run_of([text])
    assert whole.rows == [(*plain_row[1:5], *plain_row[7:])]
    codec.cuttable = False
    assert run_of([text]).rows == whole.rows
    codec.cuttable = True
    for size in (1, 40, 3000):
        monkeypatch.setattr(ta, "PART_CHARS", size)
        parts = list(codec.parts(text))
        assert len(parts) > 8 and " ".join(parts) == text
        run = run_of(parts)
        assert run.rows == whole.rows
        assert run.codes[0].tolist() == whole.codes[0].tolist() and (run.shares[0] == whole.shares[0]).all()


def test_units_forgotten_and_remembered(plain, monkeypatch):
    """Whatever is remembered, units have the same tokens; those that do not give back their bytes have none."""
    with open(FILE_A) as a, open(FILE_B, "rb") as b:
        codec = ta.Codec(a.read(), b.read())
    monkeypatch.setattr(ta, "MEMORY", 20)
    monkeypatch.setattr(ta, "LONGEST_UNIT", 9)
    words = [f"w{i % 37}" for i in range(300)] + ["a▁b", "verylongword" * 9, "é"]
    for i in range(0, len(words), 11):
        some = words[i : i + 11]
        own = codec.learned(some)
        for w in some:
            groups, _ = aligned(plain, w)
            assert (own[w] is None) == (not groups)
            if groups:
                assert own[w][2] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    assert len(codec.known) <= 40


def test_streams_are_merged_in_order():
    import numpy as np

    rng = np.random.default_rng(1)
    want: Counter = Counter()
    streams = []
    for _ in range(7):
        codes = np.unique(rng.integers(0, 60_000, 20_000))
        values = np.empty(len(codes), ta.PAIR)
        values["code"], values["n"] = codes, rng.integers(1, 9, len(codes))
        want.update(dict(values.tolist()))
        streams.append(ta.packed(values))
    got = ta.unpacked_stream(ta.merged([*streams, ta.packed(np.empty(0, ta.PAIR))])).tolist()
    assert got == sorted(want.items())
