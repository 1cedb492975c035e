from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stocklens.llm import bpe
from stocklens.llm.common import table
from tests.llm.rows import EDGE, edge_docs, no_docs

SMALL = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("word_bpe_49k.json")
LETTERS = [
    "abcdefghij", "etaoin ", "éà ộx", "'strelvmd ", "!?.,'-<|>", "0123456789", "한국어각中文字", "ß ΣςÀÉ İı",
    "\x1c\x1d\x85 　\n\t ab", "😀👍🏽‍❤️", "Αᾴ", "क़़ड़ क",
]
PIECES = ["<|endoftext|>", "<|startoftext|>", "hello", "'s", "'ll", "don't", "12345", "   ", "\n", "the,!"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def codec():
    with open(FILE, encoding="utf-8") as file:
        return bpe.Codec(file.read())


def random_text(rnd: random.Random) -> str:
    letters = rnd.choice(LETTERS) if rnd.random() < 0.6 else "".join(LETTERS)
    out, size = "", rnd.choice([5, 50, 400, 1500])
    while len(out) < size:
        out += rnd.choice(PIECES) * rnd.choice([1, 9]) if rnd.random() < 0.06 else "".join(rnd.choices(letters, k=rnd.choice([3, 30])))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_words_and_tree_against_the_library(plain, codec, seed):
    rnd = random.Random(seed)
    for _ in range(120):
        text = random_text(rnd)
        want = plain.encode(text, add_special_tokens=False).ids
        ids, decoded = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == plain.decode(want, skip_special_tokens=False)
        parts = 2 ** rnd.choice([1, 2, 3])
        cuts = [len(text) * i // parts for i in range(parts + 1)]
        leaves = [(text[a:b], *codec.place(text[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]
        assert codec.join_leaves(leaves).tolist() == want


def test_joins_use_windows(codec, monkeypatch):
    """Long text without any blank is joined at its seams, not encoded again."""
    text = "abcdefghijklmnopqrstuvwxyz" * 400
    leaves = [(x, *codec.place(x)) for x in (text[:5003], text[5003:])]
    sizes = []
    place = codec.place
    monkeypatch.setattr(codec, "place", lambda t: sizes.append(len(t)) or place(t))
    joined = codec.join_leaves(leaves)
    assert joined.tolist() == place(text)[0].tolist()
    assert sizes and max(sizes) < 2000


def wanted(plain, text):
    ids = plain.encode(text or "", add_special_tokens=False).ids
    digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    decoded = plain.decode(ids, skip_special_tokens=False)
    return len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded


@pytest.mark.parametrize("leaf_chars", [200, bpe.LEAF_CHARS])
def test_query_against_the_library(spark, plain, leaf_chars):
    docs = table(spark, SMALL, "documents")
    rows = {r.doc_id: r for r in bpe.encode(docs, FILE, leaf_chars=leaf_chars).collect()}
    assert len(rows) == docs.count()
    for d in docs.collect():
        r, want = rows[d.doc_id], wanted(plain, d.text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.token_ids)) == want[:4]


def test_edge_rows_and_round_trip(spark, plain):
    encoded = bpe.encode(edge_docs(spark), FILE, leaf_chars=1000)
    rows = encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    want = [(i, *wanted(plain, t)[:3]) for i, t, *_ in EDGE]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    texts = sorted(r.text for r in bpe.decode(encoded, FILE).collect())
    assert texts == sorted(wanted(plain, t)[4] for _, t, *_ in EDGE)
    assert bpe.encode(no_docs(spark), FILE).count() == 0


def test_latin_words_told_apart_in_one_text(plain, codec):
    """Every Latin letter, alone and in words, has the tokens it has by itself; also those that are long."""
    letters = [chr(c) for c in range(0x41, 0x250) if bpe.LATIN.fullmatch(chr(c))]
    words = [*letters, *map("".join, zip(letters, letters[7:], letters[3:])), "a" * 500, "ÀÉ" * 90, "İx", "don't", "x1y"]
    assert codec.word_end is not None and "İ" not in letters
    for word, ids in codec._encoded(words):
        assert list(ids) == plain.encode(word, add_special_tokens=False).ids, word
    texts = ["".join(words[i : i + 3]) + " " + " ".join(words[i : i + 9]) for i in range(0, len(words), 9)]
    for text, (ids, _) in zip(texts, codec.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_remembered_words_are_ids_only(plain, codec):
    texts = ["Some words, some more; don't!", "x" * 70 + " again again", "", " \n ", "caf\u00e9 \u4f60\u597d 12"]
    for text, (ids, decoded) in zip(texts, codec.encode_all(texts), strict=True):
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == plain.decode(want, skip_special_tokens=False)
    held = [*codec.words.values(), *codec.pieces.values()]
    assert held and all(type(x) is bytes for x in held)
