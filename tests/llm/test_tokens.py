"""BPE encoding, decoding and counting against the tokenizers library."""

import hashlib

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadstream.llm import bpe, token_counts
from roadstream.llm import vocabulary as v
from roadstream.llm.queries import VOCABULARY

ALPHABET = st.sampled_from(list("  \n\tabehinrst'sdmAZ09.,-_|<>é中😀\x1c\x85　́"))
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def tables():
    return v.read_tables(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def packed(ids):
    return np.array(ids, "<u4").tobytes()


PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def check(texts, tables, library):
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    found = bpe.encode_texts(texts, tables)
    assert found == [packed(i) for i in ids]
    assert token_counts.count_tokens(texts, tables) == [len(i) for i in ids]
    for own, code in zip(ids, found, strict=True):
        back = library.decode(own, skip_special_tokens=False)
        assert bpe.decode_ids(code, tables) == back


@settings(max_examples=200, deadline=None)
@given(parts=st.lists(st.one_of(st.text(ALPHABET, max_size=30), st.just(SPECIAL)), max_size=6))
def test_random_texts(parts, tables, library):
    check(["".join(parts)], tables, library)


def test_odd_texts(tables, library):
    check(
        ["", " ", "\n\n  x", "a" * 5000, " " * 700 + "x", "ab" * 40_000, "日本語" * 300, "don't I'll",
         f"{SPECIAL}{SPECIAL} a{SPECIAL}", "\x00\x01", "The theatre, theories; THE!!"],
        tables, library,
    )


def test_words_merge_alike(tables):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("etaoinsh rd"), rng.integers(1, 70))).encode() for _ in range(800)]
    exact = [v.merge_exact(w, tables) for w in words]
    assert v.merge_all(words, tables) == exact
    assert bpe.encode_words(words, tables) == exact
    assert any(bpe.propose(w, tables) != e for w, e in zip(words, exact, strict=True))


def test_words_are_cut_together(tables, monkeypatch):
    """Greedy cuts of many words take few cuts of single ones, and are the same."""
    rng = np.random.default_rng(3)
    cut = ["".join(rng.choice(list("etaoinsh rd.é日"), rng.integers(1, 40))).encode() for _ in range(900)]
    words = [*cut, b"", b"a" * 3000, b"ab" * 2000, b"\xff\x00", " 日本語".encode() * 300, b" the", b""]
    single = bpe.propose
    expected = [single(w, tables) for w in words]
    calls = []
    monkeypatch.setattr(bpe, "propose", lambda w, t: calls.append(w) or single(w, t))
    for own, exact in ((words, expected), (words[:5], expected[:5]), ([], []), ([b""], [[]])):
        flat, owner = bpe.propose_all(own, tables)
        assert [flat[owner == i].tolist() for i in range(len(own))] == exact
        assert len(calls) <= bpe.FEW
        calls.clear()
    bpe.encode_words(cut, tables)
    assert len(calls) <= bpe.FEW


def test_pieces_of_every_character():
    """The pattern cuts as the one of the library, beside each character of Unicode."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(every), 5000):
        text = "".join(f"{c}a{c}1 {c}{c}é.{c}" for c in every[i : i + 5000])
        assert v.PIECES.findall(text) == PRE_TOKEN.findall(text)


@settings(max_examples=500, deadline=None)
@given(text=st.text(st.one_of(ALPHABET, st.sampled_from(list("'tvl²½٣𝟘𐐀ªɐ\u200b\u2028")), st.characters(codec="utf-8"))))
def test_pieces_of_random_texts(text):
    assert v.PIECES.findall(text) == PRE_TOKEN.findall(text)


def test_compatible_pairs(tables):
    rng = np.random.default_rng(2)
    alone = np.flatnonzero(tables["alone"])
    a, b = rng.choice(alone, 4000), rng.choice(alone[:2000], 4000)
    a[:50], b[:50] = b[:50], b[:50]  # equal neighbours, where ranks tie
    token = tables["token_bytes"]
    exact = [v.merge_exact(token[x] + token[y], tables) == [x, y] for x, y in zip(a, b, strict=True)]
    assert bpe.compatible(a, b, tables).tolist() == exact


def test_whole_tokens(tables):
    whole = token_counts.whole_tokens(tables)
    assert b" the" in whole
    assert all(len(v.merge_exact(t, tables)) == 1 for t in list(whole)[:500])


def test_token_that_merging_never_gives():
    """In "abc" the earlier merge of a and b leaves no bc for the merge to "abc"."""
    names = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc"]
    merges = [(b"a", b"b"), (b"b", b"c"), (b"a", b"bc")]
    tables = v.merge_tables({t: i for i, t in enumerate(names)}, merges, names, {})
    assert b"abc" not in token_counts.whole_tokens(tables)
    words = [b"abc", b"ab", b"bc", b"cabcb"]
    exact = [[256, 99], [256], [257], [99, 256, 99, 98]]
    assert [v.merge_exact(w, tables) for w in words] == exact
    assert bpe.encode_words(words, tables) == exact and bpe.propose(b"abc", tables) == [258]
    assert token_counts.count_tokens(["abc", "bc"], tables) == [2, 1]


def test_other_kinds_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        v.read_tables(public_tokenizers.path("word_bpe_49k.json"))


def test_rows(spark, library):
    texts = [None, "", "one two", "one two", "x" * 300_000, f"a {SPECIAL} b"]
    rows = [(i, t, "kept") for i, t in enumerate(texts)] + [(2, "one two", "kept"), (None, "q", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = bpe.round_trip(docs, VOCABULARY).collect()
    counts = token_counts.count(docs, VOCABULARY, output="ids").collect()
    assert len(found) == len(counts) == len(rows)
    by_text = {t: packed(library.encode(t or "", add_special_tokens=False).ids) for t in texts + ["q"]}
    for row, n in zip(found, counts, strict=True):
        assert bytes(row.ids) == by_text[row.text] and row.decoded == (row.text or "")
        assert n.ids == len(by_text[n.text]) // 4
    for row in bpe.round_trip(docs, VOCABULARY, packed=False).collect():
        assert packed(row.ids) == by_text[row.text] and row.decoded == (row.text or "")
    again = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY, text="text2")
    assert all(r.text2 == (r.text or "") for r in again.collect())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(docs, VOCABULARY).count() == 0
    assert bpe.round_trip(docs, VOCABULARY, packed=False).collect() == []
    assert token_counts.count(docs, VOCABULARY).count() == 0


def test_queries(spark, library):
    from conftest import DATA
    from roadstream.llm.queries import QUERIES

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for row in QUERIES["op1_bpe"](spark, DATA).collect():
        ids = library.encode(docs[row.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    for row in QUERIES["op10_token_counts"](spark, DATA).collect():
        n = len(library.encode(docs[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens) == (len(docs[row.doc_id].encode()), n)
        assert row.over_limit == (n > 1024)
