"""Token counts against whole-text encoding by the library."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from erpweave.llm import token_counts as tc

PATH = public_tokenizers.path(tc.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(PATH, tc.prove(PATH))


def test_proof_holds_for_every_proven_string(library):
    proven = sorted(tc.prove(PATH))
    assert len(proven) > 49_000
    vocabulary = library.get_vocab()
    letters = tc.byte_letters()
    for text in proven:
        assert [vocabulary["".join(letters[b] for b in text.encode())]] == [
            library.token_to_id(t) for t in tc.merge([letters[b] for b in text.encode()], tc.rules(PATH).ranks)]


TRICKY = [
    "", " ", "  ", "\n\n a", "a  b\t\tc \n", "don't we'LL I've 'S it's", "x" * 300, "ab" * 5000, "é" * 200 + " ü", " a b　 c",
    "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|> c", "<|endoftext|", "a <|endoftext|> ", "١٢٣ ½ Ⅷ 五", "日本語 テスト 한국어",
    "👩‍👩‍👧 😀😀", "é ́a", "a\x00b\x1c\x1d\x85 c", "࢏ ꟎꟒x1₝", "$$$ --- ... ,,a", " ​ ﻿",
]


def test_counts_equal_the_library_on_tricky_texts(counter, library):
    rng = np.random.default_rng(3)
    alphabet = list("aB 1'\n\t.s<|>é日́ 😀࢏")
    noise = ["".join(rng.choice(alphabet, 40)) for _ in range(1500)]
    wide = ["".join(chr(c) for c in rng.integers(1, 0x1FFFF, 30) if not 0xD800 <= c < 0xE000) for _ in range(400)]
    for text in [*TRICKY, *noise, *wide]:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_latin_classes_are_the_tokenizers(counter, library):
    for c in map(chr, range(tc.BEYOND)):
        probe = f"a{c}a1{c}1 {c}{c} "
        assert [len(p) for p in counter.latin.findall(probe)] == [
            b - a for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(probe)], hex(ord(c))


def test_cache_keeps_the_proven_strings():
    counts = tc.Counts(len, {"the": 1}, limit=2)
    assert [counts[w] for w in ("ab", "abc", "abcd", "abcde", "the")] == [2, 3, 4, 5, 1] and len(counts) <= 3


def test_long_texts_are_cut_where_pre_tokens_start(counter, library, monkeypatch):
    monkeypatch.setattr(tc, "SPAN", 7)
    rng = np.random.default_rng(4)
    for text in ["".join(rng.choice(list("ab 1.\n "), 200)) for _ in range(200)]:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_query_equals_the_library(spark, folder, library, texts):
    from erpweave.llm import queries

    got = {r.doc_id: r for r in queries.QUERIES["op11_whole_token_counts"](spark, folder).collect()}
    assert set(got) == set(texts)
    for key, text in texts.items():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[key].n_bytes, got[key].n_tokens, got[key].over_limit) == (len((text or "").encode()), n, n > 512)


def test_edge_rows_and_an_empty_table(spark, edges, nothing, library):
    got = sorted((tuple(r) for r in tc.token_counts(edges).collect()), key=repr)
    want = []
    for r in edges.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
    assert got == sorted(want, key=repr)
    assert tc.token_counts(nothing).count() == 0
    assert [f.simpleString() for f in tc.token_counts(nothing).schema] == [
        "doc_id:bigint", "n_bytes:bigint", "n_tokens:bigint", "over_limit:boolean"]
