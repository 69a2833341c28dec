"""Spelling variants against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from erpweave.llm import spelling as sp

UPPER = {c: c + 32 for c in range(65, 91)}


def plain_vocabulary(rows, min_length=6, min_count=5, every=199) -> dict[str, int]:
    counts: Counter = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def one_edit(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def plain_variants(words: dict[str, int], ratio=5) -> dict[str, tuple]:
    """By the words that each word's single edits give."""
    letters = sorted({c for w in words for c in w})
    forms, out = {}, {}
    for w in words:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + k:] for i in range(len(w) + 1) for c in letters for k in (0, 1)}
        close = [v for v in edits - {w} if v in words and one_edit(v, w)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        fits = best is not None and words[best] >= ratio * words[w]
        forms[w] = (best if fits else None, len(close), words[best] if fits else None)
    for w, (form, n_near, form_n) in forms.items():
        root = w
        while forms[root][0] is not None:
            root = forms[root][0]
        out[w] = (form, root, words[w], n_near, form_n)
    return out


def as_dict(df) -> dict[str, tuple]:
    got = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: tuple(r)[1:] for r in got}


def test_near_is_one_edit():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("ab"), n)) for n in rng.integers(1, 6, 60)]
    for u in words:
        for v in words:
            assert sp.near(u, v) == (u != v and one_edit(u, v)), (u, v)
    asked = sorted({w for w in words})
    want = {(v, u) for u in asked for v in asked if u != v and one_edit(u, v)}
    assert set(sp.near_pairs(asked, asked)) == want  # many words: by deletions
    assert {p for u in asked for p in sp.near_pairs(asked, [u])} == want
    assert {p for u in asked for v in asked for p in sp.near_pairs([v], [u])} == want


def test_the_budget_reaches_every_near_word():
    dealt = {c: i % 3 for i, c in enumerate("abcdefgh")}

    def vector(word):
        return bytes(sum(dealt[c] == g for c in word) for g in range(3))

    for w in ("abcdef", "aabbcc", "hhhhhh"):
        ways = {b for b, _, _ in sp.reached(vector(w), 0, 3, 1, 1)}
        for i in range(len(w) + 1):
            for c in "abcdefgh":
                for k in (0, 1):
                    assert vector(w[:i] + c + w[i + k:]) in ways
            assert vector(w[:i] + w[i + 1:]) in ways


@pytest.mark.parametrize("limit", [3, 40, 100_000])
def test_cut_subtrees_and_leaves_lose_nothing(spark, limit):
    rng = np.random.default_rng(limit)
    # Rearranged letters share a leaf; the rest differ by edits, some with letters beyond ASCII.
    words = {"".join(rng.permutation(list("abcdef"))) for _ in range(120)}
    for w in list(words):
        at = int(rng.integers(0, 6))
        words |= {w[:at] + "é" + w[at:], w[:at] + "z" + w[at + 1:], w + w[at:], w[:at] + w[at] + w[at:]}
    counts = {w: int(n) for w, n in zip(sorted(words), rng.integers(5, 400, len(words)), strict=True)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best.word, -r.best.below) for r in sp.near_words(df, limit=limit).collect()}
    want = {}
    for w in counts:
        close = [v for v in counts if v != w and one_edit(v, w)]
        if close:
            best = min(close, key=lambda v: (-counts[v], v))
            want[w] = (len(close), best, counts[best])
    assert got == want


def test_query_equals_brute_force(spark, folder, texts):
    from erpweave.llm import queries

    want = plain_variants(plain_vocabulary(texts.items()))
    assert as_dict(queries.QUERIES["op12_spelling_variants"](spark, folder)) == want
    assert len(want) > 100


def test_more_of_the_table_with_lower_bounds(spark, folder, texts):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = plain_variants(plain_vocabulary(texts.items(), 5, 2, 7), 2)
    assert as_dict(sp.variants(docs, 5, 2, 7, 2, limit=200)) == want
    assert any(form for form, *_ in want.values()) and any(r != f for f, r, *_ in want.values() if f)


def test_edge_rows_and_an_empty_table(spark, edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert as_dict(sp.variants(edges, 3, 1, 5)) == plain_variants(plain_vocabulary(rows, 3, 1, 5))
    assert sp.variants(nothing).count() == 0
