"""Collocations against plain counting."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from erpweave.llm import collocations as co

UPPER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, seen in counts.items():
        found = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        covered = {p[i:j] for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and a >= seen[p[i:j]]}
        scored = []
        for p, a in found.items():
            if p not in covered:
                score, _, left, right = min((1000 * a * totals[lang] // (seen[p[:k]] * seen[p[k:]]), k, seen[p[:k]], seen[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p), left, right))
        scored.sort(key=lambda s: (s[0], s[1], s[2].encode()))
        out += [(lang, i + 1, p, -a, left, right, totals[lang], -score) for i, (score, a, p, left, right) in enumerate(scored[:top])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def phrase_set(seed, n=300):
    rng = np.random.default_rng(seed)
    return {tuple(rng.choice(list("abcé"), int(k))): int(w) for k, w in zip(rng.integers(1, 6, n), rng.integers(1, 9, n), strict=True)}


def built(phrases):
    made = co.Transducer()
    for p in sorted(phrases):
        made.add(p, phrases[p])
    return made.close()


def test_transducers_hold_their_phrases_in_few_states():
    phrases = phrase_set(1)
    made = built(phrases)
    assert dict(made.phrases()) == phrases and [p for p, _ in made.phrases()] == sorted(phrases)
    assert dict(co.Transducer.unpacked(*made.packed()).phrases()) == phrases
    assert len(set(zip(made.weight, made.arcs, strict=True))) >= len(made.weight) - 1  # equal states are one
    assert dict(built({}).phrases()) == {}
    same = built({(x, y): 1 for x in "abcdef" for y in "xyz"})
    assert len(same.weight) == 3  # all ends are one state, and so are all beginnings


@pytest.mark.parametrize("least", [1, 8])
def test_union_sums_and_cuts(least):
    parts = [phrase_set(i, 120) for i in range(5)]
    total = Counter()
    for p in parts:
        total.update(p)
    united = co.union([built(p) for p in parts], least)
    assert dict(united.phrases()) == {p: n for p, n in total.items() if n >= least}


def test_composition_looks_up_parts():
    counts, asked = phrase_set(2), {p: 1 for p in phrase_set(3)}
    assert dict(co.compose(built(asked), built(counts))) == {p: n for p, n in counts.items() if p in asked}


def test_bit_table_knows_every_frequent_phrase(spark):
    rows = [("en", f"w{i % 40} x{i % 7} y") for i in range(400)]
    texts = spark.createDataFrame(rows, "lang string, text string").select("lang", "text").withColumn("text", co.F.col("text").cast("binary"))
    one = co.counted(texts, 1, 4, 5)
    kept = {p for r in one.collect() for p, _ in co.Transducer.unpacked(*[r[c] for c in ("words", "weight", "first", "label", "target")]).phrases()}
    table = co.bit_table(one.mapInArrow(co._word_buckets, "bucket bigint"))
    assert len(kept) == 48 and table(co.phrase_hashes("en", sorted(kept))).all()
    others = co.phrase_hashes("en", [(f"other{i}",) for i in range(1000)])
    assert table(others).mean() < 0.1


TEXTS = [
    ("en", "New York is big. New York, new york; NEW YORK\tis big! a b c d e f a b c d e f"), (None, "x y x y x y x y"), ("und", "x y z: x y z"),
    ("en", None), ("en", ""), ("fr", "é à é à é à é à"), ("fr", "no\u0001w no\u0001w no\u0001w, de de de de de de"), ("de", "."), (None, None),
]


@pytest.mark.parametrize("shard", [1, 10_000])
def test_small_texts(spark, monkeypatch, shard):
    monkeypatch.setattr(co, "MOST_BITS", 1 << 15 if shard > 1 else 1 << 27)
    monkeypatch.setattr(co, "SHARD_BYTES", shard)
    monkeypatch.setattr(co, "ASKERS", 1 if shard > 1 else 50_000)
    rows = TEXTS * 3
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    for least, top in ((2, 2000), (6, 3)):
        assert found(co.collocations(df, least, top)) == plain(rows, least, top)


def test_a_bit_table_that_lets_everything_through_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(co.BitTable, "__call__", lambda self, hashes: np.ones(len(hashes), bool))
    df = spark.createDataFrame(TEXTS * 3, "lang string, text string")
    assert found(co.collocations(df, 3)) == plain(TEXTS * 3, 3)


def test_whole_table_with_a_lower_bound(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    want = plain(rows, 6)
    assert len(want) > 500
    assert found(co.collocations(docs, 6)) == want


def test_edge_rows_and_an_empty_table(spark, edges, nothing):
    rows = [(r.lang, r.text) for r in edges.collect()]
    assert found(co.collocations(edges, 2)) == plain(rows, 2)
    assert co.collocations(nothing).count() == 0


def test_scores_beyond_64_bits(spark):
    product = 1000 * 10**13 * 10**12
    got = spark.sql(f"SELECT (CAST(1000 AS DECIMAL(4,0)) * CAST({10**13} AS DECIMAL(17,0)) * CAST({10**12} AS DECIMAL(17,0))) DIV "
                    f"(CAST({10**13 - 1} AS DECIMAL(19,0)) * CAST({10**13 - 3} AS DECIMAL(19,0))) AS score").first()[0]
    assert got == product // ((10**13 - 1) * (10**13 - 3))
