"""Token ids by word against whole-text encoding, over all of Unicode."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from erpweave.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)


def _same(texts: list[str]) -> list[str]:
    tokenizer = Tokenizer.from_file(PATH)
    got = packing.WordIds(PATH).ids([t.encode() for t in texts])
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    return [t for t, a, b in zip(texts, got, want, strict=True) if a != b]


def test_capital_dotted_i_before_a_stop():
    assert _same(["TEŞEKKÜRLERİ.", "İ! aİ, İ", "sİ.,", "ΟΔΟΣ. ΟΔΟΣ"]) == []


def test_every_code_point_before_a_stop():
    points = [chr(c) for c in range(0x21, 0x110000) if not 0xD800 <= c < 0xE000]
    assert _same([f"ab{c}. {c}! {c}a" for c in points]) == []


def test_random_texts_over_all_categories():
    rng = np.random.default_rng(11)
    wide = [chr(c) for c in rng.integers(0x80, 0x110000, 400) if not 0xD800 <= c < 0xE000]
    alphabet = list("aİIıſKΩΣ\u0307\u0301\u0958ǅß.,!?#$ \n") + wide[:40]
    assert _same(["".join(rng.choice(alphabet, 30)) for _ in range(4000)]) == []
