"""Token counts of whole texts with a whole-token shortcut.

Byte-level BPE splits a text into pre-tokens and merges the bytes of each one on its own, so a pre-token's
count does not depend on its neighbours. ``prove`` runs the merges over every string of the vocabulary once, on
the driver: a string that ends as the single token it names counts 1 wherever it stands as a pre-token. Counting then
looks every pre-token up among the proven strings and merges only the others, whose counts a bounded cache holds.

The proven strings are the only thing sent to the workers; there are at most as many as vocabulary entries.
Pre-tokens are found with the tokenizer's pattern (its Latin classes written out where a text has no others). Where this Python and the tokenizer know different
versions of Unicode they can disagree on what a letter is: code points beyond Latin are probed when first seen, and a
text with one that is judged differently is counted by the tokenizer itself.

Added tokens inside a text count 1 each and are never merged with what is beside them, as the library does by
default. Texts are cut at blanks into spans of about ``SPAN`` code points, which no pre-token crosses, so a very long text needs
no more memory than a span's pre-tokens.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; repeated rows are counted each, ids are not looked
at; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import heapq
import json
import re
from dataclasses import dataclass
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.worker import Cache, focus

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
SPAN = 1_000_000
BEYOND = 0x250  # code points from here on are probed
HEAP_FROM = 256  # symbols of a pre-token from which on the next merge is taken from a heap


def byte_letters() -> dict[int, str]:
    """Letters that stand for bytes in the vocabulary: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@dataclass(frozen=True)
class Rules:
    """What counting needs of a tokenizer file: merge ranks over byte letters, vocabulary, added tokens."""

    ranks: dict[tuple[str, str], int]
    vocabulary: frozenset[str]
    added: tuple[str, ...]


@lru_cache(maxsize=2)
def rules(path: str) -> Rules:
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, before = data["model"], data["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not data["normalizer"] and before.get("type") == "ByteLevel"
    plain = plain and before["use_regex"] and not before["add_prefix_space"] and not model.get("ignore_merges")
    if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
        raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return Rules({p: i for i, p in enumerate(pairs)}, frozenset(model["vocab"]),
                 tuple(sorted((t["content"] for t in data["added_tokens"]), key=len, reverse=True)))


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols after all merges: always the best-ranked neighbours, the leftmost of equal ones."""
    if len(symbols) >= HEAP_FROM:
        return _merge_long(symbols, ranks)
    worst, rank = len(ranks), ranks.get
    found = [rank(pair, worst) for pair in zip(symbols, symbols[1:], strict=False)]
    while found:
        best = min(found)
        if best == worst:
            break
        at = found.index(best)
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        del found[at]
        if at < len(found):
            found[at] = rank((symbols[at], symbols[at + 1]), worst)
        if at:
            found[at - 1] = rank((symbols[at - 1], symbols[at]), worst)
    return symbols


def _merge_long(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """As ``merge``, over linked symbols and a heap of candidate pairs."""
    live: list[str | None] = list(symbols)
    after, before = list(range(1, len(live) + 1)), list(range(-1, len(live) - 1))
    heap: list[tuple[int, int, str, str]] = []

    def offer(left: int) -> None:
        if left >= 0 and after[left] < len(live):
            pair = (live[left], live[after[left]])
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], left, *pair))

    for i in range(len(live) - 1):
        offer(i)
    while heap:
        _, left, a, b = heapq.heappop(heap)
        right = after[left]
        if live[left] != a or right >= len(live) or live[right] != b:
            continue  # one of the two has been merged since
        live[left], live[right] = a + b, None
        after[left] = after[right]
        if after[left] < len(live):
            before[after[left]] = left
        offer(before[left])
        offer(left)
    return [s for s in live if s is not None]


def prove(path: str) -> frozenset[str]:
    """Texts of the vocabulary strings that their own bytes merge into, as one token."""
    known = rules(path)
    of_letter = {c: b for b, c in byte_letters().items()}
    proven = set()
    for token in known.vocabulary:
        if all(c in of_letter for c in token) and merge(list(token), known.ranks) == [token]:
            try:
                proven.add(bytes(of_letter[c] for c in token).decode())
            except UnicodeDecodeError:
                pass  # no whole code points: it can be a part of pre-tokens only
    return frozenset(proven)


def latin_pattern() -> re.Pattern:
    """The tokenizer's pattern for texts below ``BEYOND``, with classes written out (alternatives that start unlike may swap)."""
    def members(kind: str) -> str:
        found = regex.compile(kind)
        return re.escape("".join(chr(c) for c in range(BEYOND) if found.match(chr(c))))

    letter, digit, blank = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return re.compile(f" ?[{letter}]+| ?[{digit}]+|'(?:[stmd]|re|ve|ll)| ?[^{blank}{letter}{digit}]+"
                      f"|[{blank}]+(?![^{blank}])|[{blank}]+")


class Counts(Cache):
    """Tokens by pre-token: the proven ones always at hand, merged ones remembered within a bound."""

    def __init__(self, make, proven: dict[str, int], limit: int = 400_000):
        super().__init__(make, limit + len(proven))
        self.proven = proven
        self.update(proven)

    def clear(self) -> None:
        super().clear()
        self.update(self.proven)


class Counter:
    """Counts tokens of texts; lives as long as the Python worker."""

    def __init__(self, path: str, proven: frozenset[str]):
        self.path, self.proven = path, proven
        self.ranks, self.added = rules(path).ranks, rules(path).added
        self.letters = byte_letters()
        self.counts = Counts(self._merge, dict.fromkeys(proven, 1))
        self.latin, self.pre_tokens = latin_pattern(), regex.compile(public_tokenizers.PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.beyond = regex.compile(f"[^\\x00-{chr(BEYOND - 1)}]+")
        self.agreed = Cache(self._agrees)
        self.tokenizer = None

    def _merge(self, pre_token: str) -> int:
        return len(merge([self.letters[b] for b in pre_token.encode()], self.ranks))

    def _library(self):
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
        return self.tokenizer

    def _agrees(self, letter: str) -> bool:
        """Whether pattern and tokenizer split a code point alike from letters, digits, blanks and itself."""
        probe = f"a{letter}a1{letter}1 {letter}{letter} "
        cut = [b - a for _, (a, b) in self._library().pre_tokenizer.pre_tokenize_str(probe)]
        return cut == [len(p) for p in self.pre_tokens.findall(probe)]

    def _spans(self, text: str):
        """The text in parts, cut before a blank that follows something else: a pre-token starts there."""
        start = 0
        while len(text) - start > SPAN:
            cut = start + SPAN
            while cut < len(text) and (text[cut] != " " or text[cut - 1].isspace()):
                cut += 1
            yield text[start:cut]
            start = cut
        yield text[start:]

    def _ordinary(self, text: str, pre_tokens) -> int:
        count = self.counts.__getitem__
        return sum(sum(map(count, pre_tokens.findall(span))) for span in self._spans(text))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pre_tokens = self.latin
        if self.beyond.search(text):
            pre_tokens = self.pre_tokens
            if not all(self.agreed[c] for c in {c for part in self.beyond.findall(text) for c in part}):
                return len(self._library().encode(text, add_special_tokens=False).ids)
        parts = self.specials.split(text) if self.specials else [text]
        return len(parts) - 1 + sum(self._ordinary(p, pre_tokens) for p in parts)


_COUNTERS: dict[str, Counter] = {}


def n_tokens(text: Column, spark, tokenizer: str = TOKENIZER) -> Column:
    """Number of tokens of a text column, without begin, end or other added special tokens."""
    path = public_tokenizers.path(tokenizer)
    proven = spark.sparkContext.broadcast(prove(path))

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path, proven.value)
        counter = _COUNTERS[path]
        focus(counter.counts, counter.agreed)
        return pa.array([counter.count(t.as_py()) for t in texts], pa.int64())

    return counted(F.coalesce(text, F.lit("")))


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) for every row."""
    text = F.col("text")
    return docs.select(
        "doc_id", F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes"),
        n_tokens(text, docs.sparkSession, tokenizer).alias("n_tokens"),
    ).select("*", (F.col("n_tokens") > limit).alias("over_limit"))
