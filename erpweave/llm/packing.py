"""Best-fit packing of token sequences with swap-based local search.

``pieces`` turns whole documents into token pieces of at most ``capacity``: only longer documents are
cut, into full pieces and a rest. ``pack`` puts pieces into as few sequences as it can.

Packing works on shards of about ``SHARD`` pieces, dealt by hash. Further rounds deal all underfull
sequences anew, whole, and go on with the search over them (or start again, where that needs fewer), until one
shard holds them all or a round saves no sequence. Inside a shard best-fit decreasing makes the start;
then every underfull bin, from the emptiest on, gives its pieces to any fuller one, by a move into a gap, by
exchange for one smaller piece or for two that are smaller together, until no step is left. Every step moves
tokens from an emptier to a fuller bin, so the sum of squared fills grows and the search ends; a bin that has
nothing left is gone.

Token ids are looked up per word between ASCII blanks, which no token of this tokenizer family
spans, so the pieces equal those of encoding the whole text; texts with special-token strings are encoded
whole. The tokenizer file is a parameter and is opened by every worker.

Defined results: NULL and blank texts are one piece holding the end id; repeated rows are packed each;
an empty table gives no rows. ``sequence_id`` is any number, offsets inside a sequence have no gaps.
"""

from __future__ import annotations

import bisect
import math
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erpweave.llm.worker import Cache, focus, release
from erpweave.session import materialize

CAPACITY = 4096
END_ID = 1
SHARD = 20_000
STOPS = b".,;:!?#$%&*|"
TOKENIZER = "word_bpe_49k.json"


def ends_in_letter(text: str) -> bool:
    """Whether a text still ends in a letter once it is composed and lower-cased, as the tokenizer reads it.

    Some letters end in a combining mark then (a capital I with a dot does), and a mark joins the stops behind it.
    """
    last = text[-1]
    if last.isascii():
        return last.isalpha()
    return unicodedata.normalize("NFC", text).lower()[-1].isalpha()


class WordIds:
    """Token ids of words, as little-endian unsigned 32-bit bytes.

    Two generations of words are kept, so memory is bounded and frequent words stay. Words of letters only
    are new tokens' bulk: they are encoded many at a time, and the ids cut at the tokens that end a word.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _take(self, words: list[bytes]) -> None:
        """Encode words of letters together."""
        ids = self._encode(" ".join(w.decode() for w in words))
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(words):
            data = ids.tobytes()
            bounds = [0, *(4 * cuts).tolist()]
            self.words.update((w, data[a:b]) for w, a, b in zip(words, bounds, bounds[1:], strict=False))
        else:  # some word falls into parts
            self.words.update((w, self._encode(w.decode()).tobytes()) for w in words)

    def learn(self, words: set[bytes]) -> None:
        """Make the ids of all ``words`` known."""
        if len(self.words) > self.limit:
            self.words, self.older = {}, self.words
        letters, joined = set(), []
        for word in words.difference(self.words):
            if word in self.older:
                self.words[word] = self.older[word]
                continue
            stem = word.rstrip(STOPS)
            text = stem.decode()
            if len(stem) < len(word) and text and ends_in_letter(text):
                joined.append((word, stem, word[len(stem):]))  # stops behind a letter are tokens of their own
                word, parts = stem, (stem, word[len(stem):])
            else:
                text, parts = word.decode(), (word,)
            for part in parts:
                if part in self.words:
                    continue
                if part in self.older:
                    self.words[part] = self.older[part]
                elif part is word and text.isalpha():
                    letters.add(part)
                else:
                    self.words[part] = self._encode(part.decode()).tobytes()
        ordered = list(letters)
        for at in range(0, len(ordered), 1000):
            self._take(ordered[at:at + 1000])
        for word, stem, tail in joined:
            self.words[word] = self.words[stem] + self.words[tail]

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        split = [t.lower().split() if t and b"<|" not in t else [] for t in texts]
        found = [list(map(self.words.get, words)) for words in split]
        missed = [i for i, ids in enumerate(found) if None in ids]
        if missed:
            self.learn({w for i in missed for w, ids in zip(split[i], found[i], strict=True) if ids is None})
            for i in missed:
                found[i] = [self.words[w] if ids is None else ids for w, ids in zip(split[i], found[i], strict=True)]
        return [self._encode(t.decode()).tobytes() if t and b"<|" in t else b"".join(ids)
                for t, ids in zip(texts, found, strict=True)]


_WORD_IDS = Cache(WordIds, 2)  # by tokenizer file


def _encoded(encoder: WordIds, texts: pa.Array):
    """Ids of every text, for a few megabytes of text at a time."""
    held: list[bytes | None] = []
    size = 0
    for value in texts:
        held.append(value.as_py())
        size += len(held[-1] or b"")
        if size > 4_000_000:
            yield from encoder.ids(held)
            held, size = [], 0
    yield from encoder.ids(held)


def _cut(path: str, capacity: int, end_id: int, with_ids: bool, id_type: pa.DataType):
    end, size = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches):
        focus(_WORD_IDS)
        encoder = _WORD_IDS[path]
        for batch in batches:
            doc_ids, pieces, starts, lengths, sums, bodies, rows = [], [], [], [], [], [], []
            keys = batch.column("doc_id")
            for row, ids in enumerate(_encoded(encoder, batch.column("text"))):
                data = ids + end
                for piece, at in enumerate(range(0, len(data), size)):
                    body = data[at:at + size]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    lengths.append(len(body) // 4)
                    sums.append(zlib.crc32(body))
                    if with_ids:
                        bodies.append(np.frombuffer(body, "<u4").astype(np.int32))
            doc_ids = keys.take(pa.array(rows, pa.int64())).cast(id_type)
            columns = [doc_ids, pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                       pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(bodies, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        release()

    return run


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and the ids themselves, for every piece of every row."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    run = _cut(public_tokenizers.path(tokenizer), capacity, end_id, with_ids, to_arrow_type(kind))
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, T.StructType(fields))


class Bins:
    """Bins of one shard: their items (numbers of pieces) and fills.

    ``start`` names the bin of every piece; without it best-fit decreasing makes the bins.
    """

    def __init__(self, lengths: np.ndarray, capacity: int, start: np.ndarray | None = None):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        if start is None:
            self._best_fit_decreasing()
        else:
            _, number = np.unique(start, return_inverse=True)
            self.items = [[] for _ in range(int(number.max()) + 1)]
            for i, k in enumerate(number.tolist()):
                self.items[k].append(i)
            self.fill = [int(lengths[items].sum()) for items in self.items]

    def _best_fit_decreasing(self) -> None:
        gaps: list[int] = []  # gap sizes with an open bin, ascending
        open_bins: dict[int, list[int]] = defaultdict(list)
        for i in np.argsort(-self.lengths, kind="stable").tolist():
            size = int(self.lengths[i])
            at = bisect.bisect_left(gaps, size)
            if at == len(gaps):
                number = len(self.items)
                self.items.append([])
                self.fill.append(0)
            else:
                gap = gaps[at]
                number = open_bins[gap].pop()
                if not open_bins[gap]:
                    gaps.pop(at)
            self.items[number].append(i)
            self.fill[number] += size
            left = self.capacity - self.fill[number]
            if left:
                if not open_bins[left]:
                    bisect.insort(gaps, left)
                open_bins[left].append(number)

    def _index(self) -> None:
        """Arrays over all bins and pieces by which ``_give`` finds partners."""
        self.order = np.argsort(self.lengths, kind="stable")
        self.sorted = self.lengths[self.order].astype(np.int64)
        self.owner = np.zeros(len(self.lengths), np.int64)  # by place in ``sorted``
        self.place = np.empty(len(self.lengths), np.int64)
        self.place[self.order] = np.arange(len(self.lengths))
        for b, items in enumerate(self.items):
            self.owner[self.place[items]] = b
        self.gap = self.capacity - np.array(self.fill, np.int64)
        self.gap[[not items for items in self.items]] = 0  # an empty bin is gone and takes nothing
        # Bit k of byte j of a row: a piece of the row's size may be exchanged for two of bin 8 j + 7 - k.
        self.pairs = np.zeros((self.capacity + 1, len(self.items) // 8 + 1), np.uint8)
        for b in range(len(self.items)):
            self._index_pairs(b)

    def _index_pairs(self, b: int) -> None:
        """Sizes that bin ``b`` may take for two pieces (a piece may count twice here; ``_two`` is exact)."""
        gap, sizes, both = int(self.gap[b]), 0, 0
        if gap:
            own = {int(self.lengths[y]) for y in self.items[b]}
            for size in own:
                sizes |= 1 << size
            for size in own:
                both |= sizes << size
            both <<= 1  # one more than the two, up to ``gap`` more
            width = 1
            while width < gap:
                step = min(width, gap - width)
                both |= both << step
                width += step
            both &= (1 << (self.capacity + 1)) - 1
        data = np.frombuffer(both.to_bytes(self.capacity // 8 + 1, "little"), np.uint8)
        bits = np.unpackbits(data, bitorder="little")[:self.capacity + 1]
        column = self.pairs[:, b >> 3]
        column &= np.uint8(255 ^ (128 >> (b & 7)))
        column |= bits << np.uint8(7 - (b & 7))

    def _two(self, b: int, size: int) -> list[int]:
        """Two pieces of bin ``b`` that together leave just enough room for ``size``."""
        gap = int(self.gap[b])
        sizes = sorted((int(self.lengths[y]), y) for y in self.items[b])
        low, high = 0, len(sizes) - 1
        while low < high:
            both = sizes[low][0] + sizes[high][0]
            if both >= size:
                high -= 1
            elif both < size - gap:
                low += 1
            else:
                return [sizes[low][1], sizes[high][1]]
        return []

    def _give(self, giver: int, x: int) -> bool:
        """One step that takes piece ``x`` out of ``giver`` into a bin that is as full or fuller; false if none exists."""
        size = int(self.lengths[x])
        takes = (self.gap > 0) & (self.gap <= self.gap[giver])
        takes[giver] = False
        fits = np.flatnonzero(takes & (self.gap >= size))
        if len(fits):
            self._swap(giver, x, int(fits[self.gap[fits].argmin()]), [])
            return True
        low, high = np.searchsorted(self.sorted, [size - int(self.gap[giver]), size])
        owner = self.owner[low:high]
        good = takes[owner] & (self.gap[owner] >= size - self.sorted[low:high])
        if good.any():
            at = int(low + good.argmax())
            self._swap(giver, x, int(self.owner[at]), [int(self.order[at])])
            return True
        for b in np.flatnonzero(takes & np.unpackbits(self.pairs[size])[:len(takes)].astype(bool)).tolist():
            back = self._two(b, size)
            if back:
                self._swap(giver, x, b, back)
                return True
        return False

    def _swap(self, giver: int, x: int, taker: int, back: list[int]) -> None:
        moved = int(self.lengths[x]) - sum(int(self.lengths[y]) for y in back)
        self.items[giver].remove(x)
        self.items[taker].append(x)
        self.owner[self.place[x]] = taker
        for y in back:
            self.items[taker].remove(y)
            self.items[giver].append(y)
            self.owner[self.place[y]] = giver
        self.fill[giver] -= moved
        self.fill[taker] += moved
        for b in (giver, taker):
            self.gap[b] = self.capacity - self.fill[b] if self.items[b] else 0
            self._index_pairs(b)

    def search(self) -> None:
        """Empty bins from the emptiest on, until their number is least or no step is left.

        A pass lets every underfull bin give to all that are fuller. Later steps can open new ones for bins that were
        stuck, so passes repeat while anything moves.
        """
        least = math.ceil(int(self.lengths.sum()) / self.capacity)
        alive = sum(map(bool, self.items))
        moved = alive > least
        if moved:
            self._index()
        while moved and alive > least:
            moved = False
            under = (b for b in range(len(self.items)) if 0 < self.fill[b] < self.capacity)
            for giver in sorted(under, key=self.fill.__getitem__):
                stuck = self.fill[giver] == self.capacity  # filled since
                while self.items[giver] and not stuck:
                    ordered = sorted(self.items[giver], key=lambda i: -int(self.lengths[i]))
                    stuck = not any(self._give(giver, x) for x in ordered)
                    moved = moved or not stuck
                if not self.items[giver]:
                    alive -= 1
                    if alive <= least:
                        break


def _pack_shard(capacity: int):
    def run(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        order = table.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=False, kind="stable")
        order = order.reset_index(drop=True)
        lengths = order["length"].to_numpy()
        bins = Bins(lengths, capacity)
        bins.search()
        if "sequence_id" in order:
            further = Bins(lengths, capacity, order["sequence_id"].to_numpy())
            further.search()
            bins = min(further, bins, key=lambda found: sum(map(bool, found.items)))
        number, offset = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        again = np.zeros(len(order), bool)
        for b, items in enumerate(bins.items):
            at = 0
            for i in items:
                number[i], offset[i], again[i] = b, at, bins.fill[b] < capacity
                at += int(lengths[i])
        # 31 bits of shard above 32 bits of bin: no two shards share a number.
        order["sequence_id"] = (int(key[0]) << 32) + number
        order["offset"] = offset
        order["again"] = again
        return order

    return run


def pack(parts: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of ``parts`` (columns as ``pieces`` makes them)."""
    columns = [c for c in parts.columns if c not in ("sequence_id", "offset", "again")]
    schema = T.StructType([*(parts.schema[c] for c in columns), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType()), T.StructField("again", T.BooleanType())])

    def once(df: DataFrame, key: Column, shards: int, first_shard: int) -> DataFrame:
        shard = F.pmod(key, F.lit(shards)) + first_shard
        return df.groupBy(shard.alias("shard")).applyInPandas(_pack_shard(capacity), schema)

    def used(df: DataFrame) -> int:
        return df.where("offset = 0").count()  # pieces hold one token at least

    shards = max(1, math.ceil(parts.count() / shard_rows))
    packed = once(parts.select(*columns), F.xxhash64("doc_id", "piece", "ids_crc32", "length"), shards, 0)
    if shards == 1:
        return packed.drop("again")
    packed = materialize(packed, "packed")
    full, first_shard = packed.where("not again"), 0
    while True:
        first_shard += shards
        under = packed.where("again")
        shards = max(1, math.ceil(under.count() / shard_rows))
        dealt = once(under.select(*columns, "sequence_id"), F.xxhash64("sequence_id", F.lit(first_shard)), shards, first_shard)
        dealt = materialize(dealt, "packed")
        if shards == 1 or used(dealt) == used(under):
            return full.unionByName(dealt).drop("again")
        full, packed = full.unionByName(dealt.where("not again")), dealt


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` with their places; ids are given by start and length, and checked by ids_crc32."""
    return pack(materialize(pieces(docs, tokenizer, capacity, with_ids=False), "pieces"), capacity)
