"""Language-model scoring by a probabilistic suffix tree over words.

The tree's contexts are word sequences of different lengths. A context is kept when the distribution
of the next word after it diverges from that of its suffix (count times Kullback-Leibler
divergence above a bound); the next-word distribution of a kept context is smoothed into that of the
longest kept suffix, down to the add-one distribution of single words at the root. A text is scored
word by word from the state of the longest kept suffix.

Counting covers the whole training part. Every sequence seen ``LEAST`` times can be a context or a remembered
next word, at any corpus size; words, sequences and states are stored tables that grow with the corpus. A level is
counted by one groupBy, and its contexts are tested by a join of the level with the level below, which holds
their suffixes. Sequences whose start or end is too rare are left out before the groupBy by a bit table of
hashes, which passes some too many and none too few.

The log probability of a word is a sum: root, plus for every kept suffix of its history the log share that the suffix
leaves to shorter ones, plus a correction where the word was seen after it. Both are values of a key, so scoring is
a join of keys with one table, grouped by key range: sorted keys of a range travel as differences. Keys of more than ``STATE_SHARE`` of all tokens are looked up where the text is read, and so are
words above ``WORD_SHARE``; only the others take part in joins, which so have no hot key. Both shares change
where a value is looked up and no result.

Sequences are told apart by 64-bit hashes of their words.

Defined results: NULL and blank texts consist of the end token; a NULL doc_id belongs to the training part;
repeated rows count and score each; without training rows all words are unknown; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.worker import focus, release
from erpweave.session import materialize

END = b""  # the end token; no word is empty
WORD_SHARE = 5e-7  # words above it are in the workers' dictionary (at most 2 million)
STATE_SHARE = 2e-6  # keys above it are too (at most 500,000 a level and kind)
LEAST = 4  # sequences seen as often can be contexts and next words
DEPTH = 3
KAPPA = 2.0  # weight of the shorter state besides its unseen share
GAIN = 10.0  # divergence in nats that a context must bring, besides one per next word
TURN = 21  # bits by which a sequence's hash is turned before the next word is added
AS_CONTEXT = 0x5DEECE66D1234567  # tells the key of a context from that of the sequence
BITS = 27  # log of the largest size of a bit table
BITS_PER_KEY = 32  # below that size: one absent key in 32 passes at most
TOKENS = 250_000  # tokens held as arrays at a time
TOKENS_PER_RANGE, FEWEST_RANGES = 2_000_000, 64  # ranges of keys to look up


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens(text: bytes | None) -> list[bytes]:
    words = text.lower().split() if text else []
    words.append(END)
    return words


def _count_words(batches):
    """(word, n) of a partition, combined as far as memory allows."""

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text"):
            counts.update(tokens(text.as_py()))
            if len(counts) > 400_000:
                yield out(counts)
                counts = Counter()
    if counts:
        yield out(counts)


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in sorted ``keys``; -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def word_id(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little", signed=True)


class _WordIds(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = found = word_id(word)
        return found


_WORD_IDS = _WordIds()
END_ID = word_id(END)


def longer(sequence: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a sequence with one more word; ``_longer`` is the same on columns."""
    turned = sequence.view(np.uint64)
    return ((turned << np.uint64(TURN)) | (turned >> np.uint64(64 - TURN))).view(np.int64) ^ word


def _longer(sequence: str, word: str) -> Column:
    return F.expr(f"(shiftleft({sequence}, {TURN}) | shiftrightunsigned({sequence}, {64 - TURN})) ^ {word}")


def bit_table(keys: DataFrame) -> np.ndarray:
    """Bits set at the low ends of the stored ``keys(key)``; at most 2^(BITS - 6) rows reach the driver."""
    wanted, bits = BITS_PER_KEY * keys.count(), 6
    while bits < BITS and 1 << bits < wanted:
        bits += 1
    slot = f"(key & {(1 << bits) - 1}L)"
    rows = (
        keys.select(F.expr(f"shiftright({slot}, 6)").alias("at"), F.expr(f"shiftleft(1L, cast({slot} & 63 as int))").alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    table = np.zeros(1 << (bits - 6), np.int64)
    table[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return table


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & (64 * len(table) - 1)
    return (table[slot >> 6] >> (slot & 63)) & 1 == 1


def range_of(keys: np.ndarray, n_ranges: int) -> np.ndarray:
    """Ranges ascend with the keys as unsigned numbers; ``_range_of`` is the same on columns."""
    return ((keys.view(np.uint64) >> np.uint64(40)) * np.uint64(n_ranges) >> np.uint64(24)).astype(np.int32)


def _range_of(n_ranges: int) -> Column:
    return F.expr(f"cast(shiftright(shiftrightunsigned(key, 40) * {n_ranges}L, 24) as int)")


def planes(numbers: np.ndarray) -> bytes:
    """All first bytes, then all second ones, and so on: zeros of small numbers stand together and compress to nothing."""
    return numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


def blocks(keys: np.ndarray, rows: np.ndarray, n_ranges: int):
    """(range, keys, rows) of every range: sorted keys as differences, and the row of each."""
    order = np.argsort(keys.view(np.uint64), kind="stable")
    keys, rows = keys[order], rows[order]
    of = range_of(keys, n_ranges)
    bounds = [*np.flatnonzero(np.diff(of, prepend=-1)), len(keys)]
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield int(of[a]), planes(np.diff(keys[a:b], prepend=np.int64(0))), planes(rows[a:b])


def _state_sums(asked: pa.Table, values: pa.Table) -> pa.Table:
    """Sum of the values of the keys that each row asks for in one range."""
    keys, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row, a, b in zip(*(asked.column(c).to_pylist() for c in ("row", "keys", "rows")), strict=True):
        keys.append(np.cumsum(unplanes(a)))
        rows.append(unplanes(b) + row)
    known, worth = values.column("key").to_numpy(), values.column("value").to_numpy()
    order = np.argsort(known)
    at = find(known[order], np.concatenate(keys))
    found, place = np.unique(np.concatenate(rows)[at >= 0], return_inverse=True)
    state = np.bincount(place, worth[order][at[at >= 0]], len(found)) if len(found) else np.zeros(0)
    return pa.table({"row": pa.array(found, pa.int64()), "state": pa.array(state, pa.float64())})


def sequences(ids: np.ndarray, levels: int):
    """Per level: places of tokens with a whole context in their text, hash of the context and of both together."""
    inner = ids != END_ID
    place = np.arange(1, len(ids))[inner[:-1]]
    every = ids
    for level in range(levels):
        context = every[place - 1]
        both = longer(context, ids[place])
        yield place, context, both
        every = np.zeros(len(ids), np.int64)
        every[place] = both
        whole = np.zeros(len(ids), bool)
        whole[place] = inner[place]
        place = np.arange(1, len(ids))[whole[:-1]]


class Tree:
    """The workers' part of the tree: frequent words by falling count, and the values of frequent keys.

    ``contexts[d]`` are the hashes of frequent contexts of d + 1 words (at level 0, of the words in their order) and
    ``suffixes[d]`` those of their suffixes. ``values`` is the stored table of all keys, ``bits`` its bit table.
    """

    def __init__(self, words: list[bytes], counts: np.ndarray, n: int, v: int):
        self.numbers = dict(zip(words, range(len(words)), strict=True))
        self.counts, self.n, self.v = counts, n, v
        self.ids = np.array([word_id(w) for w in words], np.int64)
        self.root = (counts + 1.0) / (n + v + 1.0)
        self.levels = 0
        self.keys, self.worth = np.zeros(0, np.int64), np.zeros(0)
        self.bits = np.zeros(1, np.int64)
        self.contexts: list[np.ndarray] = []
        self.suffixes: list[np.ndarray] = []
        self.kept: list[np.ndarray] = []
        self.values: DataFrame | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "values": None}

    def encode(self, batch: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Word numbers of texts behind one another (-1: not in the dictionary), where each ends, and the words."""
        flat: list[bytes] = []
        ends = []
        for text in batch:
            if text:
                flat += text.lower().split()
            flat.append(END)
            ends.append(len(flat))
        return np.fromiter(map(self.numbers.get, flat, repeat(-1)), np.int64, len(flat)), np.array(ends), flat

    def hashed(self, numbers: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Hashes of all words, in the dictionary or not."""
        ids = self.ids[np.maximum(numbers, 0)] if len(self.ids) else np.zeros(len(numbers), np.int64)
        cold = np.flatnonzero(numbers < 0)
        ids[cold] = np.fromiter((_WORD_IDS[words[i]] for i in cold.tolist()), np.int64, len(cold))
        return ids

    def pair_counter(self, level: int, bits: np.ndarray):
        """Counts (context, word) of a level, where ``bits`` has the start and the end of the sequence."""

        def run(batches):
            # Sequence and context; the word is what the one adds to the other. Held in place, since executors share their memory.
            held = np.empty((2, 1_000_000), np.int64)
            waiting = 0

            def out():
                nonlocal waiting
                key, context = held[:, :waiting]
                order = np.argsort(key)
                ordered = key[order]
                first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])).astype(np.int32)
                del ordered
                counts = np.diff(first, append=np.int32(waiting))
                for at in range(0, len(first), 500_000):
                    rows = order[first[at:at + 500_000]]
                    of = context[rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(of), pa.array(longer(of, key[rows])), pa.array(counts[at:at + 500_000], pa.int64())],
                        ["context", "word", "n"])
                waiting = 0

            for texts in _slices(batches):
                numbers, _, words = self.encode(texts)
                ids = self.hashed(numbers, words)
                end = ids
                for at, (place, context, both) in enumerate(sequences(ids, level + 1)):
                    if at < level:  # the sequence one word shorter is the end of the one wanted
                        end = np.zeros(len(ids), np.int64)
                        end[place] = both
                fine = may_hold(bits, context)
                fine[fine] = may_hold(bits, end[place[fine]])
                both, context = both[fine], context[fine]
                if waiting + len(both) > held.shape[1]:
                    wider = np.empty((2, min(2 * held.shape[1], 4_000_000) + len(both)), np.int64)
                    wider[:, :waiting] = held[:, :waiting]
                    held = wider
                held[:, waiting:waiting + len(both)] = both, context
                waiting += len(both)
                if waiting > 4_000_000:
                    yield from out()
                    release()
            if waiting:
                yield from out()

        return run

    def worths(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of keys, 0 where the dictionary has none, and whether it has one."""
        at = find(self.keys, keys)
        return np.where(at >= 0, self.worth[at] if len(self.keys) else 0.0, 0.0), at >= 0

    def probability(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Probability of dictionary words after frequent contexts of a level, by the keys in the dictionary."""
        p = np.log10(self.root[word])
        known = self.contexts[level][context]
        for at in range(level, -1, -1):
            for key in (known ^ AS_CONTEXT, longer(known, self.ids[word])):
                p = p + self.worths(key)[0]
            if at:
                order = np.argsort(self.contexts[at])
                known = self.suffixes[at][order[find(self.contexts[at][order], known)]]
        return 10.0 ** p

    def states(self, ids: np.ndarray):
        """Places of tokens and keys that may have a value."""
        for place, context, both in sequences(ids, self.levels):
            key = context ^ AS_CONTEXT
            fine = np.flatnonzero(may_hold(self.bits, key))
            yield place[fine], key[fine]
            fine = fine[may_hold(self.bits, both[fine])]  # a word is remembered after kept contexts only
            yield place[fine], both[fine]

    def score(self, numbers: np.ndarray) -> np.ndarray:
        """log10 probability of every dictionary word in a text of them, by the keys in the dictionary."""
        p = np.log10(self.root[numbers])
        for place, key in self.states(self.ids[numbers]):
            p[place] += self.worths(key)[0]
        return p

    def scorer(self, n_ranges: int):
        """A row for every text, and rows of asked keys that are not in the dictionary (``span`` is their range)."""

        def run(batches):
            part = TaskContext.get().partitionId() << 40
            for batch in batches:
                at = 0
                for texts in _slices([batch]):
                    numbers, ends, words = self.encode(texts)
                    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                    hot = numbers >= 0
                    base = np.where(hot, np.log10(self.root[np.maximum(numbers, 0)]) if len(self.root) else 0.0, 0.0)
                    state = np.zeros(len(hot))
                    asked, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                    for place, key in self.states(self.hashed(numbers, words)):
                        worth, known = self.worths(key)
                        state[place] += worth
                        asked.append(place[~known])
                        keys.append(key[~known])
                    asked, keys = np.concatenate(asked), np.concatenate(keys)
                    bounds = [*starts, len(hot)]
                    cold = np.flatnonzero(~hot)
                    rare = pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(cold, bounds), pa.int32()),
                        pa.array([words[i] for i in cold.tolist()], pa.binary()))
                    n = len(texts)
                    scores = [
                        pa.array(np.arange(part, part + n)), batch.column("doc_id").slice(at, n),
                        batch.column("held_out").slice(at, n), pa.array(ends - starts, pa.int64()),
                        pa.array(np.add.reduceat(hot.astype(np.int64), starts)), pa.array(np.add.reduceat(base, starts)),
                        pa.array(np.add.reduceat(base + state, starts)), rare]
                    names = ["row", "doc_id", "held_out", "n_tokens", "n_hot", "base", "score", "rare", "span", "keys", "rows"]
                    kinds = [pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([*scores, *(pa.nulls(n, kind) for kind in kinds)], names)
                    sent = list(blocks(keys, np.searchsorted(starts, asked, side="right") - 1, n_ranges))
                    if sent:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(sent), part)), *(pa.nulls(len(sent), x.type) for x in scores[1:]),
                             *(pa.array(x, kind) for x, kind in zip(zip(*sent, strict=True), kinds, strict=True))], names)
                    part += n
                    at += n

        return run


def _counter(shared, level: int):
    def run(batches):
        focus()
        tree, bits = shared.value
        yield from tree.pair_counter(level, bits)(batches)

    return run


def _scorer(shared, n_ranges: int):
    def run(batches):
        focus()
        yield from shared.value.scorer(n_ranges)(batches)

    return run


def _slices(batches):
    """Texts in lists of about ``TOKENS`` tokens."""
    for batch in batches:
        texts: list[bytes | None] = []
        size = 0
        for value in batch.column("text"):
            text = value.as_py()
            texts.append(text)
            size += len(text or b"") // 5 + 1
            if size > TOKENS:
                yield texts
                texts, size = [], 0
        if texts:
            yield texts


def _symbols(batches):
    for batch in batches:
        ids = [word_id(w) for w in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), batch.column("n")], ["key", "n"])


def _level(counted: DataFrame, below: DataFrame) -> DataFrame:
    """Test the contexts of ``counted(context, word, n)`` against their suffixes, and smooth the kept ones.

    ``below(key, n, suffix, p)`` is the level of the contexts and of the suffixes. The result is such a table, with
    the context, its count and values; ``left`` and ``more`` are NULL for contexts that are not kept.
    """
    rows = (
        counted.join(below.select(F.col("key").alias("context"), F.col("n").alias("total"), F.col("suffix").alias("parent")), "context")
        .select("context", "n", "total", "parent", _longer("context", "word").alias("key"), _longer("parent", "word").alias("suffix"))
        .join(below.select(F.col("key").alias("suffix"), F.col("p").alias("before")), "suffix")
    )
    rows = materialize(rows, "sequences", "zstd")
    now = F.col("n") / F.col("total")
    tested = rows.groupBy("context").agg(
        F.first("total").alias("total"), F.sum("n").alias("known"), F.count("*").alias("words"),
        F.sum(now * F.ln(now / F.col("before"))).alias("gain"), F.sum("before").alias("before"))
    rest_now = F.greatest(F.lit(1e-12), 1.0 - F.col("known") / F.col("total"))
    rest_before = F.greatest(F.lit(1e-12), 1.0 - F.col("before"))
    gain = F.col("total") * (F.col("gain") + rest_now * F.ln(rest_now / rest_before))
    kept = tested.where(gain > GAIN + F.col("words")).select("context", (F.col("total") - F.col("known") + KAPPA).alias("back"))
    left = F.col("back") / (F.col("total") + KAPPA)
    p = F.coalesce((F.col("n") + F.col("back") * F.col("before")) / (F.col("total") + KAPPA), "before")
    return materialize(
        rows.join(kept, "context", "left").select(
            "key", "n", "suffix", "context", "total", "parent", p.alias("p"), F.log10(left).alias("left"),
            (F.log10(p) - F.log10(left * F.col("before"))).alias("more")),
        "level", "zstd")


def grow(training: DataFrame, vocabulary: DataFrame, depth: int = DEPTH) -> Tree:
    """Fit the tree to ``training(text)`` with its stored ``vocabulary(word, n)``."""
    totals = vocabulary.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = totals["n"] or 0, totals["v"]
    frequent = vocabulary.where(F.col("n") >= max(LEAST, WORD_SHARE * n)).toArrow()
    words, counts = frequent["word"].to_pylist(), frequent["n"].to_numpy().astype(np.int64)
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    counts = counts[order] if len(order) else counts
    tree = Tree([words[i] for i in order], counts, n, v)
    below = materialize(
        vocabulary.where(F.col("n") >= LEAST).select("word", "n").mapInArrow(_symbols, "key long, n long")
        .select("key", "n", F.lit(0).cast("long").alias("suffix"), ((F.col("n") + 1.0) / (n + v + 1.0)).alias("p")),
        "symbols")
    hot = max(LEAST, STATE_SHARE * n)
    values: list[DataFrame] = []
    for level in range(depth):
        bits = bit_table(below)
        if not bits.any():
            break
        shared = training.sparkSession.sparkContext.broadcast((tree, bits))
        counted = (
            training.select("text").mapInArrow(_counter(shared, level), "context long, word long, n long")
            .groupBy("context", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
        )
        below = _level(counted, below)
        shared.destroy()  # the level is stored
        kept = below.where("left IS NOT NULL")
        states = kept.groupBy("context").agg(F.first("total").alias("n"), F.first("left").alias("value"), F.first("parent").alias("parent"))
        values.append(states.select(F.expr(f"context ^ {AS_CONTEXT}L").alias("key"), "n", "value"))
        values.append(kept.select("key", "n", F.col("more").alias("value")))
        known = states.where(F.col("n") >= hot).select("context", "parent").toArrow()
        found = known["context"].to_numpy()
        if level:
            tree.contexts.append(found)
            tree.suffixes.append(known["parent"].to_numpy())
            tree.kept.append(np.ones(len(found), bool))
        else:
            tree.contexts.append(tree.ids)
            tree.suffixes.append(np.zeros(len(tree.ids), np.int64))
            tree.kept.append(np.isin(tree.ids, found))
        tree.levels += 1
    if values:
        table = values[0]
        for more in values[1:]:
            table = table.unionByName(more)
        tree.values = materialize(table, "values", "zstd")
        tree.bits = bit_table(tree.values)
        known = tree.values.where(F.col("n") >= hot).select("key", "value").toArrow()
        order = np.argsort(known["key"].to_numpy())
        tree.keys, tree.worth = known["key"].to_numpy()[order], known["value"].to_numpy()[order]
    return tree


def scored(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    read = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    training = read.where(~F.col("held_out"))
    vocabulary = materialize(
        training.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "vocabulary", "zstd")
    tree = grow(training, vocabulary, depth)
    kind = docs.schema["doc_id"].dataType.simpleString()
    n_ranges = max(FEWEST_RANGES, tree.n // TOKENS_PER_RANGE)
    shared = docs.sparkSession.sparkContext.broadcast(tree)
    stored = materialize(
        read.mapInArrow(
            _scorer(shared, n_ranges), f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_hot long, base double, "
            "score double, rare array<binary>, span int, keys binary, rows binary"),
        "scores", "zstd")
    shared.destroy()
    known = stored.where("span IS NULL")
    of_rare = F.log10((F.coalesce("n", F.lit(0)) + 1.0) / (tree.n + tree.v + 1.0))
    # Stored one after the other, so that only one of the two lookups has its shuffles on disk.
    rare = materialize(
        known.select("row", F.explode("rare").alias("word"))
        .join(vocabulary, "word", "left")
        .groupBy("row").agg(F.sum(of_rare).alias("rest"), F.count("n").alias("n_rare")),
        "rare-words")
    known_words = known.join(rare, "row", "left")
    rest = F.coalesce("rest", F.lit(0.0))
    state = F.lit(0.0)
    if tree.values is not None:
        asked = stored.where("span IS NOT NULL").select("row", "span", "keys", "rows")
        values = tree.values.select(_range_of(n_ranges).alias("span"), "key", "value")
        states = materialize(
            asked.groupBy("span").cogroup(values.groupBy("span")).applyInArrow(_state_sums, "row long, state double")
            .groupBy("row").agg(F.sum("state").alias("state")),
            "states")
        known_words = known_words.join(states, "row", "left")
        state = F.coalesce("state", F.lit(0.0))
    return known_words.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_hot") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(tree.n).cast("long").alias("train_tokens"), (F.col("base") + rest).alias("base_score"),
        (F.col("score") + rest + state).alias("score"),
    )
