"""Phrase collocations mined with weighted acyclic automata.

A count transducer maps phrases to counts: an acyclic automaton over words whose states carry the count of the phrase
that ends there. Every shard (a few megabytes of text inside a task) sorts its distinct n-grams and builds its transducers
incrementally: while phrases come in order, what the last one does not share with the next is closed and merged with an
equal state. The phrase space is cut into prefix ranges (ranges of the hash of the first two words), a shard sends one transducer for each
language and range, and one group unites all of a range: states reached by the same words become one and weights
add up. What stays below ``LEAST`` is cut from the union.

Words are counted first, then phrases of two to five words, and shards leave out what cannot be frequent: a phrase is no more
frequent than its parts, and a pair no more than all pairs whose hash falls into its bucket together. So pairs of frequent words are
added up by bucket between the two, as plain numbers, and phrases are followed along pairs of frequent buckets only. Shards read
both from bit tables sized by what is frequent, up to ``MOST_BITS`` bits; beyond, or by chance, a table lets more
through and never less, and the union cuts it again.

Scores need the counts of a phrase's parts. Asked parts are sent to their ranges, where an acceptor of all
asked parts is composed with the transducer, both walked in step. A range with more than ``ASKERS`` asked parts is copied to
several tasks that share them, so a part that many phrases ask for does not meet in one task.

Defined results: NULL texts are empty, a NULL language is ``und``; repeated rows count each time; an empty table gives no
rows; ids and further columns do not matter.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from erpweave.llm.worker import focus, release
from erpweave.session import materialize

LONGEST, LEAST, TOP = 5, 100, 2000
MOST_BITS = 1 << 27
SHARD_BYTES = 16_000_000
ASKERS = 50_000  # that one task looks up in a range
DOCS_PER_RANGE, FEWEST_RANGES = 2_000, 16

TRANSDUCER = "words array<string>, weight array<bigint>, first array<int>, label array<int>, target array<int>"
_SENT = f"lang string, level int, range int, total bigint, {TRANSDUCER}"

# What a byte is: 0 part of a word, 1 a blank inside a piece, 2 an end of a piece.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Transducer:
    """Counts of phrases: states with a weight and arcs (word, state); the last state is the start.

    Built from phrases in ascending order (``add``, then ``close``), equal states kept once.
    """

    def __init__(self):
        self.weight: list[int] = []
        self.arcs: list[tuple[tuple[str, int], ...]] = []
        self._known: dict[tuple, int] = {}
        self._open: list[list] = [[0, []]]  # states along the last phrase: weight and arcs
        self._last: tuple[str, ...] = ()

    def state(self, weight: int, arcs: tuple[tuple[str, int], ...]) -> int:
        key = (weight, arcs)
        number = self._known.get(key)
        if number is None:
            number = self._known[key] = len(self.weight)
            self.weight.append(weight)
            self.arcs.append(arcs)
        return number

    def _close_to(self, depth: int) -> None:
        while len(self._open) > depth + 1:
            weight, arcs = self._open.pop()
            self._open[-1][1].append((self._last[len(self._open) - 1], self.state(weight, tuple(arcs))))

    def add(self, phrase: tuple[str, ...], weight: int) -> None:
        same, last = 0, self._last
        while same < len(last) and same < len(phrase) and last[same] == phrase[same]:
            same += 1
        self._close_to(same)
        self._open.extend([0, []] for _ in phrase[same:])
        self._open[-1][0] += weight
        self._last = phrase

    def close(self) -> Transducer:
        self._close_to(0)
        weight, arcs = self._open.pop()
        self.start = self.state(weight, tuple(arcs))
        if self.start != len(self.weight) - 1:  # equal to an inner state
            self.weight.append(weight)
            self.arcs.append(tuple(arcs))
            self.start = len(self.weight) - 1
        return self

    def packed(self) -> tuple[list[str], list[int], list[int], list[int], list[int]]:
        """Words, weight by state, first arc by state, and word number and target by arc."""
        words = sorted({word for arcs in self.arcs for word, _ in arcs})
        number = {word: i for i, word in enumerate(words)}
        first, label, target = [0], [], []
        for arcs in self.arcs:
            for word, to in arcs:
                label.append(number[word])
                target.append(to)
            first.append(len(label))
        return words, self.weight, first, label, target

    @classmethod
    def unpacked(cls, words, weight, first, label, target) -> Transducer:
        made = cls()
        made.weight = list(weight)
        labels, targets = [words[i] for i in label], list(target)
        made.arcs = [tuple(zip(labels[a:b], targets[a:b], strict=True)) for a, b in zip(first, first[1:], strict=False)]
        made.start = len(made.weight) - 1
        return made

    def phrases(self):
        """All phrases with a weight, in order."""
        def walk(state: int, way: tuple[str, ...]):
            if self.weight[state]:
                yield way, self.weight[state]
            for word, to in self.arcs[state]:
                yield from walk(to, (*way, word))

        return walk(self.start, ())


def union(parts: list[Transducer], least: int) -> Transducer:
    """One transducer of the summed weights of all ``parts``; sums below ``least`` are left out."""
    made = Transducer()

    def joined(states: list[tuple[Transducer, int]]) -> tuple[int, tuple]:
        weight, ways = 0, defaultdict(list)
        for part, state in states:
            weight += part.weight[state]
            for word, to in part.arcs[state]:
                ways[word].append((part, to))
        arcs = []
        for word in sorted(ways):
            under = joined(ways[word])
            if under[0] or under[1]:
                arcs.append((word, made.state(*under)))
        return (weight if weight >= least else 0), tuple(arcs)

    weight, arcs = joined([(p, p.start) for p in parts])
    made.weight.append(weight)
    made.arcs.append(arcs)
    made.start = len(made.weight) - 1
    return made


def compose(asked: Transducer, counts: Transducer):
    """Phrases that both know, with their weight in ``counts``: the two are walked in step."""
    def walk(a: int, c: int, way: tuple[str, ...]):
        if asked.weight[a] and counts.weight[c]:
            yield way, counts.weight[c]
        ways = dict(counts.arcs[c])
        for word, to in asked.arcs[a]:
            if word in ways:
                yield from walk(to, ways[word], (*way, word))

    return walk(asked.start, counts.start, ())


# ---- hashes of phrases: bit tables and ranges -------------------------------------------------------------------

MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its beginning and of what follows."""
    h = (first ^ (first >> np.uint64(29))) * MIX + second
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def ranges_of(hashes: np.ndarray, n_ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) * np.uint64(n_ranges) >> np.uint64(31)).astype(np.int64)


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(33)).astype(np.int64)


def phrase_hashes(lang: str, phrases: list[tuple[str, ...]]) -> np.ndarray:
    """Hash of language and the first two words of every phrase, or its only one."""
    known = {w: i for i, w in enumerate({w for p in phrases for w in p[:2]})}
    table = np.append(word_hashes(list(known)), np.uint64(0))
    h = mixed(np.repeat(word_hashes([lang]), len(phrases)), table[[known[p[0]] for p in phrases]])
    second = table[[known[p[1]] if len(p) > 1 else -1 for p in phrases]]
    return np.where([len(p) > 1 for p in phrases], mixed(h, second), h)


class BitTable:
    """Which hashes may be frequent; knows every frequent one."""

    def __init__(self, bits: int, chunks: list[tuple[int, bytes]]):
        table = np.zeros(max(bits // 8, 4096), np.uint8)
        for number, data in chunks:
            table[(number - 1) * 4096:number * 4096] = np.frombuffer(data, np.uint8)
        self.bits, self.table = bits, table[:max(bits // 8, 1)]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = buckets_of(hashes) % self.bits
        return (self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bit_table(buckets: DataFrame) -> BitTable:
    """Bit table of the stored hash buckets ``bucket``."""
    n, bits = buckets.count(), 1 << 15
    while bits < min(16 * n, MOST_BITS):
        bits *= 2
    at = F.col("bucket") % bits + 1  # the bitmap functions count from 1
    chunks = buckets.groupBy(F.bitmap_bucket_number(at).alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("data"))
    return BitTable(bits, [tuple(r) for r in chunks.collect()])  # MOST_BITS / 8 bytes at most


def _word_buckets(batches):
    for batch in batches:
        for lang, _, made in _stored(batch):
            phrases = [p for p, _ in made.phrases()]
            if phrases:
                yield pa.RecordBatch.from_arrays([pa.array(buckets_of(phrase_hashes(lang, phrases)), pa.int64())], ["bucket"])


# ---- shards ---------------------------------------------------------------------------------------------------


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the place of every key among them, and their numbers: as ``np.unique``, in half the memory."""
    order = np.argsort(keys, kind="stable")
    found = keys[order]
    new = np.append(True, found[1:] != found[:-1])[:len(keys)]
    found = found[new]
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return found, place, np.diff(np.flatnonzero(new), append=len(keys))


class Shard:
    """The words of some texts as sorted codes, with language and where pieces end."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        kind = KIND[data]
        inside = kind == 0
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        #: Whether a word and its next one are in one piece; texts end with a piece.
        self.joined = np.append(piece[1:] == piece[:-1], False)[:len(starts)]
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = words.dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        self.words: list[bytes] = coded.dictionary.take(pa.array(order)).to_pylist()
        self.code = rank[coded.indices.to_numpy()] if len(order) else np.zeros(0, np.int32)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        known = sorted(set(langs))
        number = {lang: i for i, lang in enumerate(known)}
        document = np.searchsorted(np.cumsum(sizes), starts, side="right")
        self.lang = np.array([number[x] for x in langs], np.int32)[document]
        self.langs = known
        self.hash, self.lang_hash = word_hashes(self.words), word_hashes(known)

    def _singles(self):
        """Distinct words of each language: language, word, hash, number, and for every word its place among them."""
        n = np.int64(max(len(self.words), 1))
        single, at, count = distinct(self.lang * n + self.code)
        lang, word = np.divmod(single, n)
        return lang, word, mixed(self.lang_hash[lang], self.hash[word]), count, at

    def _pairs(self, words: BitTable):
        """Where pairs of frequent words start, and for every one its language, words, hash and number."""
        n = np.int64(max(len(self.words), 1))
        lang, word, one, _, at = self._singles()
        good = words(one)[at]
        pair = np.flatnonzero(self.joined[:-1] & good[:-1] & good[1:])
        key, back, count = distinct(at[pair] * n + self.code[pair + 1])
        begin, second = np.divmod(key, n)
        return pair, back, lang[begin], [word[begin], second], mixed(one[begin], self.hash[second]), count

    def buckets(self, words: BitTable) -> tuple[np.ndarray, np.ndarray]:
        """Hash buckets of pairs of frequent words, and how many pairs fall into each."""
        *_, hashes, count = self._pairs(words)
        found, at = np.unique(buckets_of(hashes), return_inverse=True)
        return found, np.bincount(at, count, len(found)).astype(np.int64)

    def grams(self, words: BitTable | None, pairs: BitTable | None):
        """Yield (language codes, hashes of the prefix, word codes by column, numbers) of distinct phrases, in order within a length."""
        if words is None:
            lang, word, one, count, _ = self._singles()
            yield lang, one, [word], count
            return
        n = np.int64(max(len(self.words), 1))
        pair, back, langs, columns, hashes, count = self._pairs(words)
        good = pairs(hashes)
        along = np.zeros(len(self.code) + 1, bool)  # a pair of a frequent bucket starts here
        along[pair] = good[back]
        where = np.zeros(len(self.code), np.int32)  # number of the phrase that starts at a word
        where[pair] = back
        yield langs[good], hashes[good], [c[good] for c in columns], count[good]
        live = np.flatnonzero(along[:-1])
        for length in range(3, LONGEST + 1):
            live = live[along[live + length - 2]]
            key, back, count = distinct(where[live] * n + self.code[live + length - 1])
            begin, last = np.divmod(key, n)
            columns, langs, hashes = [*(c[begin] for c in columns), last], langs[begin], hashes[begin]
            where[live] = back
            yield langs, hashes, columns, count

    def transducers(self, level: int, n_ranges: int, words: BitTable | None, pairs: BitTable | None):
        """One row (language, level, range, total, transducer) for every language and range with phrases."""
        text = [w.decode() for w in self.words]
        lengths = []
        for langs, hashes, columns, counts in self.grams(words, pairs):
            group = langs * np.int64(n_ranges) + ranges_of(hashes, n_ranges)
            order = np.argsort(group, kind="stable")
            lengths.append((group[order], [c[order].astype(np.int32) for c in columns], counts[order]))
        for group in np.unique(np.concatenate([groups for groups, *_ in lengths])).tolist():
            lang, span = divmod(group, n_ranges)
            found: list[tuple[tuple[int, ...], int]] = []  # only one range at a time as Python objects
            for groups, columns, counts in lengths:
                part = slice(*np.searchsorted(groups, (group, group + 1)))
                found += zip(zip(*(c[part].tolist() for c in columns), strict=True), counts[part].tolist(), strict=True)
            if level == 2:
                found.sort()  # every length came in order by itself
            made = Transducer()
            for codes, weight in found:
                made.add(tuple([text[c] for c in codes]), weight)
            total = sum(weight for _, weight in found) if level == 1 else 0
            yield (self.langs[lang], level, span, total, *made.close().packed())


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("lang", pa.string()), ("level", pa.int32()), ("range", pa.int32()), ("total", pa.int64()), ("words", pa.list_(pa.string())),
             ("weight", pa.list_(pa.int64())), ("first", pa.list_(pa.int32())), ("label", pa.list_(pa.int32())), ("target", pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [k for k, _ in kinds])


def _stored(batch):
    """(language, level, transducer) of stored rows."""
    names = ("words", "weight", "first", "label", "target")
    for lang, level, *parts in zip(*(batch.column(c).to_pylist() for c in ("lang", "level", *names)), strict=True):
        yield lang, level, Transducer.unpacked(*parts)


def _slices(batches):
    """Shards of a few megabytes of text each."""
    texts: list[bytes] = []
    langs: list[str] = []
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            texts.append(text.as_py())
            langs.append(lang)
            size += len(texts[-1])
            if size > SHARD_BYTES:
                made, texts, langs, size = Shard(texts, langs), [], [], 0
                yield made
                del made
    if texts:
        yield Shard(texts, langs)


def _shards(level: int, n_ranges: int, words, pairs):
    def run(batches):
        focus()
        tables = [t.value if t else None for t in (words, pairs)]
        for shard in _slices(batches):
            rows, row = [], None
            for row in shard.transducers(level, n_ranges, *tables):
                rows.append(row)
                if len(rows) == 200:
                    yield _sent(rows)
                    rows = []
            yield _sent(rows)
            del shard, rows, row
            release()  # before the next shard is made

    return run


def _pair_buckets(words):
    def run(batches):
        focus()
        for shard in _slices(batches):
            found, count = shard.buckets(words.value)
            del shard
            release()
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count)], ["bucket", "n"])

    return run


def _unite(least: int):
    def run(table: pa.Table) -> pa.Table:
        head = table.slice(0, 1).to_pylist()[0]
        made = union([t for _, _, t in _stored(table)], least)
        row = (head["lang"], head["level"], head["range"], pc.sum(table.column("total")).as_py(), *made.packed())
        return pa.Table.from_batches([_sent([row])])

    return run


def counted(texts: DataFrame, level: int, n_ranges: int, least: int, words=None, pairs=None) -> DataFrame:
    """United transducers of one level, stored: words (1) or phrases of two and more (2)."""
    sent = texts.mapInArrow(_shards(level, n_ranges, words, pairs), _SENT)
    return materialize(sent.groupBy("lang", "level", "range").applyInArrow(_unite(least), _SENT), f"phrases-{level}")


# ---- scores ---------------------------------------------------------------------------------------------------


def _level(words: int) -> int:
    return min(words, 2)


def _asked_parts(n_ranges: int):
    """For every phrase of two or more words: both parts of each cut, with the range that counts them."""
    def run(batches):
        for batch in batches:
            for lang, _, made in _stored(batch):
                rows = []
                for phrase, a in made.phrases():
                    for k in range(1, len(phrase)):
                        rows.append((" ".join(phrase), a, k, True, phrase[:k]))
                        rows.append((" ".join(phrase), a, k, False, phrase[k:]))
                if rows:
                    parts = [r[4] for r in rows]
                    spans = ranges_of(phrase_hashes(lang, parts), n_ranges)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(rows)), pa.array([_level(len(p)) for p in parts], pa.int32()), pa.array(spans, pa.int32()),
                        pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()),
                        pa.array([r[3] for r in rows]), pa.array([" ".join(p) for p in parts])],
                        ["lang", "level", "range", "phrase", "a", "k", "is_left", "part"])

    return run


def _answer(held: pa.Table, asked: pa.Table) -> pa.Table:
    """Counts of the asked parts of one range."""
    parts = asked.column("part").to_pylist()
    acceptor = Transducer()
    for part in sorted({tuple(p.split(" ")) for p in parts}):
        acceptor.add(part, 1)
    acceptor.close()
    counts: dict[str, int] = {}
    for _, _, made in _stored(held):
        counts.update((" ".join(p), n) for p, n in compose(acceptor, made))
    answers = asked.select(["lang", "phrase", "a", "k", "is_left"])
    return answers.append_column("n", pa.array([counts[p] for p in parts], pa.int64()))


def part_counts(transducers: DataFrame, n_ranges: int) -> DataFrame:
    """lang, phrase, a, k, is_left, n: the count of each part of each frequent phrase."""
    keys = ["lang", "level", "range"]
    asked = materialize(transducers.where("level > 1").mapInArrow(
        _asked_parts(n_ranges), "lang string, level int, range int, phrase string, a bigint, k int, is_left boolean, part string"), "phrases-asked")
    tasks = asked.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(ASKERS)).cast("int").alias("tasks"))
    held = transducers.join(tasks, keys).withColumn("piece", F.explode(F.sequence(F.lit(1), "tasks")))
    dealt = asked.join(tasks, keys).withColumn("piece", 1 + F.pmod(F.xxhash64("phrase"), F.col("tasks")).cast("int"))
    keys.append("piece")
    return held.drop("tasks").groupBy(*keys).cogroup(dealt.drop("tasks").groupBy(*keys)).applyInArrow(
        _answer, "lang string, phrase string, a bigint, k int, is_left boolean, n bigint")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases that no longer phrase of the same count covers."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    n_ranges = max(FEWEST_RANGES, -(-texts.count() // DOCS_PER_RANGE))
    share = spark.sparkContext.broadcast
    one = counted(texts, 1, n_ranges, least)
    words = share(bit_table(materialize(one.mapInArrow(_word_buckets, "bucket bigint"), "phrases-words")))
    buckets = texts.mapInArrow(_pair_buckets(words), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    pairs = share(bit_table(materialize(buckets.where(F.col("n") >= least).select("bucket"), "phrases-pairs")))
    more = counted(texts, 2, n_ranges, least, words, pairs)
    totals = one.groupBy("lang").agg(F.sum("total").alias("n"))
    transducers = one.unionByName(more)
    answers = part_counts(transducers, n_ranges)

    def part(k: int, left: bool):
        return F.max(F.when((F.col("k") == k) & (F.col("is_left") == left), F.col("n")))

    sides = [part(k, left).alias(f"{'l' if left else 'r'}{k}") for k in range(1, LONGEST) for left in (True, False)]
    phrases = materialize(answers.groupBy("lang", "phrase", "a").agg(F.max("k").alias("cuts"), *sides), "phrases-parts")
    # A longer phrase as frequent as this one makes every phrase between them as frequent, so one word more is enough to look at.
    longer = phrases.where("cuts > 1")
    last_left = F.coalesce(*[F.when(F.col("cuts") == k, F.col(f"l{k}")) for k in range(2, LONGEST)])
    words = F.split("phrase", " ")
    beginnings = longer.where(last_left == F.col("a")).select("lang", F.array_join(F.slice(words, 1, F.size(words) - 1), " ").alias("phrase"))
    endings = longer.where("r1 = a").select("lang", F.array_join(F.slice(words, 2, F.size(words)), " ").alias("phrase"))
    covered = beginnings.unionByName(endings).distinct()
    kept = phrases.join(covered, ["lang", "phrase"], "left_anti").join(totals, "lang")
    # Products stay below 38 digits; the quotient is at most 10 n.
    product = "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)))"
    scores = [
        F.when(F.col(f"l{k}").isNotNull(), F.struct(
            F.expr(f"{product} DIV (CAST(l{k} AS DECIMAL(19,0)) * CAST(r{k} AS DECIMAL(19,0)))").alias("score"),
            F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, LONGEST)
    ]
    lowest = F.array_min(F.array_compact(F.array(*scores)))
    scored = kept.select("lang", "phrase", "a", "n", lowest.alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
